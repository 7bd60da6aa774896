"""Parquet tables of the raw, cleaned and gold layers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from shopgrain.sources.scratch import delete

LAYERS = ("bronze", "silver", "gold")
_POINTER = "_current"


def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; known: {', '.join(LAYERS)}")
    return f"{root}/{layer}/{table}"


def write_parquet_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_parquet_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, merge: bool = False
) -> DataFrame:
    """``merge`` unites the columns of files written at different times."""
    reader = spark.read.option("mergeSchema", str(merge).lower())
    return (reader.schema(schema) if schema else reader).parquet(path)


# -- versioned tables --------------------------------------------------------
#
# A table is a folder of version folders and a pointer file that names the
# current one. A reader keeps the version it resolved, a writer may read the
# table it replaces, and a failed write leaves the pointer as it was.


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs, hadoop_path, conf


def current_version(spark: SparkSession, path: str) -> str | None:
    fs_package, pointer, conf = _file_system(spark, f"{path}/{_POINTER}")
    fs = pointer.getFileSystem(conf)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one of the table at ``path``, in one step."""
    fs_package, target, conf = _file_system(spark, f"{path}/{_POINTER}")
    draft = fs_package.Path(f"{path}/_next-{uuid.uuid4().hex}")
    stream = target.getFileSystem(conf).create(draft, True)
    stream.writeUTF(version)
    stream.close()
    context = fs_package.FileContext.getFileContext(target.toUri(), conf)
    rename = spark.sparkContext._gateway.new_array(
        getattr(spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename"), 1
    )
    rename[0] = getattr(spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(draft, target, rename)


def write_version(df: DataFrame, path: str) -> str:
    """Write a new version of the table and make it the current one."""
    version = f"v-{uuid.uuid4().hex}"
    write_parquet_table(df, f"{path}/{version}", mode="errorifexists")
    point_to(df.sparkSession, path, version)
    return version


def read_version(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_parquet_table(spark, f"{path}/{version}")


def write_layer(df: DataFrame, root: str, layer: str, table: str) -> None:
    """Replace a layer table; the new version's columns are the table's columns."""
    write_version(df, layer_path(root, layer, table))


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return read_version(spark, layer_path(root, layer, table))


# -- tables in buckets of their key -------------------------------------------
#
# One Parquet folder per bucket, replaced by Spark's dynamic partition overwrite, so a
# change to some keys rewrites the buckets of these keys only. Key, number of buckets and
# schema are stored beside them.

_BUCKET = "__bucket"


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A new table, where there is none yet."""
    if bucketed_state(df.sparkSession, path) is not None:
        raise FileExistsError(f"there is a table at {path}")
    state = {"key": key, "buckets": buckets, "schema": df.schema.json()}
    point_to(df.sparkSession, path, json.dumps(state))
    replace_buckets(df, path)


def bucketed_state(spark: SparkSession, path: str) -> dict | None:
    state = current_version(spark, path)
    return None if state is None else json.loads(state)


def _bucketed_schema(state: dict) -> StructType:
    return StructType.fromJson(json.loads(state["schema"])).add(_BUCKET, "integer")


def read_bucketed(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The table, or the given buckets of it, whose folders alone are read.

    One that is read while its buckets are replaced may miss some: Spark's overwrite
    deletes a folder before it moves the new one there.
    """
    state = bucketed_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    if not _exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], _bucketed_schema(state)).drop(_BUCKET)
    rows = spark.read.schema(_bucketed_schema(state)).parquet(f"{path}/rows")
    return (rows if only is None else rows.where(F.col(_BUCKET).isin(list(only)))).drop(_BUCKET)


def replace_buckets(df: DataFrame, path: str) -> None:
    """``df`` becomes the content of the buckets that its rows belong to; the others keep their files.

    The rows may be computed from the table: they are written beside it first. So a
    driver that dies while the folders are exchanged loses nothing: ``finish_replacing``
    does it again. One writer at a time.
    """
    state = bucketed_state(df.sparkSession, path)
    rows = df.withColumn(_BUCKET, bucket(state["key"], state["buckets"]))
    write_parquet_table(rows, f"{path}/_pending")
    finish_replacing(df.sparkSession, path)


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Exchange the folders of the rows that are written and wait, if any do.

    Rebalancing gathers a bucket's rows, and splits a bucket too large for a task.
    """
    pending = f"{path}/_pending"
    if not _exists(spark, f"{pending}/_SUCCESS"):
        return
    rows = read_parquet_table(spark, pending, _bucketed_schema(bucketed_state(spark, path)))
    (
        rows.hint("rebalance", _BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(_BUCKET)
        .parquet(f"{path}/rows")
    )
    delete(spark, pending)


def _exists(spark: SparkSession, path: str) -> bool:
    _, place, conf = _file_system(spark, path)
    return place.getFileSystem(conf).exists(place)


# -- other sinks -------------------------------------------------------------


def with_date_parts(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(
        {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}
    )


def write_partitioned(
    df: DataFrame, path: str, date: str, parts: Sequence[str] = ("year", "month", "day")
) -> None:
    """Date folders. Rebalancing gathers a folder's rows, and splits a folder too large for a task."""
    dated = with_date_parts(df, date)
    unused = [p for p in ("year", "month", "day") if p not in parts]
    dated.drop(*unused).hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(path)


def union_evolving(*batches: DataFrame) -> DataFrame:
    """Batches whose columns differ: new columns are added, missing ones are null, types are united.

    See ``common_type``; fields of nested rows, in lists and maps too, are matched by name.
    """
    schema = batches[0].schema
    for batch in batches[1:]:
        schema = common_type(schema, batch.schema)
    united = None
    for batch in batches:
        given = {f.name: f.dataType for f in batch.schema.fields}
        as_one = batch.select(
            *[
                (convert(F.col(_quoted(f.name)), given[f.name], f.dataType) if f.name in given else F.lit(None).cast(f.dataType))
                .alias(f.name)
                for f in schema.fields
            ]
        )
        united = as_one if united is None else united.unionByName(as_one)
    return united


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both.

    The wider of two numbers; a decimal with room for both, or a double where 38 digits
    are too few or one is a fraction; the time of a day and a time; the fields of both of two
    rows. Kinds that have nothing in common become text, nested ones JSON.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f.dataType for f in b.fields}
        fields = [(f.name, common_type(f.dataType, theirs.pop(f.name, f.dataType))) for f in a.fields]
        return T.StructType([T.StructField(n, t) for n, t in [*fields, *theirs.items()]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        # Keys of one type only: two keys might become one text.
        if a.keyType == b.keyType:
            return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if T.FloatType() in (a, b) or T.DoubleType() in (a, b):
            return T.DoubleType()
        (p, s), (q, r) = _precision(a), _precision(b)
        scale, whole = max(s, r), max(p - s, q - r)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def _precision(t: T.DataType) -> tuple[int, int]:
    return (t.precision, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0)


def convert(c: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A column of one type as the ``common_type`` of it and others."""
    if given == wanted:
        return c
    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        has = {f.name: f.dataType for f in given.fields}
        fields = [
            (convert(c[f.name], has[f.name], f.dataType) if f.name in has else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        return F.transform(c, lambda x: convert(x, given.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        return F.transform_values(c, lambda _, x: convert(x, given.valueType, wanted.valueType))
    if isinstance(wanted, T.StringType) and isinstance(given, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(wanted)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
