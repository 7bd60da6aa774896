"""Folders, views, catalog tables and database options."""

import logging
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.sources import catalog, changes, jdbc, layers, scratch
from shopgrain.sources.retail import TABLES


def test_layer_round_trip_and_versions(spark, tmp_path):
    root = str(tmp_path)
    layers.write_layer(spark.range(3), root, "bronze", "orders")
    old = layers.read_layer(spark, root, "bronze", "orders")
    # The table may be replaced by what is computed from itself.
    layers.write_layer(old.withColumn("twice", F.col("id") * 2), root, "bronze", "orders")
    assert old.count() == 3 and old.columns == ["id"]
    assert layers.read_layer(spark, root, "bronze", "orders").columns == ["id", "twice"]
    with pytest.raises(FileNotFoundError):
        layers.read_layer(spark, root, "bronze", "sales")
    with pytest.raises(ValueError):
        layers.layer_path(root, "platinum", "orders")


def test_merged_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    spark.range(2).withColumn("extra", F.lit("x")).write.mode("append").parquet(path)
    df = layers.read_parquet_table(spark, path, merge=True)
    assert sorted(df.columns) == ["extra", "id"] and df.where("extra IS NULL").count() == 2


def test_partition_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = spark.range(800).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")))
    layers.write_partitioned(dated, path, "d")
    back = spark.read.parquet(path)
    assert back.where("year = 2025 AND month = 2").count() == 28
    plan = back.where("year = 2025")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_missing_tables_are_left_out(spark, caplog):
    def read(name):
        if name == "returns":
            raise FileNotFoundError("no returns")
        return spark.range(2)

    with caplog.at_level(logging.WARNING):
        names = catalog.register_views(read, ["orders", "returns"], "t1_")
        again = catalog.register_views(read, ["orders", "returns"], "t1_")
    assert names == again == ["t1_orders"] and "no returns" in caplog.text
    opened, failed = jdbc.read_all_jdbc(read, ["orders", "returns"])
    assert list(opened) == ["orders"] and failed == {"returns": "no returns"}


def test_declared_tables(spark, tmp_path):
    catalog.create_databases(spark, "shop")
    names = catalog.register_tables(spark, "shop_raw", lambda t: str(tmp_path / t))
    assert len(names) == 6
    assert spark.table("shop_raw.orders").dtypes[4] == ("order_date", "date")
    spark.createDataFrame(
        [(1, "s", "c", "k", "r", None)], spark.table("shop_raw.stores").schema
    ).write.parquet(str(tmp_path / "stores"), mode="append")
    spark.catalog.refreshTable("shop_raw.stores")
    assert spark.table("shop_raw.stores").count() == 1


def test_jdbc_options():
    db = jdbc.Database("jdbc:postgresql://host:5432/shop", {"user": "u", "password": "p"})
    read = db.read_options("sales", jdbc.Slices("sale_id", 1, 1001, 10))
    assert read["partitionColumn"] == "sale_id" and read["numPartitions"] == "10"
    assert read["lowerBound"] == "1" and read["upperBound"] == "1001" and read["dbtable"] == "sales"
    assert "partitionColumn" not in db.read_options("stores")
    assert db.write_options("sales", keep_table=True)["truncate"] == "true"
    assert "truncate" not in db.write_options("sales")


def test_copy_fills_parents_first():
    seen = []
    jdbc.copy_tables(
        read=lambda t: f"rows of {t}",
        write=lambda rows, t: seen.append(("fill", t)),
        empty=lambda t: seen.append(("empty", t)),
    )
    order = ["stores", "customers", "products", "employees", "orders", "sales"]
    assert sorted(order) == sorted(TABLES)
    assert seen == [("empty", t) for t in reversed(order)] + [("fill", t) for t in order]


def test_settled_tables_lie_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark) == named
    settled = scratch.settle(spark.range(5))
    assert f"{named}/settled/" in settled.inputFiles()[0]
    assert spark.sparkContext.applicationId in settled.inputFiles()[0]


def test_union_of_batches(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, old string"), spark.createDataFrame([(2, "y")], "id int, new string")
    assert sorted(map(tuple, layers.union_evolving(a, b).collect()), key=repr) == [(1, "x", None), (2, None, "y")]


def test_what_passes_is_deleted(spark):
    from urllib.parse import urlparse

    def folder(df):
        return Path(urlparse(df.inputFiles()[0]).path).parent

    with scratch.passing(spark):
        inner = folder(scratch.settle(spark.range(3)))
        assert inner.exists()
    outer = folder(scratch.settle(spark.range(3)))
    assert outer.exists() and not inner.exists()


def test_days_of_changes_before_the_mark_are_not_read(spark, tmp_path):
    row = T.StructType().add("id", "integer")
    for day in ("20240101", "20240102", "20240103"):
        df = spark.createDataFrame([(int(day), "I", None)], "id int, Op string, __dms_timestamp timestamp")
        df.write.parquet(f"{tmp_path}/plain/{day}")
        df.write.parquet(f"{tmp_path}/named/day={day}")
    for form in ("plain", "named"):
        got = changes.read_cdc_op(spark, f"{tmp_path}/{form}", row, since="20240102")
        assert sorted((r.id, r.day) for r in got.collect()) == [(20240102, "20240102"), (20240103, "20240103")]
        assert not any("20240101" in f for f in got.inputFiles())
        assert changes.read_cdc_op(spark, f"{tmp_path}/{form}", row, since="20250101").count() == 0


def test_union_of_batches_whose_types_changed(spark):
    a = spark.sql(
        "SELECT 1 AS id, DATE'2024-01-02' AS at, 7 AS code, CAST(1.5 AS DECIMAL(4,2)) AS price,"
        " named_struct('x', 1, 'in', array(named_struct('y', 1))) AS nest, map('k', 1) AS tags, array(1) AS list, 1.0f AS r"
    )
    b = spark.sql(
        "SELECT 3000000000 AS id, TIMESTAMP'2024-01-02 03:00:00' AS at, 'seven' AS code, 12345678 AS price,"
        " named_struct('z', 'n', 'in', array(named_struct('y', 2L, 'w', 'new')), 'x', 2L) AS nest,"
        " map('k', 'v') AS tags, 'none' AS list, 2 AS r, CAST(NULL AS STRING) AS extra"
    )
    c = spark.sql("SELECT 5 AS id, CAST(NULL AS STRUCT<x:INT>) AS nest, NULL AS code")
    got = layers.union_evolving(a, b, c)
    kinds = dict(got.dtypes)
    assert kinds == {
        "id": "bigint", "at": "timestamp", "code": "string", "price": "decimal(12,2)",
        "nest": "struct<x:bigint,in:array<struct<y:bigint,w:string>>,z:string>", "tags": "map<string,string>",
        "list": "string", "r": "double", "extra": "string",
    }
    one, two, three = sorted(got.collect(), key=lambda r: (r.id > 4, r.id == 5))
    assert (one.code, str(one.at), str(one.price), one.tags, one.list) == ("7", "2024-01-02 00:00:00", "1.50", {"k": "1"}, "[1]")
    assert one.nest.asDict(True) == {"x": 1, "in": [{"y": 1, "w": None}], "z": None}
    assert two.nest.asDict(True) == {"x": 2, "in": [{"y": 2, "w": "new"}], "z": "n"}
    assert (two.id, two.code, str(two.price), two.list) == (3000000000, "seven", "12345678.00", "none")
    assert (three.nest, three.code, three.at) == (None, None, None)
    assert spark.createDataFrame(got.collect(), got.schema).count() == 3


def test_union_of_one_batch_and_of_empty_ones(spark):
    a = spark.createDataFrame([], "x int")
    assert layers.union_evolving(a).dtypes == [("x", "int")]
    b = spark.createDataFrame([("q",)], "`x` string")
    assert [r.x for r in layers.union_evolving(a, b).collect()] == ["q"]
