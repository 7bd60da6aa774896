"""The six retail tables, and the mapping from star-schema Parquet onto them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from threading import Lock, RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.columns import MONEY
from shopgrain.sources.scratch import settle

TABLES = ("customers", "products", "employees", "stores", "orders", "sales")
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "employees": "employee_id",
    "stores": "store_id",
    "orders": "order_id",
    "sales": "sale_id",
}

#: Sale rows of one task of ``Retail.spread``, and what a task is worth while there are idle cores.
MOST_ROWS, LEAST_ROWS = 250_000, 20_000


class Retail:
    """The tables an analysis reads. Before an action nothing but the number of sales is computed, by ``spread``."""

    def __init__(
        self,
        customers: DataFrame,
        products: DataFrame,
        employees: DataFrame,
        stores: DataFrame,
        orders: DataFrame,
        sales: DataFrame,
        order_heads: DataFrame | None = None,
    ):
        self.customers = customers
        self.products = products
        self.employees = employees
        self.stores = stores
        self.orders = orders
        self.sales = sales
        # The same orders without store_id, where looking the store up costs a join.
        self.order_heads = orders if order_heads is None else order_heads

    @cached_property
    def _tasks(self) -> int:
        """Partitions for rows that grow with the sales: Parquet tells their number without a scan."""
        rows, cores = self.sales.count(), self.sales.sparkSession.sparkContext.defaultParallelism
        return max(1, -(-rows // MOST_ROWS), min(cores, rows // LEAST_ROWS))

    def spread(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows by key in so many partitions that a task's share does not grow with the sales.

        Adaptive execution sizes tasks by shuffled bytes, of which narrow rows take few and hash
        tables and sorts many. All that is spread by one key is joined on it without a shuffle.
        """
        return df.repartition(self._tasks, *keys)

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A step of several analyses: a plan here, a table made once in ``SharedRetail``."""
        return build()

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
        return getattr(self, name)


class SharedRetail(Retail):
    """Another retail's tables for several analyses, maybe at a time: each shared step is written when first read."""

    def __init__(self, base: Retail):
        self._base, self._made, self._locks, self._lock = base, {}, {}, Lock()

    def __getattr__(self, name: str):
        return getattr(self._base, name)

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            lock = self._locks.setdefault(name, RLock())
        with lock:
            if name not in self._made:
                self._made[name] = settle(build(), name)
            return self._made[name]


def _money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def _cost_rate(part_key: str) -> Column:
    percent = (50 + F.col(part_key) % 40).cast("decimal(4,0)")
    return percent * F.lit("0.01").cast("decimal(3,2)")


# Columns and types of the star-schema files.
STAR_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


class StarRetail(Retail):
    """Retail tables over customer/part/nation/supplier/orders/lineitem Parquet.

    Each table is opened when an analysis first asks for it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(STAR_SCHEMA[name]).parquet(f"{self._folder}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        first, last = (F.split("c_name", "#")[i] for i in (0, 1))
        genders = F.array(F.lit("Male"), F.lit("Female"), F.lit("Other"))
        epoch = F.lit("1995-01-01").cast("date")
        joined = self._read("customer").join(
            self._read("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return joined.select(
            F.col("c_custkey").alias("customer_id"),
            first.alias("first_name"),
            last.alias("last_name"),
            F.element_at(genders, (F.col("c_custkey") % 3 + 1).cast("int")).alias("gender"),
            F.concat(F.lower(first), last, F.lit("@example.com")).alias("email"),
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("country"),
            F.date_add(epoch, (F.col("c_custkey") % 1000).cast("int")).alias("join_date"),
        )

    @cached_property
    def products(self) -> DataFrame:
        price = _money("p_retailprice")
        return self._read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.round(price * _cost_rate("p_partkey"), 2).cast(MONEY).alias("cost_price"),
            price.alias("selling_price"),
            (F.col("p_size") * 10).alias("stock"),
        )

    @cached_property
    def _places(self) -> DataFrame:
        return self._read("nation").join(
            self._read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @cached_property
    def stores(self) -> DataFrame:
        return self._places.select(
            F.col("n_nationkey").alias("store_id"),
            F.concat(F.lit("Store "), F.col("n_nationkey")).alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )

    @cached_property
    def employees(self) -> DataFrame:
        return (
            self._read("supplier")
            .join(self._places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("employee_id"),
                F.col("s_name").alias("employee_name"),
                F.col("r_name").alias("department"),
                (30000 + F.abs(_money("s_acctbal")) * 9).cast(MONEY).alias("salary"),
            )
        )

    @cached_property
    def order_heads(self) -> DataFrame:
        status = F.create_map(
            *[F.lit(x) for x in ("F", "Completed", "O", "Pending", "P", "Shipped")]
        )
        staff = self._read("supplier").agg(F.count(F.lit(1))).scalar()
        return self._read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % staff).alias("employee_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            status[F.col("o_orderstatus")].alias("status"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        homes = self._read("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("store_id")
        )
        columns = ["order_id", "customer_id", "employee_id", "store_id", "order_date", "status"]
        return self.order_heads.join(homes, "customer_id").select(*columns)

    @cached_property
    def sales(self) -> DataFrame:
        gross = _money("l_extendedprice")
        discount = F.col("l_discount").cast("decimal(4,2)")
        total = F.round(gross * (1 - discount), 2).cast(MONEY)
        cost = F.round(gross * _cost_rate("l_partkey"), 2)
        quantity = F.col("l_quantity").cast("int")
        # The line's own values name it: numbering the lines inside an order
        # would pull a large order into one task.
        name = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        return self._read("lineitem").select(
            F.concat_ws("-", *name, quantity, (gross * 100).cast("bigint")).alias("sale_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            F.round(gross / quantity, 6).cast("decimal(18,6)").alias("unit_price"),
            (discount * 100).cast("decimal(5,2)").alias("discount"),
            total.alias("total"),
            (total - cost).cast(MONEY).alias("profit"),
        )


def from_star_schema(spark: SparkSession, folder: str) -> Retail:
    return StarRetail(spark, folder)
