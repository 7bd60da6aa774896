"""Steps whose tasks get a bounded number of rows, and work that is done once."""

import time
from decimal import Decimal
from pathlib import Path
from urllib.parse import urlparse

import pytest

from shopgrain.operators import gold, rollups
from shopgrain.operators.baskets import of_known_orders, order_products
from shopgrain.operators.gold import Gold
from shopgrain.operators.rollups import order_category_sums
from shopgrain.plans import analyses, models
from shopgrain.plans.extended import basket_categories
from shopgrain.plans.medallion import Medallion
from shopgrain.plans.scripts import product_combinations
from shopgrain.sources import retail, scratch
from shopgrain.sources.layers import write_layer
from shopgrain.sources.retail import Retail

HOT = 900  # lines of order 1, of 1,000


@pytest.fixture
def shop(spark, monkeypatch) -> Retail:
    monkeypatch.setattr(retail, "MOST_ROWS", 50)
    monkeypatch.setattr(retail, "LEAST_ROWS", 50)
    money, day = "decimal(18,2)", "date'2001-01-01'"
    sales = spark.range(1000).selectExpr(
        "cast(id as string) as sale_id",
        f"case when id < {HOT} then 1 when id < 998 then id else null end as order_id",
        "id % 10 as product_id",
        "1 as quantity",
        "cast(2 as decimal(18,6)) as unit_price",
        "cast(0 as decimal(5,2)) as discount",
        f"cast(2 as {money}) as total",
        f"cast(1 as {money}) as profit",
    )
    # Orders 990 and up are not known.
    orders = spark.range(990).selectExpr(
        "id as order_id", "id % 7 as customer_id", "id % 3 as employee_id", "id % 2 as store_id",
        f"{day} as order_date", "'Completed' as status",
    )
    products = spark.range(10).selectExpr(
        "id as product_id", "concat('p', id) as product_name", "if(id < 5, 'A', 'B') as category",
        f"cast(1 as {money}) as cost_price", f"cast(2 as {money}) as selling_price", "10 as stock",
    )
    customers = spark.range(7).selectExpr(
        "id as customer_id", "'f' as first_name", "'l' as last_name", "'Male' as gender", "'e' as email",
        "'c' as city", "'n' as country", f"{day} as join_date",
    )
    stores = spark.range(2).selectExpr(
        "id as store_id", "concat('s', id) as store_name", "'c' as city", "'n' as country", "'r' as region"
    )
    employees = spark.range(3).selectExpr("id as employee_id", "'e' as employee_name", "'d' as department")
    return Retail(customers, products, employees, stores, orders, sales)


def _shares(df, key="order_id"):
    """Different keys in each partition."""
    return df.select(key).distinct().count(), [
        len({row[0] for row in part}) for part in df.select(key).rdd.glom().collect()
    ]


def test_partitions_follow_the_rows(spark, shop, monkeypatch):
    assert shop.spread(shop.orders, "order_id").rdd.getNumPartitions() == 20
    monkeypatch.setattr(retail, "MOST_ROWS", 10)
    again = Retail(*[shop.table(n) for n in retail.TABLES])
    assert again.spread(again.orders, "order_id").rdd.getNumPartitions() == 100


@pytest.mark.parametrize("step", [order_products, order_category_sums])
def test_orders_of_a_step_are_spread(shop, step):
    orders, shares = _shares(step(shop))
    assert len(shares) == 20 and sum(shares) == orders and max(shares) < orders / 4


def test_hot_order_in_category_sums(shop):
    sums = order_category_sums(shop)
    rows = {(r["order_id"], r["category"]): r for r in sums.collect()}
    assert rows[1, "A"]["lines"] == HOT / 2 and rows[1, "A"]["revenue"] == Decimal(HOT)
    assert sum(r["lines"] for r in rows.values()) == 1000 and rows[None, "B"]["lines"] == 2
    assert dict(sums.dtypes) == {
        "order_id": "bigint", "category": "string", "revenue": "decimal(28,2)", "profit": "decimal(28,2)",
        "units": "bigint", "discounts": "decimal(15,2)", "unit_prices": "decimal(28,6)", "lines": "bigint",
    }


def test_unknown_orders_are_left_out(shop):
    known = of_known_orders(shop, order_products(shop).groupBy("order_id").count())
    assert {r["order_id"] for r in known.collect()} == {1, *range(HOT, 990)}
    assert [tuple(r) for r in basket_categories(shop).collect()] == [(["A", "B"], 2, 1)]
    assert [r["order_count"] for r in product_combinations(shop).collect()] == [1]


def test_daily_summary_does_not_gather_rows_by_store(shop):
    plan = gold.daily_sales_summary(shop)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(store_id" not in plan
    assert sum(r["order_count"] for r in gold.daily_sales_summary(shop).collect()) == 2 + 90


def test_run_all_makes_a_gold_table_once(shop, monkeypatch):
    made, build = [], gold.daily_sales_summary
    monkeypatch.setattr(gold, "daily_sales_summary", lambda t: made.append(1) or build(t))
    monkeypatch.setattr(gold, "daily_measures", lambda t: made.append(1))
    names = ["seasonality_dow", "gold_daily_sales_summary", "monthly_revenue", "gold_monthly_time_series"]
    results, failed = analyses.run_all(Gold(shop, "2001-08-02"), names)
    assert list(results) == names and not failed and made == [1]


def test_shared_gold_tables_are_the_gold_tables(shop):
    plain, shared = Gold(shop, "2001-08-02"), analyses.SharedGold(Gold(shop, "2001-08-02"))
    for name in (*gold.GOLD_TABLES, "daily_measures", "product_measures", "store_measures"):
        a, b = getattr(plain, name), getattr(shared, name)
        assert a.dtypes == b.dtypes, name
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_run_all_makes_the_sums_of_orders_once(shop, monkeypatch):
    made, sums = [], rollups._line_sums
    monkeypatch.setattr(rollups, "_line_sums", lambda: made.append(1) or sums())
    names = ["gold_customer_analytics", "cltv_prediction", "purchase_pattern", "moving_averages"]
    results, failed = analyses.run_all(Gold(shop, "2001-08-02"), names)
    assert list(results) == names and not failed and made == [1]


def test_shared_steps_change_no_analysis(shop):
    names = (
        "product_season inventory_days inventory_risk yoy_from_daily ath_sales_dashboard ath_seasonality"
        " gold_monthly_revenue_by_category gold_customer_ltv basket_size_histogram basket_combo_labels"
        " pareto_analysis abc_summary ath_cohort_retention rfm_segment_summary ath_inventory_risk"
    ).split()
    results, failed = analyses.run_all(Gold(shop, "2001-08-02"), names)
    assert list(results) == names and not failed
    for name, shared in results.items():
        alone = analyses.run_named(name, Gold(shop, "2001-08-02"))
        assert alone.dtypes == shared.dtypes, name
        assert sorted(map(str, alone.collect())) == sorted(map(str, shared.collect())), name


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_the_gold_step_leaves_nothing_beside_its_tables(spark, shop, tmp_path, monkeypatch):
    lake = Medallion(spark, str(tmp_path), shop.table, "2001-08-02")
    for name in retail.TABLES:
        write_layer(shop.table(name), lake.root, "silver", name)
    summed, sums = [], rollups._line_sums
    monkeypatch.setattr(rollups, "_line_sums", lambda: summed.append(1) or sums())
    settled = Path(urlparse(scratch._own_folder(spark)).path)
    folders, files = {*settled.glob("*")}, _shuffle_files(spark)
    lake.gold()
    assert len(summed) == 3  # once for orders, for products, and for categories of orders
    assert {*settled.glob("*")} <= folders
    until = time.monotonic() + 10
    while (left := _shuffle_files(spark)) > files and time.monotonic() < until:
        time.sleep(0.2)
    assert left <= files and spark.conf.get(scratch._FREE, None) is None
    plain = Gold(lake.retail(), "2001-08-02")
    for name in gold.GOLD_TABLES:
        written, made = lake.table("gold", name), getattr(plain, name)
        assert written.dtypes == made.dtypes, name
        assert sorted(map(str, written.collect())) == sorted(map(str, made.collect())), name


def test_training_partitions_do_not_outgrow_the_cores():
    made = [models._partitions(n, 12) for n in (10, 15_000, 100_000, 480_000, 2_900_000, 30_000_000)]
    assert made == [1, 1, 5, 12, 12, 60]
