"""Analyses on hand-written rows: borders, blanks, and groups of any size."""

import copy
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import baskets
from shopgrain.operators.gold import Gold
from shopgrain.plans import core, extended, features, lakehouse, reports, scripts
from shopgrain.plans.analyses import ANALYSES, list_queries, run_all, run_named
from shopgrain.plans.governance import analyst_view
from shopgrain.plans.medallion import Medallion
from shopgrain.sources.retail import Retail


def shop(spark, lines, orders=None, products=None):
    """lines: (order, product, quantity, unit price, discount); orders: {order: (customer, date)}."""
    D = Decimal
    orders = orders or {o: (o, date(2024, 1, 1) + timedelta(days=o)) for o in {l[0] for l in lines}}
    products = products or {p: (f"p{p}", "Food", 10) for p in {l[1] for l in lines}}
    customers = {c for c, _ in orders.values()}
    sales = [
        (i, o, p, q, D(str(u)), D(str(d)), D(str(round(q * u * (100 - d) / 100, 2))), D(str(round(q * u * (100 - d) / 400, 2))))
        for i, (o, p, q, u, d) in enumerate(lines)
    ]
    return Retail(
        customers=spark.createDataFrame(
            [(c, f"F{c}", f"L{c}", "Male", f"{c}@x.com", "Town", "Uk", date(2024, 1, 1)) for c in customers],
            "customer_id long, first_name string, last_name string, gender string, email string, city string,"
            " country string, join_date date",
        ),
        products=spark.createDataFrame(
            [(p, n, c, D("5.00"), D("10.00"), s) for p, (n, c, s) in products.items()],
            "product_id long, product_name string, category string, cost_price decimal(18,2),"
            " selling_price decimal(18,2), stock int",
        ),
        employees=spark.createDataFrame(
            [(1, "E1", "North", D("1000.00"))],
            "employee_id long, employee_name string, department string, salary decimal(18,2)",
        ),
        stores=spark.createDataFrame(
            [(1, "Store 1", "Town", "Uk", "Europe")],
            "store_id int, store_name string, city string, country string, region string",
        ),
        orders=spark.createDataFrame(
            [(o, c, 1, 1, d, "Completed") for o, (c, d) in orders.items()],
            "order_id long, customer_id long, employee_id long, store_id int, order_date date, status string",
        ),
        sales=spark.createDataFrame(
            sales,
            "sale_id int, order_id long, product_id long, quantity int, unit_price decimal(18,6),"
            " discount decimal(5,2), total decimal(18,2), profit decimal(18,2)",
        ),
    )


def test_pareto_borders_belong_to_the_lower_class(spark):
    # Shares run 0.80, 0.95, 1.00 exactly.
    t = shop(spark, [(1, 1, 1, 80, 0), (2, 2, 1, 15, 0), (3, 3, 1, 5, 0)])
    got = [(r["rank"], r.pareto_category) for r in core.pareto_analysis(t).collect()]
    assert got == [(1, "A"), (2, "B"), (3, "C")]
    assert [r.abc_class for r in lakehouse.abc_products(t).collect()] == ["A", "B", "C"]


@pytest.mark.parametrize(
    "discount, bucket",
    [(0, "0%"), (1, "1-10%"), (10, "1-10%"), (10.5, "11-20%"), (20, "11-20%"), (30, "21-30%"), (31, ">30%")],
)
def test_discount_buckets(spark, discount, bucket):
    t = shop(spark, [(1, 1, 1, 100, discount)])
    assert extended.discount_effectiveness(t).first().discount_bucket == bucket


def test_free_lines_divide_by_nothing(spark):
    t = shop(spark, [(1, 1, 1, 0, 0), (2, 1, 1, 0, 0)])
    g = Gold(t, "2024-03-01")
    assert g.daily_sales_summary.first().profit_margin is None
    assert extended.discount_effectiveness(t).first().overall_margin_pct is None
    assert extended.anomaly_detection(g).count() == 0
    assert lakehouse.discount(t).first().avg_margin_pct is None


def test_products_never_sold(spark):
    products = {1: ("sold", "Food", 100), 2: ("never", "Food", 50), 3: ("long ago", "Food", 70)}
    orders = {1: (1, date(2024, 2, 1)), 2: (1, date(2020, 1, 1))}
    t = shop(spark, [(1, 1, 4, 1, 0), (2, 3, 1, 1, 0)], orders, products)
    got = {r.product_id: (r.units_sold, r.days_of_inventory) for r in scripts.inventory_days(t, "2024-03-01").collect()}
    assert got == {1: (4, 100 / 4 * 365), 2: (0, None)}
    risk = {r.product_id: (r.days_of_cover, r.risk_flag) for r in lakehouse.inventory_risk(t, "2024-03-01").collect()}
    assert risk == {1: (Decimal("25.0"), "OK"), 2: (None, "OK"), 3: (None, "OK")}
    # Sold on a single day: the demand period is one day.
    cover = {r.product_id: r.days_of_cover for r in extended.inventory_risk(t).collect()}
    assert cover == {1: 25, 3: 70}


def test_year_over_year_needs_the_same_month(spark):
    orders = {1: (1, date(2023, 5, 1)), 2: (1, date(2024, 5, 9)), 3: (1, date(2024, 6, 1))}
    t = shop(spark, [(1, 1, 1, 100, 0), (2, 1, 1, 150, 0), (3, 1, 1, 9, 0)], orders)
    got = {(r.year, r.month): r.yoy_growth_pct for r in core.yoy_comparison(Gold(t, "2024-07-01")).collect()}
    assert got == {(2023, 5): None, (2024, 5): Decimal("50.00"), (2024, 6): None}


def test_everyone_is_active_in_month_zero(spark):
    orders = {i: (i % 3, date(2024, 1 + i % 5, 28)) for i in range(12)}
    t = shop(spark, [(i, 1, 1, 1, 0) for i in orders], orders)
    rows = extended.cohort_matrix(t).collect()
    assert {r.retention_pct for r in rows if r.months_since_first == 0} == {Decimal("100.0")}
    assert sum(r.cohort_size for r in rows if r.months_since_first == 0) == 3


def test_whole_years(spark):
    df = spark.createDataFrame(
        [(date(2020, 2, 29), date(2021, 2, 28), 0), (date(2020, 5, 1), date(2023, 5, 1), 3), (date(2020, 5, 2), date(2023, 5, 1), 2)],
        "a date, b date, n int",
    )
    assert df.where(scripts.whole_years(F.col("a"), F.col("b")) != F.col("n")).count() == 0


def test_preferred_category_is_the_most_bought(spark):
    products = {1: ("a", "Books", 1), 2: ("b", "Sports", 1)}
    orders = {1: (1, date(2024, 1, 1)), 2: (1, date(2024, 1, 2))}
    t = shop(spark, [(1, 1, 1, 1, 0), (2, 1, 1, 1, 0), (2, 2, 1, 1, 0)], orders, products)
    r = features.customer_features(t, "2024-02-01").first()
    assert (r.cat_books, r.cat_sports, r.distinct_categories, r.frequency) == (1, 0, 2, 2)
    assert (r.orders_last_30d, r.orders_last_90d, r.is_churned) == (1, 2, 0)


def test_weeks_belong_to_their_iso_year(spark):
    t = shop(spark, [(1, 1, 3, 1, 0)], {1: (1, date(2024, 12, 30))})
    r = features.product_features(t).first()
    assert (r.year, r.week, r.units_sold, r.lag_1w, r.rolling_mean_4w) == (2025, 1, 3, 0, 3.0)


# -- baskets -----------------------------------------------------------------


def uneven_shop(spark):
    """One order holds a third of all lines, some of them copies."""
    lines = [(0, p, 1, 1, 0) for p in range(40)] + [(0, 3, 1, 1, 0)] * 5
    for o in range(1, 46):
        lines += [(o, o % 7, 1, 1, 0), (o, (o * 3) % 11, 1, 1, 0)]
    return shop(spark, lines, products={p: (f"p{p % 25}", "Food" if p % 2 else "Toys", 1) for p in range(40)})


@pytest.mark.parametrize("part", [3, 64])
@pytest.mark.parametrize("chiefs", [2, 64])
def test_pairs_equal_brute_force(spark, monkeypatch, part, chiefs):
    monkeypatch.setattr(baskets, "PART", part)
    monkeypatch.setattr(baskets, "CHIEFS", chiefs)
    t = uneven_shop(spark)
    item = {(r.product_name, r.category): 0 for r in t.products.collect()}
    named = {r.product_id: (r.product_name, r.category) for r in t.products.collect()}
    for name in item:
        item[name] = min(p for p, n in named.items() if n == name)
    by_order = {}
    for r in t.sales.collect():
        by_order.setdefault(r.order_id, []).append(r.product_id)
    counts = {}
    for products in by_order.values():
        for a in products:
            for b in products:
                if a < b:
                    pair = (item[named[a]], item[named[b]])
                    counts[pair] = counts.get(pair, 0) + 1
    best = sorted(((-n, a, b) for (a, b), n in counts.items()))[:30]
    got = [(-r.n, r.item_a, r.item_b) for r in baskets.top_pairs(t, 30).collect()]
    assert got == best


def test_equal_baskets_meet_in_any_order(spark):
    lines = [(1, 1, 1, 1, 0), (1, 2, 1, 1, 0), (2, 2, 1, 1, 0), (2, 1, 1, 1, 0), (3, 1, 1, 1, 0), (3, 1, 1, 1, 0)]
    got = [(r.products, r.order_count) for r in scripts.product_combinations(shop(spark, lines)).collect()]
    assert got == [(["p1", "p2"], 2), (["p1", "p1"], 1)]


def test_largest_orders_show_every_line(spark):
    t = uneven_shop(spark)
    top = core.cross_sell_orders(t).first()
    assert top.order_id == 0 and top.product_count == 45 and len(top.categories_list) == 45
    sizes = {r.product_count: r.orders for r in reports.basket_size_histogram(t).collect()}
    assert sizes[45] == 1


# -- names, views, pipeline --------------------------------------------------


def test_unknown_names_list_the_known(spark):
    with pytest.raises(ValueError, match="rfm_segmentation"):
        run_named("nothing", None)
    assert set(list_queries()) == set(ANALYSES)


def test_one_failure_does_not_stop_the_others(spark, tmp_path):
    g = Gold(shop(spark, [(1, 1, 1, 1, 0), (1, 2, 1, 1, 0)]), "2024-03-01")
    results, failed = run_all(g, ["top_customers", "nothing", "basket_categories"], str(tmp_path))
    assert list(results) == ["top_customers", "basket_categories"] and list(failed) == ["nothing"]
    assert spark.read.option("header", "true").csv(str(tmp_path / "basket_categories")).first().cats == '["Food"]'


def test_analysts_see_no_personal_columns(spark):
    g = Gold(shop(spark, [(1, 1, 1, 1, 0)]), "2024-03-01")
    read = lambda name: getattr(g, name)
    analyst_view(read, "customer_analytics", "seen_by_analysts_")
    assert "email" not in spark.table("seen_by_analysts_customer_analytics").columns
    for table in ("customers", "employees", "silver.customers"):
        with pytest.raises(PermissionError):
            analyst_view(read, table)


def test_lines_of_unknown_products_count_nowhere(spark):
    t = shop(spark, [(1, 1, 1, 10, 0), (1, 2, 1, 90, 0), (2, 2, 1, 50, 0)], {1: (1, date(2024, 1, 1)), 2: (2, date(2024, 1, 2))}, {1: ("p1", "Food", 10)})
    rows = features.customer_features(t, "2024-02-01").collect()
    assert [(r.customer_id, float(r.monetary), r.frequency) for r in rows] == [(1, 10.0, 1)]


def test_a_failure_that_comes_while_running_is_isolated(spark, monkeypatch):
    g = Gold(shop(spark, [(1, 1, 1, 1, 0), (1, 2, 1, 1, 0)]), "2024-03-01")
    broken = lambda gold: gold.retail.customers.withColumn("x", F.raise_error(F.lit("broken")))
    monkeypatch.setitem(ANALYSES, "broken", broken)
    results, failed = run_all(g, ["broken", "top_customers"])
    assert list(results) == ["top_customers"] and "broken" in failed["broken"]


def test_orders_of_unknown_customers_take_no_scores(spark):
    """Ten customers buy; the table knows five of them, who get the five scores."""
    t = shop(spark, [(o, 1, 1, 10 * o, 0) for o in range(1, 11)], {o: (o, date(2024, 1, o)) for o in range(1, 11)})
    known = copy.copy(t)
    known.customers = t.customers.where("customer_id % 2 = 0")
    got = run_named("rfm_analysis", Gold(known, "2024-03-01")).collect()
    assert sorted(r.recency_score for r in got) == [1, 2, 3, 4, 5]
    got = run_named("rfm_segmentation", Gold(known, "2024-03-01")).collect()
    assert sorted(r.m_score for r in got) == [1, 2, 3, 4, 5]


def test_layers_end_to_end(spark, tmp_path):
    orders = {o: (o % 10, date(2024, 1, 1) + timedelta(days=o)) for o in range(60)}
    t = shop(spark, [(o, o % 4, 1 + o % 3, 20 + o, 5) for o in orders], orders)
    sources = {n: t.table(n) for n in ("customers", "products", "employees", "stores", "orders", "sales")}
    sources["stores"] = sources["stores"].drop("region")
    lake = Medallion(spark, str(tmp_path / "lake"), sources.__getitem__, "2024-06-01")
    seconds = lake.run("bronze") | lake.run("silver") | lake.run("gold")
    assert list(seconds) == ["bronze", "silver", "gold"]
    g = lake.gold_tables()
    revenue = t.sales.agg(F.sum("total")).first()[0]
    assert g.daily_sales_summary.agg(F.sum("total_revenue")).first()[0] == revenue
    assert g.customer_analytics.agg(F.sum("lifetime_value")).first()[0] == revenue
    classes = extended.abc_summary(g).agg(F.sum("total_revenue")).first()[0]
    assert classes == revenue
    names = ("rfm_segmentation", "employee_performance", "monthly_revenue", "ath_cross_sell_pairs", "executive_kpis")
    results, failed = lake.analytics(names=names)
    assert not failed
    for name in ("rfm_segmentation", "employee_performance", "monthly_revenue"):
        assert results[name].count() > 0
    assert results["ath_cross_sell_pairs"].count() == 0  # every order has one product
    with pytest.raises(ValueError):
        lake.run("platinum")


def test_a_very_wide_order(spark):
    """One order of 2,000 products beside small ones that repeat a pair: two million pairs, counted in parts."""
    lines = [(0, p, 1, 1, 0) for p in range(2000)] + [(o, p, 1, 1, 0) for o in range(1, 40) for p in (1, 2)]
    got = [tuple(r) for r in baskets.top_pairs(shop(spark, lines), 3).select("item_a", "item_b", "n").collect()]
    assert got == [(1, 2, 40), (0, 1, 1), (0, 2, 1)]
