"""Raw and cleaned layers on hand-written rows."""

from datetime import date
from decimal import Decimal

import pytest

from shopgrain.operators import bronze, silver


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_bronze_sales_keeps_only_sound_rows(spark):
    raw = spark.createDataFrame(
        [(1, 1, 1, 2, 3.0), (None, 1, 1, 2, 3.0), (3, 1, 1, 0, 3.0), (4, 1, 1, 1, -1.0), (5, 1, None, 1, 1.0)],
        "sale_id int, order_id int, product_id int, quantity int, unit_price double",
    )
    kept = bronze.bronze_sales(raw)
    assert rows(kept, "sale_id", "source_system", "data_version") == [(1, "postgresql", 1)]
    assert "ingestion_timestamp" in kept.columns


def test_bronze_filters_nulls(spark):
    raw = spark.createDataFrame(
        [(1, "A", "a@x.com"), (2, None, "b@x.com"), (3, "C", None), (None, "D", "d@x.com")],
        "customer_id int, first_name string, email string",
    )
    assert rows(bronze.bronze_customers(raw), "customer_id") == [(1,)]
    orders = spark.createDataFrame([(1, date(2024, 1, 1)), (2, None)], "order_id int, order_date date")
    assert rows(bronze.bronze_orders(orders), "order_id") == [(1,)]


def test_ingest_all_opens_every_table(spark):
    opened = []

    def read(name):
        opened.append(name)
        columns = [*bronze.REQUIRED[name], *bronze.POSITIVE.get(name, ())]
        return spark.createDataFrame([tuple([1] * len(columns))], ", ".join(f"{c} int" for c in columns))

    result = bronze.bronze_ingest_all(read)
    assert list(result) == opened and len(result) == 6


def test_data_quality_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None), (2, None)], "x int, y string")
    r = bronze.data_quality(df).first().asDict()
    assert r == {
        "total_records": 5,
        "nulls_x": 1,
        "nulls_y": 3,
        "duplicates": 2,
        "schema": "struct<x:int,y:string>",
    }
    empty = bronze.data_quality(df.limit(0)).first()
    assert (empty.total_records, empty.nulls_x, empty.duplicates) == (0, 0, 0)


def test_customers_meet_under_one_spelling(spark):
    raw = spark.createDataFrame(
        [
            (2, " ann ", "lee", "Female", " a@x.com ", " new york ", "usa", date(2020, 1, 1)),
            (1, "Ann", "Lee", "female", "A@X.com", "york", " uk", date(2020, 1, 1)),
            (3, "Bob", "Ray", "Male", "bad@", "x", "y", date(2020, 1, 1)),
        ],
        "customer_id int, first_name string, last_name string, gender string, email string,"
        " city string, country string, join_date date",
    )
    assert rows(
        silver.silver_customers(raw), "customer_id", "first_name", "gender", "email", "city", "country", "email_valid"
    ) == [
        (1, "ANN", "Unknown", "a@x.com", "York", "Uk", True),
        (3, "BOB", "Male", "bad@", "X", "Y", False),
    ]


def test_cleaning_twice_changes_nothing(spark):
    raw = spark.createDataFrame(
        [(1, " ann ", "lee", "x", " A@x.com", "a b", "uk", date(2020, 1, 1))],
        "customer_id int, first_name string, last_name string, gender string, email string,"
        " city string, country string, join_date date",
    )
    once = silver.silver_customers(raw, "2024-01-01")
    twice = silver.silver_customers(once.drop("email_valid", "processed_timestamp"), "2024-01-01")
    assert once.collect() == twice.collect()


def test_products(spark):
    raw = spark.createDataFrame(
        [
            (1, "Clothing", Decimal("50.00"), Decimal("99.99"), 2),
            (2, "Toys", Decimal("50.00"), Decimal("100.00"), 2),
            (3, None, Decimal("50.00"), Decimal("299.99"), 2),
            (4, "Food", Decimal("50.00"), Decimal("300.00"), 2),
            (5, "Food", Decimal("50.00"), Decimal("0.00"), 2),
        ],
        "product_id int, category string, cost_price decimal(18,2), selling_price decimal(18,2), stock int",
    )
    got = rows(silver.silver_products(raw), "product_id", "category", "price_tier", "profit_margin")
    assert got == [
        (1, "Apparel", "Budget", Decimal("49.99")),
        (2, "Unknown", "Mid-Range", Decimal("50.00")),
        (3, "Unknown", "Mid-Range", Decimal("83.33")),
        (4, "Food", "Premium", Decimal("83.33")),
        (5, "Food", "Budget", None),
    ]


def test_employees_borders(spark):
    raw = spark.createDataFrame(
        [(i, Decimal(s)) for i, s in enumerate([19999, 20000, 49999, 50000, 80000, 120000, 200000, 200001])],
        "employee_id int, salary decimal(18,2)",
    )
    got = [(r.salary_valid, r.salary_tier) for r in silver.silver_employees(raw).orderBy("employee_id").collect()]
    assert got == [
        (False, "Entry"),
        (True, "Entry"),
        (True, "Entry"),
        (True, "Mid"),
        (True, "Senior"),
        (True, "Executive"),
        (True, "Executive"),
        (False, "Executive"),
    ]


def test_stores_and_orders(spark):
    stores = spark.createDataFrame(
        [(1, " usa "), (2, "UK"), (3, "united states of america"), (4, None)], "store_id int, country string"
    ).selectExpr("*", "'x' AS city")
    assert rows(silver.silver_stores(stores), "store_id", "region") == [
        (1, "North America"),
        (2, "Europe"),
        (3, "Other"),
        (4, "Other"),
    ]
    orders = spark.createDataFrame(
        [(1, date(2024, 12, 30), "refunded"), (2, date(2024, 2, 29), "Completed")],
        "order_id int, order_date date, status string",
    )
    assert rows(silver.silver_orders(orders), "order_id", "status", "order_weekday", "order_week", "order_quarter") == [
        (1, "Unknown", 2, 1, 4),
        (2, "Completed", 5, 9, 1),
    ]


def test_sales_checks(spark):
    raw = spark.createDataFrame(
        [
            (1, 2, Decimal("10.00"), Decimal("10.5"), Decimal("17.90"), Decimal("1.00")),
            (2, 2, Decimal("10.00"), Decimal("10.5"), Decimal("17.91"), Decimal("-1.00")),
            (3, 1, Decimal("10.00"), Decimal("0"), Decimal("0.00"), Decimal("1.00")),
        ],
        "sale_id int, quantity int, unit_price decimal(18,2), discount decimal(5,2),"
        " total decimal(18,2), profit decimal(18,2)",
    )
    got = rows(silver.silver_sales(raw), "sale_id", "total_valid", "profit_valid", "discount_amount", "profit_margin")
    assert got == [
        (1, True, True, Decimal("2.100000"), Decimal("5.59")),
        (2, False, False, Decimal("2.100000"), Decimal("-5.58")),
        (3, False, True, Decimal("0.000000"), None),
    ]


def test_generic_keeps_latest_by_own_key(spark):
    raw = spark.createDataFrame(
        [(1, 7, " a ", "2024-01-01"), (1, 7, "b ", "2024-01-02"), (2, 7, "c", "2024-01-01"), (None, 7, "d", "2024-01-01")],
        "order_id int, customer_id int, status string, at string",
    ).selectExpr("order_id", "customer_id", "status", "CAST(at AS timestamp) AS __ingested_at")
    assert rows(silver.silver_generic("orders", raw), "order_id", "status", "__layer") == [
        (1, "b", "silver"),
        (2, "c", "silver"),
    ]


@pytest.mark.parametrize(
    "text, value", [("£1,234.50", Decimal("1234.50")), ("n/a", None), ("", None), ("12", Decimal("12.00"))]
)
def test_parse_money(spark, text, value):
    from shopgrain.functions.columns import parse_money

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_money("t").alias("v")).first().v == value
