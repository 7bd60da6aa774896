"""Raw and cleaned layers in DuckDB SQL, over the same injected defects."""

from __future__ import annotations

from oracles.base import amount, half_up, over_tables, pct, with_tables
from oracles.gold import ORACLE as GOLD

STAMP = "TIMESTAMP '2001-08-02 06:00:00'"
AUDIT = f"{STAMP} AS ingestion_timestamp, 'postgresql' AS source_system, 1 AS data_version"
DONE = f"{STAMP} AS processed_timestamp"

_RAW = {
    "customers": """
raw AS (
  SELECT * REPLACE (CASE WHEN customer_id % 50 = 7 THEN NULL ELSE email END AS email,
                    CASE WHEN customer_id % 61 = 5 THEN NULL ELSE first_name END AS first_name,
                    ' ' || lower(city) || '  ' AS city)
  FROM customers
  UNION ALL
  SELECT * REPLACE (customer_id + 1000000000 AS customer_id, ' ' || upper(email) AS email) FROM customers
),
bronze AS (SELECT * FROM raw WHERE customer_id IS NOT NULL AND first_name IS NOT NULL AND email IS NOT NULL)""",
    "products": """
raw AS (
  SELECT * REPLACE (CASE WHEN product_id % 83 = 2 THEN NULL ELSE product_name END AS product_name,
                    CASE WHEN product_id % 71 = 3 THEN 0 ELSE price_c END AS price_c)
  FROM products
),
bronze AS (SELECT * FROM raw WHERE product_id IS NOT NULL AND product_name IS NOT NULL)""",
    "employees": """
raw AS (
  SELECT * REPLACE (CASE WHEN employee_id % 11 = 6 THEN 1999900 ELSE salary_c END AS salary_c,
                    CASE WHEN employee_id % 9 = 4 THEN NULL ELSE employee_id END AS employee_id)
  FROM employees
),
bronze AS (SELECT * FROM raw WHERE employee_id IS NOT NULL)""",
    "stores": """
raw AS (
  SELECT CASE WHEN store_id % 14 = 13 THEN NULL ELSE store_id END AS store_id, store_name, city,
         (['usa', ' UK ', 'canada', 'germany', 'FRANCE', 'australia', 'Japan', 'atlantis'])[store_id % 8 + 1] AS country
  FROM stores
),
bronze AS (SELECT * FROM raw WHERE store_id IS NOT NULL)""",
    "ord": """
raw AS (
  SELECT * REPLACE (CASE WHEN order_id % 89 = 1 THEN NULL ELSE order_date END AS order_date,
                    CASE WHEN order_id % 13 = 6 THEN 'refunded' ELSE status END AS status)
  FROM ord
),
bronze AS (SELECT * FROM raw WHERE order_id IS NOT NULL AND order_date IS NOT NULL)""",
    "sales": """
raw AS (
  SELECT * REPLACE (CASE WHEN order_id % 101 = 9 THEN 0 ELSE quantity END AS quantity,
                    CASE WHEN order_id % 103 = 8 THEN -1000000 ELSE price_u END AS price_u,
                    CASE WHEN order_id % 47 = 1 THEN total_c + 1 ELSE total_c END AS total_c)
  FROM sales
),
bronze AS (SELECT * FROM raw WHERE sale_id IS NOT NULL AND order_id IS NOT NULL
           AND product_id IS NOT NULL AND quantity > 0 AND price_u > 0)""",
}

_INITCAP = (
    "array_to_string(list_transform(string_split(lower(trim({c})), ' '),"
    " lambda w: upper(w[1]) || w[2:]), ' ')"
)


def _initcap(c: str) -> str:
    return _INITCAP.format(c=c)


def _on(table: str, body: str) -> str:
    return with_tables(f"WITH {_RAW[table].strip()}\n{body.strip()}", table)


_CUSTOMER = "customer_id, first_name, last_name, gender, email, city, country, join_date"
_SALE_AMOUNTS = (
    f"sale_id, order_id, product_id, quantity, CAST(price_u AS DOUBLE) / 1000000 AS unit_price,"
    f" CAST(discount AS DOUBLE) AS discount, {amount('total_c')} AS total, {amount('profit_c')} AS profit"
)
_NULLS = ", ".join(
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls_{c}" for c in _CUSTOMER.split(", ")
)
_LAKE = f"{STAMP} AS __ingested_at, 'rds_postgresql' AS __source"

ORACLE = {
    "add_audit_columns": with_tables(f"SELECT *, {AUDIT} FROM stores", "stores"),
    "bronze_customers": _on("customers", f"SELECT {_CUSTOMER}, {AUDIT} FROM bronze"),
    "bronze_products": _on("products", f"""
SELECT product_id, product_name, category, {amount('cost_c')} AS cost_price,
       {amount('price_c')} AS selling_price, stock, {AUDIT} FROM bronze"""),
    "bronze_employees": _on("employees", f"""
SELECT employee_id, employee_name, department, {amount('salary_c')} AS salary, {AUDIT} FROM bronze"""),
    "bronze_stores": _on("stores", f"SELECT *, {AUDIT} FROM bronze"),
    "bronze_orders": _on("ord", f"SELECT *, {AUDIT} FROM bronze"),
    "bronze_sales": _on("sales", f"SELECT {_SALE_AMOUNTS}, {AUDIT} FROM bronze"),
    "bronze_generic": _on("ord", f"SELECT *, {_LAKE} FROM raw"),
    "data_quality": _on("customers", f"""
SELECT count(*) AS total_records, {_NULLS},
       (SELECT count(*) FROM (SELECT 1 FROM raw GROUP BY ALL, {_CUSTOMER} HAVING count(*) > 1)) AS duplicates,
       'struct<customer_id:bigint,first_name:string,last_name:string,gender:string,email:string,'
       || 'city:string,country:string,join_date:date>' AS schema
FROM raw""".replace("GROUP BY ALL, ", "GROUP BY ")),
    "dedupe_first": _on("customers", f"""
SELECT {_CUSTOMER} FROM bronze
QUALIFY row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY customer_id) = 1""".replace(
        "email, city", "lower(trim(email)) AS email, city")),
    "silver_customers": _on("customers", f"""
SELECT customer_id, upper(trim(first_name)) AS first_name, upper(trim(last_name)) AS last_name,
       CASE WHEN gender IN ('Male', 'Female') THEN gender ELSE 'Unknown' END AS gender,
       lower(trim(email)) AS email, {_initcap('city')} AS city, {_initcap('country')} AS country, join_date,
       regexp_matches(lower(trim(email)), '^[a-z0-9._%+\\-]+@[a-z0-9.\\-]+\\.[a-z]{{2,}}$') AS email_valid,
       {AUDIT}, {DONE}
FROM bronze QUALIFY row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY customer_id) = 1"""),
    "silver_products": _on("products", f"""
SELECT product_id, product_name,
       CASE category WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large' WHEN 'MEDIUM' THEN 'Medium'
            WHEN 'PROMO' THEN 'Promo' WHEN 'SMALL' THEN 'Small' ELSE 'Unknown' END AS category,
       {amount('cost_c')} AS cost_price, {amount('price_c')} AS selling_price, stock,
       {pct('price_c - cost_c', 'price_c')} AS profit_margin,
       {amount('stock * cost_c')} AS stock_value,
       CASE WHEN price_c < 10000 THEN 'Budget' WHEN price_c < 30000 THEN 'Mid-Range' ELSE 'Premium' END AS price_tier,
       {AUDIT}, {DONE}
FROM bronze"""),
    "silver_employees": _on("employees", f"""
SELECT employee_id, employee_name, department, {amount('salary_c')} AS salary,
       salary_c BETWEEN 2000000 AND 20000000 AS salary_valid,
       CASE WHEN salary_c < 5000000 THEN 'Entry' WHEN salary_c < 8000000 THEN 'Mid'
            WHEN salary_c < 12000000 THEN 'Senior' ELSE 'Executive' END AS salary_tier, {AUDIT}, {DONE}
FROM bronze"""),
    "silver_stores": _on("stores", f"""
SELECT store_id, store_name, {_initcap('city')} AS city, {_initcap('country')} AS country,
       CASE lower(trim(country)) WHEN 'usa' THEN 'North America' WHEN 'canada' THEN 'North America'
            WHEN 'uk' THEN 'Europe' WHEN 'germany' THEN 'Europe' WHEN 'france' THEN 'Europe'
            WHEN 'australia' THEN 'Oceania' WHEN 'japan' THEN 'Asia' ELSE 'Other' END AS region,
       {AUDIT}, {DONE}
FROM bronze"""),
    "silver_orders": _on("ord", f"""
SELECT order_id, customer_id, employee_id, store_id, order_date,
       CASE WHEN status IN ('Completed', 'Pending', 'Cancelled', 'Shipped') THEN status ELSE 'Unknown' END AS status,
       CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
       CAST(day(order_date) AS INTEGER) AS order_day, CAST(quarter(order_date) AS INTEGER) AS order_quarter,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_weekday,
       CAST(weekofyear(order_date) AS INTEGER) AS order_week, {AUDIT}, {DONE}
FROM bronze"""),
    "silver_sales": _on("sales", f"""
SELECT {_SALE_AMOUNTS},
       total_c = (quantity * price_u * (100 - discount) + 500000) // 1000000 AS total_valid,
       profit_c >= 0 AS profit_valid,
       CAST((quantity * price_u * discount + 50) // 100 AS DOUBLE) / 1000000 AS discount_amount,
       {half_up('total_c', '(100 * quantity)', 6)} AS revenue_per_unit,
       {pct('profit_c', 'total_c')} AS profit_margin,
       CASE WHEN total_c < 10000 THEN 'Small' WHEN total_c < 50000 THEN 'Medium' ELSE 'Large' END AS sales_tier,
       {AUDIT}, {DONE}
FROM bronze"""),
    "silver_generic": _on("ord", f"""
SELECT * , {_LAKE}, {STAMP} AS __silver_processed_at, 'silver' AS __layer FROM raw"""),
}


# -- what the layer tables hold ---------------------------------------------

_CELL = """CASE WHEN typeof(COLUMNS(*)) = 'DOUBLE'
  THEN CAST(CAST(round(TRY_CAST(CAST(COLUMNS(*) AS VARCHAR) AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)
  ELSE CAST(COLUMNS(*) AS VARCHAR) END AS "\\0\""""


def _content(layer: str, table: str, key: str, without: str = "") -> str:
    """Per column: filled cells, and a sum over their md5."""
    sql = _GOLD[key] if layer == "gold" else ORACLE[key]
    rows = f"SELECT * EXCLUDE ({without}) FROM ({sql}\n)" if without else sql
    return f"""
SELECT '{layer}' AS layer, '{table}' AS table_name, column_name, count(*) AS filled,
       CAST(sum(CAST('0x' || md5(cell)[1:8] AS BIGINT)) AS BIGINT) AS checksum
FROM (UNPIVOT (SELECT {_CELL} FROM ({rows}
)) ON COLUMNS(*) INTO NAME column_name VALUE cell) GROUP BY column_name"""


_TABLES = ("customers", "products", "employees", "stores", "orders", "sales")


def _contents(without_stamps: bool = False) -> dict[str, list[str]]:
    raw, done = ("ingestion_timestamp", "ingestion_timestamp, processed_timestamp") if without_stamps else ("", "")
    return {
        "bronze": [_content("bronze", n, f"bronze_{n}", raw) for n in _TABLES],
        "silver": [_content("silver", n, f"silver_{n}", done) for n in _TABLES],
    }


# The cleaned tables in the form of the base tables, amounts in cents.
_CLEANED = {
    "customers": _on("customers", f"""
SELECT customer_id, upper(trim(first_name)) AS first_name, upper(trim(last_name)) AS last_name,
       CASE WHEN gender IN ('Male', 'Female') THEN gender ELSE 'Unknown' END AS gender,
       lower(trim(email)) AS email, {_initcap('city')} AS city, {_initcap('country')} AS country, join_date
FROM bronze QUALIFY row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY customer_id) = 1"""),
    "products": _on("products", """
SELECT * REPLACE (CASE WHEN category IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL')
                       THEN category[1] || lower(category[2:]) ELSE 'Unknown' END AS category)
FROM bronze"""),
    "stores": f"SELECT store_id, store_name, city, country, region FROM (\n{ORACLE['silver_stores']}\n)",
    "ord": _on("ord", """
SELECT * REPLACE (CASE WHEN status IN ('Completed', 'Pending', 'Cancelled', 'Shipped') THEN status ELSE 'Unknown' END AS status)
FROM bronze"""),
    "sales": _on("sales", "SELECT * FROM bronze"),
}
_GOLD_TABLES = (
    "daily_sales_summary", "customer_analytics", "product_performance", "store_performance", "monthly_time_series"
)
# What gold tables carry over from the cleaned ones beside those columns.
_CARRIED = {
    "customer_analytics": ("silver_customers", "customer_id", "email_valid, source_system, data_version"),
    "product_performance": ("silver_products", "product_id", "price_tier, stock_value, source_system, data_version"),
    "store_performance": ("silver_stores", "store_id", "source_system, data_version"),
}


def _gold(table: str) -> str:
    sql = over_tables(GOLD[f"gold_{table}"], **_CLEANED)
    if table not in _CARRIED:
        return sql
    silver, key, columns = _CARRIED[table]
    return f"SELECT * FROM (\n{sql}\n) JOIN (SELECT {key}, {columns} FROM (\n{ORACLE[silver]}\n)) USING ({key})"


_GOLD = {f"gold_{n}": _gold(n) for n in _GOLD_TABLES}
_STORED = _contents(without_stamps=True)

ORACLE |= {
    "bronze_ingest_all": "\nUNION ALL ".join(_contents()["bronze"]),
    "silver_process_all": "\nUNION ALL ".join(_contents()["silver"]),
    "run_layers": "\nUNION ALL ".join([*_STORED["bronze"], *_STORED["silver"], *[_content("gold", n, f"gold_{n}") for n in _GOLD_TABLES]]),
}
