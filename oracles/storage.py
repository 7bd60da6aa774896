"""What comes back from sources, sinks and the catalog, in DuckDB SQL."""

from __future__ import annotations

from oracles.base import amount, with_tables
from oracles.gold import ORACLE as GOLD

_ORDERS = with_tables("SELECT * FROM ord", "ord")
_COUNTS = with_tables("""
SELECT 'customers' AS table_name, count(*) AS n FROM customers UNION ALL SELECT 'products', count(*) FROM products
UNION ALL SELECT 'employees', count(*) FROM employees UNION ALL SELECT 'stores', count(*) FROM stores
UNION ALL SELECT 'orders', count(*) FROM ord UNION ALL SELECT 'sales', count(*) FROM sales""",
    "customers", "products", "employees", "stores", "ord", "sales")

ORACLE = {
    "read_layer": _ORDERS,
    "write_layer": with_tables("SELECT order_id, customer_id, upper(status) AS status FROM ord", "ord"),
    "write_parquet_table": with_tables(f"""
SELECT product_id, product_name, category, {amount('cost_c')} AS cost_price, {amount('price_c')} AS selling_price, stock
FROM products""", "products"),
    "write_partitioned": with_tables(
        "SELECT *, CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month FROM ord", "ord"),
    "recover_partitions": with_tables(
        "SELECT CAST(year(order_date) AS INTEGER) AS year, count(*) AS n FROM ord GROUP BY 1", "ord"),
    "union_evolving": with_tables("""
SELECT customer_id, first_name, CAST(NULL AS VARCHAR) AS phone FROM customers
UNION ALL SELECT customer_id + 1000000000, NULL, 'p' || customer_id FROM customers""", "customers"),
    "union_evolving_types": with_tables("""
SELECT order_id, CASE WHEN order_id % 3 < 2 THEN CAST(order_date AS TIMESTAMP) END AS at,
       CASE order_id % 3 WHEN 0 THEN CAST(customer_id AS VARCHAR) WHEN 1 THEN 'C' || customer_id END AS buyer,
       CASE order_id % 3 WHEN 2 THEN upper(status) ELSE status END AS status,
       CAST(CASE order_id % 3 WHEN 1 THEN month(order_date) WHEN 2 THEN day(order_date) END AS INTEGER) AS month
FROM ord""", "ord"),
    "export_csv": with_tables("SELECT order_id, order_date, status FROM ord", "ord"),
    "register_views": _COUNTS,
    "register_tables": _COUNTS,
    "analyst_view": f"SELECT * EXCLUDE (email) FROM (\n{GOLD['gold_customer_analytics']}\n)",
    "auditor_view": with_tables("""
SELECT order_id, customer_id, order_date, status, CASE WHEN status = 'Pending' THEN true END AS __cdc_deleted,
       CASE WHEN status = 'Pending' THEN 'DELETE' END AS __cdc_op,
       CASE WHEN status = 'Pending' THEN TIMESTAMP '2001-08-01' + INTERVAL 1 DAY * (order_id % 3)
            + INTERVAL 3 SECOND END AS __cdc_ts
FROM ord""", "ord"),
}
