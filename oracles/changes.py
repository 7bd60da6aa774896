"""Change events and history in DuckDB SQL."""

from __future__ import annotations

from oracles.base import with_tables

_AT = "TIMESTAMP '2001-08-01' + INTERVAL 1 DAY * (order_id % 3) + INTERVAL 1 MILLISECOND * "
_ROW = "order_id, customer_id, order_date"

EVENTS = f"""
events AS (
  SELECT {_ROW}, 'stale' AS status, 'u' AS __kind, {_AT} 1000 AS __ts FROM ord
  UNION ALL SELECT {_ROW}, upper(status), 'u', {_AT} 2000 FROM ord
  UNION ALL SELECT {_ROW}, status, 'r', {_AT} 500 FROM ord WHERE status = 'Completed'
  UNION ALL SELECT {_ROW}, upper(status), 'd', {_AT} 3000 FROM ord WHERE status = 'Pending'
  UNION ALL SELECT order_id + 1000000000000, customer_id, order_date, status, 'c', {_AT} 4000
  FROM ord WHERE status = 'Shipped'
)"""

_ADDED = f"""
  SELECT order_id + 1000000000000 AS order_id, customer_id, order_date, status, false AS __cdc_deleted,
         'INSERT' AS __cdc_op, {_AT} 4000 AS __cdc_ts
  FROM ord WHERE status = 'Shipped'"""

MERGED = with_tables(f"""
SELECT {_ROW}, upper(status) AS status, status = 'Pending' AS __cdc_deleted,
       CASE WHEN status = 'Pending' THEN 'DELETE' ELSE 'UPDATE' END AS __cdc_op,
       CASE WHEN status = 'Pending' THEN {_AT} 3000 ELSE {_AT} 2000 END AS __cdc_ts
FROM ord UNION ALL {_ADDED}""", "ord")

_SPLIT = with_tables(f"WITH {EVENTS.strip()} SELECT * FROM events", "ord")

ORACLE = {
    "read_cdc_json": _SPLIT,
    "read_cdc_op": with_tables(
        f"""WITH {EVENTS.strip()}
SELECT * EXCLUDE (__kind, __ts), CASE __kind WHEN 'u' THEN 'U' WHEN 'd' THEN 'D' ELSE 'I' END AS Op,
       __ts AS __dms_timestamp, strftime(__ts, '%Y%m%d') AS day FROM events""", "ord"),
    "cdc_split": _SPLIT,
    "quarantine_events": with_tables(f"""
WITH {EVENTS.strip()}
SELECT CASE order_id % 7 WHEN 1 THEN 'malformed' WHEN 2 THEN 'unknown op' WHEN 3 THEN 'no envelope'
       WHEN 4 THEN 'no row' ELSE 'accepted' END AS reason, count(*) AS lines
FROM events GROUP BY ALL""", "ord"),
    "load_since_mark": with_tables("""
SELECT order_id, CASE WHEN order_date >= DATE '1998-06-30' AND order_id % 5 = 0 THEN upper(status) ELSE status END AS status,
       CAST(order_date AS TIMESTAMP) AS updated_at
FROM ord WHERE order_date >= DATE '1998-06-30' OR order_id % 3 > 0""", "ord"),
    "cdc_upsert": with_tables(f"""
SELECT {_ROW}, upper(status) AS status, false AS __cdc_deleted, 'UPDATE' AS __cdc_op, {_AT} 2000 AS __cdc_ts
FROM ord UNION ALL {_ADDED}""", "ord"),
    "cdc_soft_delete": with_tables(f"""
SELECT {_ROW}, status, CASE WHEN status = 'Pending' THEN true END AS __cdc_deleted,
       CASE WHEN status = 'Pending' THEN 'DELETE' END AS __cdc_op,
       CASE WHEN status = 'Pending' THEN {_AT} 3000 END AS __cdc_ts
FROM ord""", "ord"),
    "cdc_counts": with_tables(f"""
WITH {EVENTS.strip()}
SELECT count(*) FILTER (WHERE __kind IN ('c', 'r')) AS inserts, count(*) FILTER (WHERE __kind = 'u') AS updates,
       count(*) FILTER (WHERE __kind = 'd') AS deletes
FROM events""", "ord"),
    "cdc_apply_op": MERGED,
    "cdc_stream_merge": MERGED,
    "incremental_by_updated_at": with_tables(
        "SELECT order_id, status, CAST(order_date AS TIMESTAMP) AS updated_at FROM ord"
        " WHERE order_date > DATE '2000-06-30'", "ord"),
    "scd2": with_tables("""
WITH h AS (
  SELECT customer_id, order_date, arg_max(status, order_id) AS status FROM ord GROUP BY ALL
), c AS (
  SELECT * FROM h
  QUALIFY lag(status) OVER (PARTITION BY customer_id ORDER BY order_date) IS DISTINCT FROM status
), v AS (
  SELECT customer_id, order_date AS effective_from, status,
         lead(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS effective_to
  FROM c
)
SELECT *, effective_to IS NULL AS is_current FROM v""", "ord"),
    "scd2_merge": with_tables("""
WITH new_city AS (
  SELECT customer_id, city, upper(country) || CASE WHEN customer_id % 3 = 0 THEN '*' ELSE '' END AS country FROM customers
)
SELECT c.customer_id, DATE '1995-01-01' AS effective_from, c.city, c.country,
       CASE WHEN c.country <> n.country THEN DATE '2001-08-02' END AS effective_to, c.country = n.country AS is_current
FROM customers c JOIN new_city n ON c.customer_id = n.customer_id
UNION ALL
SELECT c.customer_id, DATE '2001-08-02', c.city, n.country, NULL, true
FROM customers c JOIN new_city n ON c.customer_id = n.customer_id WHERE c.country <> n.country""", "customers"),
    "scd2_snapshots": with_tables("""
WITH days AS (SELECT unnest([DATE '1996-12-31', DATE '1998-12-31', DATE '2000-12-31']) AS seen), grid AS (
  SELECT c.customer_id, d.seen, arg_max(o.status, (o.order_date, o.order_id)) FILTER (WHERE o.order_date <= d.seen) AS last_status
  FROM (SELECT DISTINCT customer_id FROM ord) c CROSS JOIN days d JOIN ord o ON o.customer_id = c.customer_id
  GROUP BY ALL
), held AS (
  SELECT customer_id, seen, CASE WHEN seen = DATE '1998-12-31' AND customer_id % 5 = 0 THEN NULL ELSE last_status END AS status
  FROM grid
), borders AS (
  SELECT * FROM held
  QUALIFY lag(status) OVER (PARTITION BY customer_id ORDER BY seen) IS DISTINCT FROM status
), spans AS (
  SELECT customer_id, seen AS effective_from, status, lead(seen) OVER (PARTITION BY customer_id ORDER BY seen) AS effective_to
  FROM borders
)
SELECT *, effective_to IS NULL AS is_current FROM spans WHERE status IS NOT NULL""", "ord"),
}
