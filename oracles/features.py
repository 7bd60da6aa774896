"""Feature tables and measures in DuckDB SQL."""

from __future__ import annotations

from oracles.base import TODAY, amount, half_up, half_up_int, money_avg, with_tables
from oracles.gold import on_daily
from oracles.reports import TYPES


def _flags(column: str, values, prefix: str) -> str:
    return ", ".join(
        f"CAST({column} = '{v}' AS INTEGER) AS {prefix}_{v.replace('-', '_').lower()}" for v in values
    )


_CUSTOMER = f"""
lines AS (
  SELECT o.customer_id, o.order_id, o.order_date, o.store_id, s.total_c, s.discount, s.profit_c, p.category
  FROM ord o JOIN sales s ON o.order_id = s.order_id JOIN products p ON s.product_id = p.product_id
),
base AS (
  SELECT customer_id, {TODAY} - max(order_date) AS recency_days, count(DISTINCT order_id) AS frequency,
         CAST(sum(total_c) AS BIGINT) AS monetary_c, count(*) AS n,
         stddev(CAST(total_c AS DOUBLE) / 100) AS deviation, max(total_c) AS max_c, min(total_c) AS min_c,
         CAST(sum(discount) AS BIGINT) AS discount, CAST(sum(profit_c) AS BIGINT) AS profit_c,
         count(DISTINCT category) AS distinct_categories, count(DISTINCT store_id) AS distinct_stores,
         max(order_date) - min(order_date) AS order_span_days,
         count(DISTINCT CASE WHEN {TODAY} - order_date <= 30 THEN order_id END) AS orders_last_30d,
         count(DISTINCT CASE WHEN {TODAY} - order_date <= 90 THEN order_id END) AS orders_last_90d
  FROM lines GROUP BY customer_id
),
favourite AS (
  SELECT customer_id, category FROM lines GROUP BY customer_id, category
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) = 1
)"""

_CUSTOMER_ROWS = f"""
SELECT b.customer_id, recency_days, frequency, {amount('monetary_c')} AS monetary,
       {money_avg('monetary_c', 'n', 4)} AS avg_order_value, coalesce(round(deviation, 4), 0) AS std_order_value,
       {amount('max_c')} AS max_order_value, {amount('min_c')} AS min_order_value,
       {half_up('discount', 'n', 4)} AS avg_discount, {amount('profit_c')} AS profit_contribution,
       distinct_categories, distinct_stores, order_span_days, orders_last_30d, orders_last_90d,
       CAST(gender = 'Male' AS INTEGER) AS gender_male, {TODAY} - join_date AS tenure_days,
       CAST(recency_days > 90 AS INTEGER) AS is_churned, {amount('monetary_c')} AS lifetime_value,
       {_flags('f.category', TYPES, 'cat')}
FROM base b JOIN favourite f ON b.customer_id = f.customer_id JOIN customers c ON b.customer_id = c.customer_id"""

_ON = ("customers", "products", "ord", "sales")
# The fixed predictions the measures are checked on: few orders mean churn; orders estimate value.
_SCORED = f"""WITH {_CUSTOMER.strip()}, scored AS (
  SELECT CAST(recency_days > 90 AS INTEGER) AS y, CAST(frequency <= 9 AS INTEGER) AS p, -frequency AS score,
         CAST(monetary_c AS DOUBLE) / 100 AS v, frequency * 200000.0 AS e
  FROM base
)"""

ORACLE = {
    "customer_features": with_tables(f"WITH {_CUSTOMER.strip()}{_CUSTOMER_ROWS}", *_ON),
    "product_features": with_tables(f"""
WITH weekly AS (
  SELECT s.product_id, CAST(isoyear(o.order_date) AS INTEGER) AS year, CAST(weekofyear(o.order_date) AS INTEGER) AS week,
         CAST(sum(s.quantity) AS BIGINT) AS units_sold
  FROM sales s JOIN ord o ON s.order_id = o.order_id GROUP BY ALL
), lagged AS (
  SELECT *, coalesce(lag(units_sold, 1) OVER w, 0) AS lag_1w, coalesce(lag(units_sold, 2) OVER w, 0) AS lag_2w,
         coalesce(lag(units_sold, 4) OVER w, 0) AS lag_4w,
         avg(units_sold) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rolling_mean_4w
  FROM weekly WINDOW w AS (PARTITION BY product_id ORDER BY year, week)
), priced AS (
  SELECT *, CASE WHEN price_c < 10000 THEN 'Budget' WHEN price_c < 30000 THEN 'Mid-Range' ELSE 'Premium' END AS tier
  FROM products
)
SELECT l.*, {amount('cost_c')} AS cost_price, {amount('price_c')} AS selling_price,
       CAST({half_up_int('(price_c - cost_c) * 10000', 'price_c')} AS DOUBLE) / 100 AS product_profit_margin, stock,
       {_flags('category', TYPES, 'cat')}, {_flags('tier', ('Budget', 'Mid-Range', 'Premium'), 'tier')}
FROM lagged l JOIN priced p ON l.product_id = p.product_id""", "products", "ord", "sales"),
    "store_features": on_daily(f"""
SELECT sale_date, category, store_name, store_city, store_country, units_sold,
       {amount('revenue_c')} AS total_revenue, {amount('profit_c')} AS total_profit,
       {half_up('price_u', '(1000000 * lines)', 6)} AS avg_unit_price, order_count, unique_customers,
       {half_up('discount', 'lines', 6)} AS avg_discount,
       CAST({half_up_int('10000 * CAST(profit_c AS HUGEINT)', 'revenue_c')} AS DOUBLE) / 100 AS profit_margin,
       year(sale_date) AS year, month(sale_date) AS month, day(sale_date) AS day, quarter(sale_date) AS quarter,
       dayname(sale_date) AS weekday, dayofweek(sale_date) + 1 AS dow, day(sale_date) AS dom,
       month(sale_date) AS mth, year(sale_date) AS yr,
       coalesce({amount('lag(revenue_c, 1) OVER w')}, 0) AS revenue_lag1,
       coalesce({amount('lag(revenue_c, 7) OVER w')}, 0) AS revenue_lag7,
       {money_avg('sum(revenue_c) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)',
                  'count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 6)} AS revenue_ma7
FROM daily WINDOW w AS (PARTITION BY store_name ORDER BY sale_date, category, store_city, store_country)"""),
    "evaluate_classifier": with_tables(f"""
{_SCORED}, ranked AS (
  SELECT y, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
  FROM scored
), m AS (
  SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
         count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = p) AS ok, count(*) AS n
  FROM scored
), a AS (
  SELECT (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
         / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc
  FROM ranked
)
SELECT round(ok::DOUBLE / n, 6) AS accuracy, round(tp::DOUBLE / (tp + fp), 6) AS precision,
       round(tp::DOUBLE / (tp + fn), 6) AS recall, round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1,
       round(auc::DOUBLE, 6) AS roc_auc
FROM m, a""", *_ON),
    "classification_report": with_tables(f"""
{_SCORED}, c AS (
  SELECT cls, count(*) FILTER (WHERE y = cls AND p = cls) AS tp, count(*) FILTER (WHERE y <> cls AND p = cls) AS fp,
         count(*) FILTER (WHERE y = cls AND p <> cls) AS fn, count(*) FILTER (WHERE y = cls) AS support
  FROM scored, (VALUES (0), (1)) t(cls) GROUP BY cls
)
SELECT CASE cls WHEN 0 THEN 'Active' ELSE 'Churned' END AS class, round(tp::DOUBLE / (tp + fp), 6) AS precision,
       round(tp::DOUBLE / (tp + fn), 6) AS recall, round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1, support
FROM c""", *_ON),
    "evaluate_regressor": with_tables(f"""
{_SCORED}
SELECT round(avg(abs(v - e)), 4) AS mae, round(sqrt(avg((v - e) * (v - e))), 4) AS rmse,
       round(1 - sum((v - e) * (v - e)) / (var_pop(v) * count(*)), 6) AS r2,
       round(avg(abs(v - e) / greatest(abs(v), 1e-9)) * 100, 6) AS mape
FROM scored""", *_ON),
}
