"""Extended analyses in DuckDB SQL."""

from __future__ import annotations

from oracles.base import amount, half_up, half_up_int, money_avg, pct, with_tables
from oracles.core import DAILY_REVENUE, rfm_base, trailing
from oracles.gold import on_customers, on_daily, on_monthly, on_products

COHORTS = """
first_order AS (
  SELECT customer_id, CAST(date_trunc('month', min(order_date)) AS DATE) AS cohort_month FROM ord GROUP BY customer_id
),
activity AS (
  SELECT f.cohort_month, CAST(datediff('month', f.cohort_month, o.order_date) AS INTEGER) AS months_since,
         count(DISTINCT o.customer_id) AS customers
  FROM ord o JOIN first_order f ON o.customer_id = f.customer_id GROUP BY ALL
),
sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM first_order GROUP BY cohort_month)"""

SEGMENTS = f"""
{rfm_base().strip()},
scored AS (
  SELECT *, ntile(5) OVER (ORDER BY recency DESC, customer_id) AS r,
         ntile(5) OVER (ORDER BY frequency, customer_id) AS f,
         ntile(5) OVER (ORDER BY monetary_c, customer_id) AS m
  FROM base
),
segments AS (
  SELECT *, CASE WHEN r = 5 AND f >= 4 AND m >= 4 THEN 'Champions'
    WHEN r >= 4 AND f >= 3 AND m >= 3 THEN 'Loyal Customers' WHEN r >= 4 AND f <= 2 THEN 'New Customers'
    WHEN r = 3 AND f >= 3 THEN 'Potential Loyalists' WHEN r = 3 AND f <= 2 AND m >= 3 THEN 'Promising'
    WHEN r <= 2 AND f >= 4 AND m >= 4 THEN 'At Risk' WHEN r <= 2 AND f >= 3 AND m >= 3 THEN 'Cant Lose Them'
    WHEN r <= 2 AND f <= 2 AND m >= 3 THEN 'Hibernating' ELSE 'Lost' END AS segment
  FROM scored
)"""

ABC = f"""
abc AS (
  SELECT *, sum(revenue_c) OVER (ORDER BY revenue_c DESC, product_id ROWS UNBOUNDED PRECEDING) AS run,
         sum(revenue_c) OVER () AS whole
  FROM perf
),
classed AS (
  SELECT *, CASE WHEN run * 100 <= whole * 80 THEN 'A' WHEN run * 100 <= whole * 95 THEN 'B' ELSE 'C' END AS abc_class,
         CAST({half_up_int('10000 * CAST(profit_c AS HUGEINT)', 'revenue_c')} AS BIGINT) AS margin_h
  FROM abc
)"""

BASKET_SETS = """
sets AS (
  SELECT o.order_id, list_sort(list(DISTINCT p.category)) AS cats
  FROM ord o JOIN sales s ON o.order_id = s.order_id JOIN products p ON s.product_id = p.product_id
  GROUP BY o.order_id HAVING count(DISTINCT p.product_id) >= 2
),
combos AS (
  SELECT cats, count(*) AS order_count FROM sets GROUP BY cats ORDER BY order_count DESC, cats LIMIT 20
)"""

EMPLOYEES = """
staff AS (
  SELECT e.employee_id, e.employee_name, e.department, e.salary_c, count(DISTINCT o.order_id) AS orders_handled,
         CAST(sum(s.total_c) AS BIGINT) AS revenue_c, CAST(sum(s.profit_c) AS BIGINT) AS profit_c, count(*) AS lines
  FROM employees e JOIN ord o ON e.employee_id = o.employee_id JOIN sales s ON o.order_id = s.order_id GROUP BY ALL
)"""

STOCK = f"""
demand AS (
  SELECT s.product_id, CAST(sum(s.quantity) AS BIGINT) AS total_sold, count(DISTINCT s.order_id) AS order_count,
         max(o.order_date) - min(o.order_date) AS sales_days
  FROM sales s JOIN ord o ON s.order_id = o.order_id GROUP BY s.product_id
),
daily_need AS (
  SELECT p.product_id, product_name, category, stock, total_sold, order_count, sales_days,
         {half_up_int('total_sold * 1000', 'greatest(sales_days, 1)')} AS need_m
  FROM products p JOIN demand d ON p.product_id = d.product_id
),
risk AS (
  SELECT *, {half_up('stock * 1000', 'greatest(need_m, 10)')} AS days_of_cover FROM daily_need
),
status AS (
  SELECT *, CASE WHEN days_of_cover < 30 THEN 'STOCKOUT RISK' WHEN days_of_cover > 365 THEN 'OVERSTOCKED'
            ELSE 'OK' END AS inventory_status
  FROM risk
)"""

POINTS = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}


def points(cents: str) -> str:
    return ", ".join(f"{amount(f'quantile_disc({cents}, {p})')} AS {n}" for n, p in POINTS.items())


def stddev(cents: str) -> str:
    return f"round(stddev(CAST({cents} AS DOUBLE) / 100), 2)"


ANOMALIES = f"""
stats AS (
  SELECT category, avg(CAST(revenue_c AS DOUBLE) / 100) AS mu, stddev(CAST(revenue_c AS DOUBLE) / 100) AS sigma
  FROM daily GROUP BY category
),
odd AS (
  SELECT d.sale_date, d.category, revenue_c, round((CAST(revenue_c AS DOUBLE) / 100 - mu) / nullif(sigma, 0), 3) AS z_score
  FROM daily d JOIN stats s ON d.category = s.category
)"""

ORACLE = {
    "cohort_matrix": with_tables(f"""
WITH {COHORTS.strip()}
SELECT a.cohort_month, cohort_size, months_since AS months_since_first, customers AS active_customers,
       {pct('customers', 'cohort_size', 1)} AS retention_pct
FROM activity a JOIN sizes s ON a.cohort_month = s.cohort_month WHERE months_since BETWEEN 0 AND 11""", "ord"),
    "rfm_segmentation": with_tables(f"""
WITH {SEGMENTS.strip()}
SELECT c.customer_id, first_name, last_name, city, country, recency AS recency_days, frequency,
       {amount('monetary_c')} AS monetary, r AS r_score, f AS f_score, m AS m_score, r + f + m AS rfm_total,
       r::VARCHAR || f::VARCHAR || m::VARCHAR AS rfm_code, segment
FROM segments s JOIN customers c ON s.customer_id = c.customer_id""", "customers", "ord", "sales"),
    "rfm_segment_summary": with_tables(f"""
WITH {SEGMENTS.strip()}
SELECT segment, count(*) AS customers, {money_avg('sum(monetary_c)', 'count(*)', 2)} AS avg_revenue,
       {half_up('sum(recency)', 'count(*)', 1)} AS avg_recency_days
FROM segments GROUP BY segment""", "customers", "ord", "sales"),
    "abc_products": on_products(f"""
WITH {ABC.strip()}
SELECT product_name, category, total_units_sold, CAST(margin_h AS DOUBLE) / 100 AS profit_margin,
       {pct('run', 'whole')} AS cumulative_pct, abc_class, {amount('revenue_c')} AS revenue
FROM classed"""),
    "abc_summary": on_products(f"""
WITH {ABC.strip()}
SELECT abc_class, count(*) AS product_count, {amount('sum(revenue_c)')} AS total_revenue,
       {half_up('sum(margin_h)', '(100 * count(*))', 2)} AS avg_margin
FROM classed GROUP BY abc_class"""),
    "basket_categories": with_tables(f"""
WITH {BASKET_SETS.strip()}
SELECT array_to_string(cats, ', ') AS cats, CAST(len(cats) AS INTEGER) AS distinct_categories, order_count
FROM combos""", "products", "ord", "sales"),
    "revenue_trend": with_tables(f"""
WITH {DAILY_REVENUE.strip()}
SELECT sale_date, {amount('revenue_c')} AS daily_revenue, {trailing(7, 2)} AS ma_7d, {trailing(30, 2)} AS ma_30d,
       {amount('(revenue_c - lag(revenue_c) OVER (ORDER BY sale_date))')} AS day_over_day
FROM days""", "ord", "sales"),
    "ltv_distribution": on_customers(f"""
SELECT {points('ltv_c')}, {money_avg('sum(ltv_c)', 'count(*)', 2)} AS mean, {stddev('ltv_c')} AS std_dev,
       count(*) AS total_customers
FROM analytics"""),
    "category_country": on_daily(f"""
SELECT category, store_country, {amount('sum(revenue_c)')} AS revenue, CAST(sum(units_sold) AS BIGINT) AS units,
       {half_up(f"sum({half_up_int('10000 * CAST(profit_c AS HUGEINT)', 'revenue_c')})", '(100 * count(*))', 2)} AS avg_margin
FROM daily GROUP BY category, store_country"""),
    "discount_effectiveness": with_tables(f"""
SELECT CASE WHEN discount = 0 THEN '0%' WHEN discount <= 10 THEN '1-10%' WHEN discount <= 20 THEN '11-20%'
            WHEN discount <= 30 THEN '21-30%' ELSE '>30%' END AS discount_bucket,
       count(*) AS sales_count, {half_up('sum(quantity)', 'count(*)', 2)} AS avg_qty,
       {money_avg('sum(total_c)', 'count(*)', 2)} AS avg_order_value,
       {money_avg('sum(profit_c)', 'count(*)', 2)} AS avg_profit,
       {pct('sum(profit_c)', 'sum(total_c)')} AS overall_margin_pct
FROM sales GROUP BY 1""", "sales"),
    "seasonality_dow": on_daily(f"""
SELECT dayname(sale_date) AS weekday, count(*) AS data_points,
       {money_avg('sum(revenue_c)', 'count(*)', 2)} AS avg_daily_revenue, {amount('sum(revenue_c)')} AS total_revenue,
       {half_up('sum(units_sold)', 'count(*)', 2)} AS avg_units
FROM daily GROUP BY 1"""),
    "seasonality_monthly": on_monthly(f"""
SELECT year, month, {amount('sum(revenue_c)')} AS revenue, CAST(sum(monthly_units) AS BIGINT) AS units
FROM series GROUP BY year, month"""),
    "anomaly_detection": on_daily(f"""
WITH {ANOMALIES.strip()}
SELECT sale_date, category, {amount('revenue_c')} AS revenue, z_score, 'ANOMALY' AS flag
FROM odd WHERE abs(z_score) > 2.5"""),
    "employee_performance": with_tables(f"""
WITH {EMPLOYEES.strip()}
SELECT employee_id, employee_name, department, {amount('salary_c')} AS salary, orders_handled,
       {amount('revenue_c')} AS revenue_generated, {money_avg('revenue_c', 'lines', 2)} AS avg_order_value,
       {amount('profit_c')} AS total_profit, {pct('profit_c', 'revenue_c')} AS profit_margin_pct,
       {half_up('revenue_c', 'salary_c', 4)} AS revenue_to_salary_ratio,
       rank() OVER (ORDER BY revenue_c DESC) AS revenue_rank
FROM staff""", "employees", "ord", "sales"),
    "inventory_risk": with_tables(f"""
WITH {STOCK.strip()}
SELECT product_id, product_name, category, stock, total_sold, order_count, sales_days,
       CAST(need_m AS DOUBLE) / 1000 AS daily_demand, days_of_cover, inventory_status
FROM status""", "products", "ord", "sales"),
}
