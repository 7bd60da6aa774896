"""Gold tables in DuckDB SQL."""

from __future__ import annotations

from oracles.base import TODAY, amount, gross, half_up, money_avg, pct, with_tables

# CTE bodies other oracle queries reuse; money columns end in _c (cents).
DAILY = f"""
daily AS (
  SELECT o.order_date AS sale_date, p.category, st.store_name, st.city AS store_city,
         st.country AS store_country, CAST(sum(s.quantity) AS BIGINT) AS units_sold,
         CAST(sum(s.total_c) AS BIGINT) AS revenue_c, CAST(sum(s.profit_c) AS BIGINT) AS profit_c,
         CAST(sum(s.price_u) AS BIGINT) AS price_u, count(*) AS lines,
         count(DISTINCT o.order_id) AS order_count, count(DISTINCT o.customer_id) AS unique_customers,
         CAST(sum(s.discount) AS BIGINT) AS discount
  FROM sales s JOIN ord o ON s.order_id = o.order_id JOIN products p ON s.product_id = p.product_id
       JOIN stores st ON o.store_id = st.store_id
  GROUP BY ALL
)"""

MONTHLY = """
monthly AS (
  SELECT year(sale_date) AS year, month(sale_date) AS month, category,
         CAST(sum(revenue_c) AS BIGINT) AS revenue_c, CAST(sum(units_sold) AS BIGINT) AS monthly_units,
         CAST(sum(order_count) AS BIGINT) AS monthly_orders, count(*) AS n
  FROM daily GROUP BY ALL
),
series AS (
  SELECT *, lag(revenue_c) OVER (PARTITION BY category ORDER BY year, month) AS prev_c FROM monthly
)"""

CUSTOMERS = f"""
bought AS (
  SELECT o.customer_id, count(DISTINCT o.order_id) AS total_orders,
         CAST(sum(s.total_c) AS BIGINT) AS ltv_c, count(*) AS lines, max(o.order_date) AS last_order_date,
         min(o.order_date) AS first_order_date, CAST(sum(s.quantity) AS BIGINT) AS total_products_purchased,
         CAST(sum(s.discount) AS BIGINT) AS discount
  FROM ord o JOIN sales s ON o.order_id = s.order_id GROUP BY o.customer_id
),
analytics AS (
  SELECT c.*, b.* EXCLUDE (customer_id), {TODAY} - last_order_date AS days_since_last_order,
         {TODAY} - first_order_date AS customer_tenure_days,
         CASE WHEN ltv_c >= 280000000 THEN 'VIP' WHEN ltv_c >= 210000000 THEN 'High Value'
              WHEN ltv_c >= 140000000 THEN 'Medium Value' ELSE 'Low Value' END AS customer_segment,
         CASE WHEN {TODAY} - last_order_date > 180 THEN 'High'
              WHEN {TODAY} - last_order_date > 90 THEN 'Medium' ELSE 'Low' END AS churn_risk
  FROM customers c JOIN bought b ON c.customer_id = b.customer_id
)"""

PRODUCTS = """
sold AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(total_c) AS BIGINT) AS revenue_c,
         CAST(sum(profit_c) AS BIGINT) AS profit_c, count(*) AS lines,
         CAST(sum(price_u) AS BIGINT) AS price_u, CAST(sum(discount) AS BIGINT) AS discount
  FROM sales GROUP BY product_id
),
perf AS (
  SELECT p.*, s.* EXCLUDE (product_id),
         CAST(rank() OVER (ORDER BY s.revenue_c DESC) AS INTEGER) AS revenue_rank,
         CAST(rank() OVER (ORDER BY s.profit_c DESC) AS INTEGER) AS profit_rank
  FROM products p JOIN sold s ON p.product_id = s.product_id
)"""

STORES = """
sold_by_store AS (
  SELECT o.store_id, count(DISTINCT o.order_id) AS total_orders,
         count(DISTINCT o.customer_id) AS unique_customers, CAST(sum(s.quantity) AS BIGINT) AS units_sold,
         CAST(sum(s.total_c) AS BIGINT) AS revenue_c, CAST(sum(s.profit_c) AS BIGINT) AS profit_c,
         count(*) AS lines, CAST(sum(s.discount) AS BIGINT) AS discount
  FROM sales s JOIN ord o ON s.order_id = o.order_id GROUP BY o.store_id
),
store_perf AS (
  SELECT st.*, b.* EXCLUDE (store_id),
         CAST(rank() OVER (ORDER BY b.revenue_c DESC) AS INTEGER) AS revenue_rank
  FROM stores st JOIN sold_by_store b ON st.store_id = b.store_id
)"""


def on_daily(body: str) -> str:
    return with_tables(f"WITH {DAILY.strip()}{_rest(body)}", "products", "stores", "ord", "sales")


def on_monthly(body: str) -> str:
    return on_daily(f"WITH {MONTHLY.strip()}{_rest(body)}")


def on_customers(body: str) -> str:
    return with_tables(f"WITH {CUSTOMERS.strip()}{_rest(body)}", "customers", "ord", "sales")


def on_products(body: str) -> str:
    return with_tables(f"WITH {PRODUCTS.strip()}{_rest(body)}", "products", "sales")


def on_stores(body: str) -> str:
    return with_tables(f"WITH {STORES.strip()}{_rest(body)}", "stores", "ord", "sales")


def _rest(body: str) -> str:
    body = body.strip()
    return f",\n{body[5:]}" if body.upper().startswith("WITH ") else f"\n{body}"


ORACLE = {
    "gold_daily_sales_summary": on_daily(f"""
SELECT sale_date, category, store_name, store_city, store_country, units_sold,
       {amount('revenue_c')} AS total_revenue, {amount('profit_c')} AS total_profit,
       {half_up('price_u', '(1000000 * lines)', 6)} AS avg_unit_price, order_count, unique_customers,
       {half_up('discount', 'lines', 6)} AS avg_discount, {pct('profit_c', 'revenue_c')} AS profit_margin,
       year(sale_date) AS year, month(sale_date) AS month, day(sale_date) AS day,
       quarter(sale_date) AS quarter, dayname(sale_date) AS weekday
FROM daily"""),
    "gold_customer_analytics": on_customers(f"""
SELECT customer_id, first_name, last_name, gender, email, city, country, join_date, total_orders,
       {amount('ltv_c')} AS lifetime_value, {money_avg('ltv_c', 'lines', 6)} AS avg_order_value,
       last_order_date, first_order_date, total_products_purchased,
       {half_up('discount', 'lines', 6)} AS avg_discount_received, days_since_last_order,
       customer_tenure_days, customer_tenure_days::DOUBLE / total_orders AS order_frequency,
       customer_segment, churn_risk, {TODAY} AS analytics_date
FROM analytics"""),
    "gold_product_performance": on_products(f"""
SELECT product_id, product_name, category, {amount('cost_c')} AS cost_price,
       {amount('price_c')} AS selling_price, stock, total_units_sold,
       {amount('revenue_c')} AS total_revenue, {amount('profit_c')} AS total_profit,
       lines AS transaction_count, {half_up('price_u', '(1000000 * lines)', 6)} AS avg_selling_price,
       {half_up('discount', 'lines', 6)} AS avg_discount,
       {money_avg('revenue_c', 'total_units_sold', 6)} AS revenue_per_unit,
       {pct('profit_c', 'revenue_c')} AS profit_margin,
       stock::DOUBLE / total_units_sold * 365 AS inventory_turnover_days, revenue_rank, profit_rank,
       (revenue_rank + profit_rank) / 2.0::DOUBLE AS performance_score
FROM perf"""),
    "gold_store_performance": on_stores(f"""
SELECT store_id, store_name, city, country, region, total_orders, unique_customers, units_sold,
       {amount('revenue_c')} AS total_revenue, {amount('profit_c')} AS total_profit,
       {money_avg('revenue_c', 'lines', 6)} AS avg_order_value,
       {half_up('discount', 'lines', 6)} AS avg_discount,
       {money_avg('revenue_c', 'unique_customers', 6)} AS revenue_per_customer,
       total_orders::DOUBLE / 365 AS orders_per_day, {pct('profit_c', 'revenue_c')} AS profit_margin,
       revenue_rank
FROM store_perf"""),
    "gold_monthly_time_series": on_monthly(f"""
SELECT year, month, category, {amount('revenue_c')} AS monthly_revenue, monthly_units, monthly_orders,
       {money_avg('revenue_c', 'n', 6)} AS avg_daily_revenue, {amount('prev_c')} AS prev_month_revenue,
       {pct('revenue_c - prev_c', 'prev_c')} AS mom_growth_pct
FROM series"""),
    "gold_monthly_revenue_by_category": with_tables(f"""
SELECT CAST(date_trunc('month', o.order_date) AS DATE) AS month, p.category,
       {amount(f'sum({gross()})')} AS total_revenue, {amount('sum(s.profit_c)')} AS total_profit,
       count(s.sale_id) AS num_sales
FROM sales s JOIN ord o ON s.order_id = o.order_id JOIN products p ON s.product_id = p.product_id
GROUP BY ALL""", "products", "ord", "sales"),
    "gold_customer_ltv": with_tables(f"""
WITH ltv AS (
  SELECT o.customer_id, sum({gross()}) AS v, count(o.order_id) AS total_orders
  FROM sales s JOIN ord o ON s.order_id = o.order_id GROUP BY ALL
)
SELECT c.customer_id, {amount('v')} AS lifetime_value, total_orders,
       {money_avg('v', 'total_orders', 2)} AS avg_order_value, first_name, last_name, city, country
FROM ltv JOIN customers c ON ltv.customer_id = c.customer_id""", "customers", "ord", "sales"),
    "gold_product_perf_aws": with_tables(f"""
SELECT p.product_id, p.product_name, p.category, {amount(f'sum({gross()})')} AS revenue,
       {amount('sum(s.profit_c)')} AS profit, {pct('sum(s.profit_c)', f'sum({gross()})')} AS margin_pct,
       count(s.sale_id) AS units_sold
FROM sales s JOIN products p ON s.product_id = p.product_id
GROUP BY p.product_id, p.product_name, p.category""", "products", "sales"),
    "gold_store_perf_aws": with_tables(f"""
SELECT st.store_id, st.store_name, st.city, st.country, {amount(f'sum({gross()})')} AS revenue,
       count(o.order_id) AS num_orders, {money_avg(f'sum({gross()})', 'count(*)', 2)} AS avg_order_value
FROM sales s JOIN ord o ON s.order_id = o.order_id JOIN stores st ON o.store_id = st.store_id
GROUP BY st.store_id, st.store_name, st.city, st.country""", "stores", "ord", "sales"),
    "gold_employee_performance": with_tables(f"""
SELECT e.employee_id, e.employee_name, e.department, {amount(f'sum({gross()})')} AS revenue_handled,
       count(o.order_id) AS orders_handled, {amount('sum(s.profit_c)')} AS profit_generated
FROM sales s JOIN ord o ON s.order_id = o.order_id JOIN employees e ON o.employee_id = e.employee_id
GROUP BY e.employee_id, e.employee_name, e.department""", "employees", "ord", "sales"),
}
