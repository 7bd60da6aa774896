"""Report tables in DuckDB SQL."""

from __future__ import annotations

from oracles.base import TODAY, amount, half_up, half_up_int, money_avg, pct, with_tables
from oracles.core import ORACLE as CORE
from oracles.core import rfm_base
from oracles.extended import ABC, BASKET_SETS, COHORTS, EMPLOYEES, SEGMENTS, STOCK
from oracles.gold import CUSTOMERS, PRODUCTS, STORES, on_customers, on_daily, on_monthly, on_products

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

_CORE_RFM = f"""
{rfm_base().strip()}, q AS (
  SELECT *, ntile(5) OVER (ORDER BY recency, customer_id) AS r,
         ntile(5) OVER (ORDER BY frequency DESC, customer_id) AS f,
         ntile(5) OVER (ORDER BY monetary_c DESC, customer_id) AS m
  FROM base
), named AS (
  SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN r >= 4 AND f >= 3 AND m >= 3 THEN 'Loyal'
            WHEN r >= 3 AND f >= 3 AND m >= 3 THEN 'Potential' WHEN r >= 3 AND f <= 2 AND m >= 2 THEN 'At Risk'
            WHEN r <= 2 AND f >= 2 AND m >= 2 THEN 'Needs Attention' ELSE 'Lost' END AS rfm_segment
  FROM q
)"""
_MARGIN_H = half_up_int("10000 * CAST(profit_c AS HUGEINT)", "revenue_c")


def _sum_case(column: str, value: str, name: str) -> str:
    return f"{amount(f'coalesce(sum(CASE WHEN {column} = {value} THEN revenue_c END), 0)')} AS {name}"


def _kpi(name: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS kpi, CAST({value} AS DOUBLE) AS value FROM {source}"


_KPIS = "\nUNION ALL ".join(
    [
        _kpi("total_customers", "count(*)", "analytics"),
        _kpi("total_revenue", half_up("sum(ltv_c)", "100"), "analytics"),
        _kpi("avg_ltv", money_avg("sum(ltv_c)", "count(*)", 2), "analytics"),
        _kpi("avg_orders_per_customer", half_up("sum(total_orders)", "count(*)", 2), "analytics"),
        _kpi("high_churn_customers", "count(*) FILTER (WHERE churn_risk = 'High')", "analytics"),
        _kpi("total_products", "count(*)", "perf"),
        _kpi("product_revenue", half_up("sum(revenue_c)", "100"), "perf"),
        _kpi("avg_margin", half_up(f"sum({_MARGIN_H})", "(100 * count(*))", 2), "perf"),
        _kpi("total_stores", "count(*)", "store_perf"),
        _kpi("avg_store_margin", half_up(f"sum({_MARGIN_H})", "(100 * count(*))", 2), "store_perf"),
        _kpi("ranked_stores", "max(revenue_rank)", "store_perf"),
    ]
)

ORACLE = {
    "sample_rows": CORE["rfm_analysis"] + "\nORDER BY md5('42:' || c.customer_id), c.customer_id LIMIT 300",
    "pivot_revenue_month_category": on_monthly(
        "SELECT strftime(make_date(year, month, 1), '%Y-%m') AS period, "
        + ", ".join(_sum_case("category", f"'{c}'", c) for c in TYPES)
        + " FROM series GROUP BY 1"
    ),
    "pivot_cohort": with_tables(f"""
WITH {COHORTS.strip()}
SELECT strftime(a.cohort_month, '%Y-%m') AS cohort_month, """
        + ", ".join(
            f"max(CASE WHEN months_since = {i} THEN {pct('customers', 'cohort_size', 1)} END) AS month_{i}"
            for i in range(12)
        )
        + " FROM activity a JOIN sizes s ON a.cohort_month = s.cohort_month GROUP BY 1", "ord"),
    "pivot_country": on_daily(f"""
WITH cells AS (
  SELECT category, store_country, sum(revenue_c) AS c FROM daily GROUP BY ALL
), top AS (
  SELECT store_country FROM cells GROUP BY store_country ORDER BY sum(c) DESC, store_country LIMIT 20
), grid AS (
  SELECT DISTINCT cells.category, top.store_country FROM cells, top
)
SELECT grid.category, grid.store_country, {amount('coalesce(c, 0)')} AS revenue
FROM grid LEFT JOIN cells ON grid.category = cells.category AND grid.store_country = cells.store_country"""),
    "pivot_year_month": on_monthly(
        "SELECT CAST(year AS INTEGER) AS year, "
        + ", ".join(_sum_case("month", str(i), m) for i, m in enumerate(MONTHS, 1))
        + " FROM series GROUP BY 1"
    ),
    "customer_segment_summary": on_customers(f"""
SELECT customer_segment, count(*) AS customers, {money_avg('sum(ltv_c)', 'count(*)', 6)} AS avg_ltv,
       {half_up('sum(total_orders)', 'count(*)', 6)} AS avg_orders
FROM analytics GROUP BY customer_segment"""),
    "churn_counts": on_customers('SELECT churn_risk, count(*) AS "count" FROM analytics GROUP BY churn_risk'),
    "rfm_summary": with_tables(f"""
WITH {_CORE_RFM.strip()}
SELECT rfm_segment, count(*) AS customers, {half_up('sum(recency)', 'count(*)', 6)} AS avg_recency,
       {half_up('sum(frequency)', 'count(*)', 6)} AS avg_frequency,
       {money_avg('sum(monetary_c)', 'count(*)', 6)} AS avg_monetary
FROM named GROUP BY rfm_segment""", "customers", "ord", "sales"),
    "rfm_ext_summary": with_tables(f"""
WITH {SEGMENTS.strip()}
SELECT segment, count(*) AS customers, {money_avg('sum(monetary_c)', 'count(*)', 6)} AS avg_revenue
FROM segments GROUP BY segment""", "customers", "ord", "sales"),
    "ltv_percentiles_exact": on_customers(f"""
WITH r AS (SELECT ltv_c, row_number() OVER (ORDER BY ltv_c) - 1 AS i, count(*) OVER () AS n FROM analytics),
p AS (SELECT unnest([10, 25, 50, 75, 90, 95, 99]) AS p),
v AS (
  SELECT p, max(CASE WHEN i = (n - 1) * p // 100 THEN ltv_c END) AS lo,
         max(CASE WHEN i = least((n - 1) * p // 100 + 1, n - 1) THEN ltv_c END) AS hi, max((n - 1) * p % 100) AS part
  FROM r, p GROUP BY p
)
SELECT 'P' || p AS percentile, {half_up('lo * (100 - part) + hi * part', '10000', 2)} AS ltv FROM v"""),
    "ltv_histogram": on_customers(f"""
WITH b AS (SELECT min(ltv_c) AS lo, max(ltv_c) AS hi FROM analytics),
h AS (
  SELECT least((ltv_c - lo) * 40 // (hi - lo), 39) AS bin, count(*) AS customers FROM analytics, b GROUP BY 1
)
SELECT CAST(g.bin AS INTEGER) AS bin, {half_up('lo * 40 + g.bin * (hi - lo)', '4000', 4)} AS low,
       {half_up('lo * 40 + (g.bin + 1) * (hi - lo)', '4000', 4)} AS high, coalesce(customers, 0) AS customers
FROM range(40) g(bin) CROSS JOIN b LEFT JOIN h ON g.bin = h.bin"""),
    "abc_rollup": on_products(f"""
WITH {ABC.strip()}
SELECT abc_class, count(*) AS products, {amount('sum(revenue_c)')} AS total_revenue,
       {half_up('sum(margin_h)', '(100 * count(*))', 6)} AS avg_margin
FROM classed GROUP BY abc_class"""),
    "basket_combo_labels": with_tables(f"""
WITH {BASKET_SETS.strip()}
SELECT array_to_string(cats, ' + ') AS combo, order_count FROM combos ORDER BY order_count DESC, combo LIMIT 15""",
        "products", "ord", "sales"),
    "basket_size_histogram": with_tables("""
WITH z AS (
  SELECT s.order_id, count(*) AS product_count FROM sales s JOIN products p ON s.product_id = p.product_id
  GROUP BY s.order_id HAVING count(DISTINCT s.product_id) >= 2
)
SELECT product_count, count(*) AS orders FROM z GROUP BY product_count""", "products", "sales"),
    "daily_category_revenue": on_daily(f"""
SELECT sale_date, category, {amount('sum(revenue_c)')} AS revenue FROM daily GROUP BY sale_date, category"""),
    "department_summary": with_tables(f"""
WITH {EMPLOYEES.strip()}
SELECT department, count(*) AS employees, {money_avg('sum(revenue_c)', 'count(*)', 6)} AS avg_revenue,
       {half_up(f'sum({_MARGIN_H})', '(100 * count(*))', 6)} AS avg_margin,
       {money_avg('sum(salary_c)', 'count(*)', 6)} AS avg_salary,
       {half_up(f"sum({half_up_int('revenue_c * 10000', 'salary_c')})", '(10000 * count(*))', 6)} AS avg_rev_salary
FROM staff GROUP BY department""", "employees", "ord", "sales"),
    "inventory_status_counts": with_tables(f"""
WITH {STOCK.strip()}
SELECT inventory_status AS status, count(*) AS "count" FROM status GROUP BY 1""", "products", "ord", "sales"),
    "stockout_top10": with_tables(f"""
WITH {STOCK.strip()}
SELECT product_name, category, stock, CAST(need_m AS DOUBLE) / 1000 AS daily_demand, days_of_cover
FROM status WHERE inventory_status = 'STOCKOUT RISK' ORDER BY days_of_cover, product_id LIMIT 10""",
        "products", "ord", "sales"),
    "executive_kpis": with_tables(
        f"WITH {CUSTOMERS.strip()}, {PRODUCTS.strip()}, {STORES.strip()}\n{_KPIS}",
        "customers", "products", "stores", "ord", "sales"),
    "parse_money": on_customers(f"""
SELECT customer_id, CASE WHEN churn_risk = 'High' THEN 'n/a' ELSE '£' || format('{{:,}}', ltv_c // 100) || '.'
       || lpad(CAST(ltv_c % 100 AS VARCHAR), 2, '0') END AS shown,
       CASE WHEN churn_risk <> 'High' THEN {amount('ltv_c')} END AS lifetime_value
FROM analytics"""),
}
