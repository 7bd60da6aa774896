"""The analyses by name."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from copy import copy
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators import gold
from shopgrain.operators.gold import GOLD_TABLES, Gold
from shopgrain.plans import core, extended, lakehouse, reports, scripts
from shopgrain.sources.layers import export_csv
from shopgrain.sources.retail import SharedRetail
from shopgrain.sources.scratch import settle

log = logging.getLogger(__name__)

Analysis = Callable[..., DataFrame]


def _plain(f: Analysis) -> Analysis:
    return lambda g, *args: f(g.retail, *args)


def _dated(f: Analysis) -> Analysis:
    return lambda g, *args: f(g.retail, g.as_of, *args)


def _table(name: str) -> Analysis:
    return lambda g: getattr(g, name)


GOLD: dict[str, Analysis] = {
    **{f"gold_{name}": _table(name) for name in GOLD_TABLES},
    "gold_monthly_revenue_by_category": _plain(gold.gold_monthly_revenue_by_category),
    "gold_customer_ltv": _plain(gold.gold_customer_ltv),
    "gold_product_perf_aws": _plain(gold.gold_product_perf),
    "gold_store_perf_aws": _plain(gold.gold_store_perf),
    "gold_employee_performance": _plain(gold.gold_employee_performance),
}

CORE: dict[str, Analysis] = {
    "monthly_revenue": core.monthly_revenue,
    "top_customers": core.top_customers,
    "product_ranking": core.product_ranking,
    "store_comparison": core.store_comparison,
    "time_series_growth": core.time_series_growth,
    "cohort_retention": _plain(core.cohort_retention),
    "cross_sell_orders": _plain(core.cross_sell_orders),
    "rfm_analysis": _dated(core.rfm_analysis),
    "moving_averages": _plain(core.moving_averages),
    "yoy_comparison": core.yoy_comparison,
    "pareto_analysis": _plain(core.pareto_analysis),
}

# sales_dashboard_daily takes a first date, mom_growth_year a year.
SCRIPTS: dict[str, Analysis] = {
    "sales_dashboard_daily": scripts.sales_dashboard_daily,
    "top_products_gold": scripts.top_products_gold,
    "segment_summary": scripts.segment_summary,
    "store_matrix": scripts.store_matrix,
    "mom_growth_year": scripts.mom_growth_year,
    "ltv_buckets": scripts.ltv_buckets,
    "product_combinations": _plain(scripts.product_combinations),
    "seasonal_sales": scripts.seasonal_sales,
    "inventory_turnover_class": scripts.inventory_turnover_class,
    "yoy_from_daily": _plain(scripts.yoy_from_daily),
    "cltv_prediction": _dated(scripts.cltv_prediction),
    "product_season": _plain(scripts.product_season),
    "inventory_days": _dated(scripts.inventory_days),
    "purchase_pattern": _plain(scripts.purchase_pattern),
    "store_comparison_ranked": _plain(scripts.store_comparison_ranked),
}

EXTENDED: dict[str, Analysis] = {
    "cohort_matrix": _plain(extended.cohort_matrix),
    "rfm_segmentation": _dated(extended.rfm_segmentation),
    "rfm_segment_summary": _dated(extended.rfm_segment_summary),
    "abc_products": extended.abc_products,
    "abc_summary": extended.abc_summary,
    "basket_categories": _plain(extended.basket_categories),
    "revenue_trend": _plain(extended.revenue_trend),
    "ltv_distribution": extended.ltv_distribution,
    "category_country": extended.category_country,
    "discount_effectiveness": _plain(extended.discount_effectiveness),
    "seasonality_dow": extended.seasonality_dow,
    "seasonality_monthly": extended.seasonality_monthly,
    "anomaly_detection": extended.anomaly_detection,
    "employee_performance": _plain(extended.employee_performance),
    "inventory_risk": _plain(extended.inventory_risk),
}

LAKEHOUSE: dict[str, Analysis] = {
    "ath_sales_dashboard": _dated(lakehouse.sales_dashboard),
    "ath_top_products": _plain(lakehouse.top_products),
    "ath_customer_segmentation": _plain(lakehouse.customer_segmentation),
    "ath_store_performance": _plain(lakehouse.store_performance),
    "ath_mom_growth": _plain(lakehouse.mom_growth),
    "ath_ltv_distribution": _plain(lakehouse.ltv_distribution),
    "ath_rfm": _dated(lakehouse.rfm),
    "ath_cohort_retention": _plain(lakehouse.cohort_retention),
    "ath_abc_products": _plain(lakehouse.abc_products),
    "ath_inventory_risk": _dated(lakehouse.inventory_risk),
    "ath_yoy": _plain(lakehouse.yoy),
    "ath_discount": _plain(lakehouse.discount),
    "ath_employee": _plain(lakehouse.employee),
    "ath_cross_sell_pairs": _plain(lakehouse.cross_sell_pairs),
    "ath_anomaly": _plain(lakehouse.anomaly),
    "ath_seasonality": _plain(lakehouse.seasonality),
}

# The month x category pivot takes the category headings.
REPORTS: dict[str, Analysis] = {
    "pivot_revenue_month_category": reports.pivot_revenue_month_category,
    "pivot_cohort": _plain(reports.pivot_cohort),
    "pivot_country": reports.pivot_country,
    "pivot_year_month": reports.pivot_year_month,
    "customer_segment_summary": reports.customer_segment_summary,
    "churn_counts": reports.churn_counts,
    "rfm_summary": _dated(reports.rfm_summary),
    "rfm_ext_summary": _dated(reports.rfm_ext_summary),
    "ltv_percentiles_exact": reports.ltv_percentiles_exact,
    "ltv_histogram": reports.ltv_histogram,
    "abc_rollup": reports.abc_rollup,
    "basket_combo_labels": _plain(reports.basket_combo_labels),
    "basket_size_histogram": _plain(reports.basket_size_histogram),
    "daily_category_revenue": reports.daily_category_revenue,
    "department_summary": _plain(reports.department_summary),
    "inventory_status_counts": _plain(reports.inventory_status_counts),
    "stockout_top10": _plain(reports.stockout_top10),
    "executive_kpis": reports.executive_kpis,
    "parse_money": reports.parsed_money,
}

ANALYSES: dict[str, Analysis] = {**GOLD, **CORE, **SCRIPTS, **EXTENDED, **LAKEHOUSE, **REPORTS}


#: Analyses that cannot run without a parameter (a day, a year, the columns of a pivot).
NEED_ARGUMENTS = ("sales_dashboard_daily", "mom_growth_year", "pivot_revenue_month_category")


def list_queries() -> list[str]:
    return list(ANALYSES)


def run_named(name: str, g: Gold, *args) -> DataFrame:
    """The named analysis, not yet executed."""
    if name not in ANALYSES:
        raise ValueError(f"unknown analysis {name!r}; known: {', '.join(ANALYSES)}")
    return ANALYSES[name](g, *args)


class SharedGold(Gold):
    """Gold tables for several analyses, maybe at a time: each, and each step they share, is written once, when first read."""

    def __init__(self, g: Gold):
        super().__init__(SharedRetail(g.retail), g.as_of, g.rules)

    @property
    def daily_sales_summary(self) -> DataFrame:
        return self.retail.once("daily_sales_summary", lambda: gold.daily_sales_summary(self.retail))

    @property
    def daily_measures(self) -> DataFrame:
        return self.daily_sales_summary.drop("unique_customers")

    @property
    def customer_analytics(self) -> DataFrame:
        return self.retail.once(
            "customer_analytics", lambda: gold.customer_analytics(self.retail, self.as_of, self.rules)
        )

    @property
    def product_measures(self) -> DataFrame:
        return self.product_performance.drop("revenue_rank", "profit_rank", "performance_score")

    @property
    def product_performance(self) -> DataFrame:
        return self.retail.once("product_performance", lambda: gold.product_performance(self.retail))

    @property
    def store_measures(self) -> DataFrame:
        return self.store_performance.drop("revenue_rank")

    @property
    def store_performance(self) -> DataFrame:
        return self.retail.once("store_performance", lambda: gold.store_performance(self.retail))

    @property
    def monthly_time_series(self) -> DataFrame:
        return self.retail.once("monthly_time_series", lambda: gold.monthly_time_series(self.daily_measures))


def run_all(
    g: Gold,
    names: Iterable[str] | None = None,
    csv_folder: str | None = None,
    arguments: Mapping[str, Sequence] | None = None,
    at_once: int = 4,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The named analyses, executed, and the message of each that failed.

    ``arguments`` holds an analysis's own parameters, by its name. If none are named:
    all but those of ``NEED_ARGUMENTS`` that have none.

    Each result is written once, so one that fails while it runs fails alone. With
    ``csv_folder`` it is written there as well. ``at_once`` analyses run at a time.
    Gold tables that are not stored yet are made once for all of them, and so are the steps
    they share, such as the sums of each order.
    """
    given = arguments or {}
    if names is None:
        names = [n for n in ANALYSES if n not in NEED_ARGUMENTS or n in given]
    if type(g) is Gold:
        g = SharedGold(g)
    elif not isinstance(g.retail, SharedRetail):
        g = copy(g)
        g.__dict__["retail"] = SharedRetail(g.retail)

    def run(name: str) -> tuple[str, DataFrame | None, str]:
        try:
            result = settle(run_named(name, g, *given.get(name, ())), "analysis")
            if csv_folder:
                export_csv(_flat(result), f"{csv_folder}/{name}")
            return name, result, ""
        except Exception as error:
            log.warning("%s failed: %s", name, error)
            return name, None, str(error)

    with ThreadPool(at_once) as pool:
        ended = pool.map(inheritable_thread_target(SparkSession.active())(run), list(names), chunksize=1)
    results = {name: result for name, result, _ in ended if result is not None}
    return results, {name: why for name, result, why in ended if result is None}


def _flat(df: DataFrame) -> DataFrame:
    """Lists as JSON text: CSV has no lists."""
    return df.select(
        *[
            F.to_json(n).alias(n) if kind.startswith("array") else F.col(n)
            for n, kind in df.dtypes
        ]
    )
