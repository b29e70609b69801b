"""Named queries: one entry per implemented inventory row.

Each entry maps a name to a function of the star.  ``queries()`` binds
them to the driver's parquet folder; ``oracle_sql()`` gives the DuckDB
statement for the same name where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tillscope.plans import basket, cohorts, customers, forecast, hot_orders, products, reach, revenue, segments, summaries, warehouse
from tillscope.sources.driver import driver_star
from tillscope.sources.star import Star

PLANS: dict[str, Callable[[Star], DataFrame]] = {
    # views and reports on order headers
    "daily_revenue": revenue.daily_revenue,                 # V1
    "revenue_by_channel": revenue.revenue_by_channel,       # V2
    "monthly_revenue": revenue.monthly_revenue,             # E1
    "yoy_growth": revenue.yoy_growth,                       # E2
    "top_channel_months": revenue.top_channel_months,       # E5
    "weekday_distribution": revenue.weekday_distribution,   # E9
    "kpis": revenue.kpis,                                   # B1
    "revenue_trend": revenue.revenue_trend,                 # B2
    "channel_totals": revenue.channel_totals,               # B3
    "daily_series": revenue.daily_series,                   # B13
    # parts of the facts, by day, month and year
    "daily_revenue_between": revenue.daily_revenue_between,  # V1, L1
    "revenue_by_channel_in_year": revenue.revenue_by_channel_in_year,  # V2, L1
    "revenue_by_category_in_month": products.revenue_by_category_in_month,  # V3, L1
    # customers
    "customer_lifetime_value": customers.customer_lifetime_value,  # V4
    "rfm_base": customers.rfm_base,                         # V5
    "rfm_scores": customers.rfm_scores,                     # V6
    "ltv_segments": customers.ltv_segments,                 # V7
    "top_customers": customers.top_customers,               # E3
    "signup_cohorts": customers.signup_cohorts,             # E4
    "repeat_rate": customers.repeat_rate,                   # E8
    "segment_order_size": customers.segment_order_size,     # E10
    "ltv_segment_summary": customers.ltv_segment_summary,   # B4
    "rfm_top": customers.rfm_top,                           # B5
    "rfm_points": customers.rfm_points,                     # B6
    "rfm_features": customers.rfm_features,                 # B18
    # products and categories
    "revenue_by_category": products.revenue_by_category,    # V3
    "category_margin_monthly": products.category_margin_monthly,  # V10
    "best_sellers": products.best_sellers,                  # E6
    "product_profitability": products.product_profitability,  # E7
    "category_margin": products.category_margin,            # B9
    "top_category_margin": products.top_category_margin,    # B10
    "category_seasonality": products.category_seasonality,  # B16
    "seasonality_matrix": products.seasonality_matrix,      # B17
    # cohorts
    "cohort_retention": cohorts.cohort_retention,           # V8
    "cohort_retention_curve": cohorts.cohort_retention_curve,  # B7
    "cohort_matrix": cohorts.cohort_matrix,                 # B8
    # market basket (reference threshold 5; at product grain the driver data
    # has no pair that frequent, so the same plans also run at threshold 2)
    "product_pairs": basket.product_pairs,                  # V9
    "association_rules": basket.association_rules,          # V11
    "top_pairs": basket.top_pairs,                          # B11
    "top_rules": basket.top_rules,                          # B12
    "product_pairs_min2": partial(basket.product_pairs, min_orders=2),
    "association_rules_min2": partial(basket.association_rules, min_orders=2),
    "top_pairs_min2": partial(basket.top_pairs, min_orders=2),
    "top_rules_min2": partial(basket.top_rules, min_orders=2),
    # roll-ups, batches and skew
    "customer_reach": reach.customer_reach,                 # A4, A13
    "category_orders": reach.category_orders,               # A4, V3
    "summarized_days": summaries.summarized_days,           # V1, L5
    "summarized_channels": summaries.summarized_channels,   # V2, L5
    "summarized_categories": summaries.summarized_categories,  # V3, L5
    "summarized_margin": summaries.summarized_margin,       # V10, L5
    "hot_order_revenue": hot_orders.hot_order_revenue,      # J2
    # forecast
    "monthly_moving_average": forecast.monthly_moving_average,  # B14
    "naive_forecast": forecast.naive_forecast,              # B15
    # segments
    "standardized_features": segments.standardized_features,  # M1
    "kmeans_segments": segments.kmeans_segments,            # M2
    "cluster_sizes": segments.cluster_sizes,                # M3
    "cluster_summary": segments.cluster_summary,            # M4
    "cluster_points": segments.cluster_points,              # M5
    "cluster_totals": segments.cluster_totals,              # M2-M4
    # warehouse load and audit steps
    "star_audit": warehouse.star_audit,                     # C1-C5
    "order_financials": warehouse.order_financials,         # L9
    "order_calendar": warehouse.order_calendar,             # L2
    "sellable_products": warehouse.sellable_products,       # L12
    "lines_after_cancel_purge": warehouse.lines_after_cancel_purge,  # L13
    "calendar_reseed": warehouse.calendar_reseed,           # L4
    "order_date_keys": warehouse.order_date_keys,           # L10
    "calendar_merge": warehouse.calendar_merge,             # L4
    "broken_order_audit": warehouse.broken_order_audit,     # C1-C5
    "order_defaults": warehouse.order_defaults,             # C6
    "last_calendar_days": warehouse.last_calendar_days,     # O5
    "calendar_years": warehouse.calendar_years,             # O6
}


def _bind(plan: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(driver_star(spark, sf_dir))

    run.__name__ = getattr(plan, "__name__", getattr(getattr(plan, "func", None), "__name__", "query"))
    run.__doc__ = plan.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(plan) for name, plan in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    from tillscope.oracle import Q

    return {name: sql for name, sql in Q.items() if name in PLANS}
