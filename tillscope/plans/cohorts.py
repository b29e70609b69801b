"""Cohort retention: V8, B7, B8.

A customer's cohort is the month of their first completed order.  The
plan first reduces completed orders to distinct (customer, activity month)
rows — a partial aggregate, so a customer with very many orders collapses
map-side to at most one row per month — and takes the cohort as the
earliest of those months per customer.  Counting those rows per
(cohort, activity month) then counts distinct customers; the cohort size
is the count at the cohort's own month.  No order-level join back is
needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.common import month_start, months_between_starts, round_ratio
from tillscope.operators.joins import with_calendar
from tillscope.operators.pivot import pivot_fill
from tillscope.sources.star import Star


def customer_months(star: Star) -> DataFrame:
    """Distinct (customer_id, activity_month, cohort_month) of completed orders."""
    o = with_calendar(star, star.completed_orders().select("customer_id", "order_date_id"), "date_actual")
    # distinct plans as a hash aggregate with a map-side partial step
    act = o.select("customer_id", month_start("date_actual").alias("activity_month")).distinct()
    act = act.join(star.customer.select("customer_id"), "customer_id", "left_semi")
    return act.withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy("customer_id")))


def cohort_retention(star: Star) -> DataFrame:
    """V8: per (cohort month, activity month): months since start, cohort size, active customers, retention %."""
    cm = customer_months(star)
    stats = cm.groupBy("cohort_month", "activity_month").agg(F.count(F.lit(1)).alias("active_customers"))
    # the count at the cohort's own month, over the few rows of a cohort (one a calendar month)
    own = F.when(F.col("activity_month") == F.col("cohort_month"), F.col("active_customers"))
    j = stats.withColumn("cohort_size", F.max(own).over(Window.partitionBy("cohort_month")))
    return j.select(
        "cohort_month", "activity_month",
        months_between_starts("activity_month", "cohort_month").alias("months_since_cohort_start"),
        "cohort_size", "active_customers",
        round_ratio(F.col("active_customers") * 100, "cohort_size", 2).alias("retention_percent"),
    )


def cohort_retention_curve(star: Star) -> DataFrame:
    """Cohort month, month offset and retention %, sorted."""
    v = cohort_retention(star)
    label = F.date_format("cohort_month", "yyyy-MM").alias("cohort_label")  # X11
    return v.select("cohort_month", label, "months_since_cohort_start", "retention_percent").orderBy(
        "cohort_month", "months_since_cohort_start")


def cohort_matrix(star: Star) -> DataFrame:
    """B7 pivoted: one row per cohort, one column per month offset that the calendar admits, 0 where missing."""
    curve = cohort_retention(star).select("cohort_month", "months_since_cohort_start", "retention_percent")
    months = F.col("year") * 12 + F.col("month")
    span = star.date.agg(F.max(months) - F.min(months)).first()[0]  # one number
    return pivot_fill(curve, index="cohort_month", columns="months_since_cohort_start", values="retention_percent",
                      pivot_values=list(range((span or 0) + 1)))
