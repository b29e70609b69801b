"""Distinct customers and orders by day, month and year from one table of bitmaps each (A4, A13 over V3, V8, B1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.operators.joins import with_calendar
from tillscope.operators.reach import distinct_counts, id_bitmaps
from tillscope.plans.products import completed_lines
from tillscope.plans.shared import per_star
from tillscope.sources.star import Star


def customer_days(star: Star) -> DataFrame:
    """Bitmaps of the customers with a completed order, by day; built once for a sharing star."""
    def build() -> DataFrame:
        orders = with_calendar(star, star.completed_orders().select("customer_id", "order_date_id"), "date_actual")
        return id_bitmaps(orders, ["date_actual"], "customer_id")

    return per_star(star, "customer_days", build)


def customer_reach(star: Star) -> DataFrame:
    """Active customers of every day, month, year and of all time, each from the same daily bitmaps."""
    days = customer_days(star)
    levels = [("day", F.col("date_actual")), ("month", F.trunc("date_actual", "MM")), ("year", F.trunc("date_actual", "YEAR")),
              ("all", F.lit(None).cast("date"))]
    parts = [distinct_counts(days, [F.lit(name).alias("level"), start.alias("period_start")], "customers") for name, start in levels]
    return reduce(DataFrame.unionByName, parts)


def category_orders(star: Star) -> DataFrame:
    """Distinct completed orders per subcategory and month (V3's), per subcategory and year, category and month, category and year.

    Columns that a ``level`` leaves out are NULL.
    """
    names = ["category", "subcategory", "year", "month"]

    def build() -> DataFrame:
        products = star.product.select("product_id", "category", "subcategory")
        return id_bitmaps(completed_lines(star, "year", "month").join(products, "product_id"), names, "order_id")

    months = per_star(star, "category_order_bitmaps", build)
    types = dict(months.dtypes)
    parts = []
    for kept in (names, ["category", "subcategory", "year"], ["category", "year", "month"], ["category", "year"]):
        level = F.lit(",".join(kept)).alias("level")
        columns = [F.col(c) if c in kept else F.lit(None).cast(types[c]).alias(c) for c in names]
        parts.append(distinct_counts(months, [level, *columns], "orders"))
    return reduce(DataFrame.unionByName, parts)
