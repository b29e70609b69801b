"""Product and category views and reports: V3, V10, E6, E7, B9, B10, B16, B17.

Lines are restricted to completed orders by joining the line fact to the
order header on ``order_id`` (the one fact-to-fact shuffle join).  Where a
measure is additive per product (revenue, units, cost = cost · Σ quantity)
the lines are first aggregated per product (and month), so the product
join and the final grouping see one row per product-month, and a hot
product collapses map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import cents, money, round_ratio, year_month_label
from tillscope.operators.joins import with_calendar
from tillscope.operators.pivot import pivot_fill
from tillscope.operators.topk import top_k
from tillscope.plans.shared import per_star
from tillscope.sources.star import Star


def completed_lines(star: Star, *calendar_cols: str) -> DataFrame:
    """Order lines of completed orders, optionally with calendar columns of the order date."""
    o = star.completed_orders().select("order_id", "order_date_id")
    if calendar_cols:
        o = with_calendar(star, o, *calendar_cols)
    o = o.drop("order_date_id")
    items = star.items.select("order_id", "product_id", "quantity", "line_total")
    return items.join(o, "order_id")


def _product_month(star: Star) -> DataFrame:
    """Σ line_total and Σ quantity per (product, year, month) over completed lines."""
    lines = completed_lines(star, "year", "month")
    return lines.groupBy("product_id", "year", "month").agg(
        F.sum("line_total").alias("_rev"), F.sum("quantity").alias("_qty"))


def revenue_by_category(star: Star) -> DataFrame:
    """V3: line revenue, units and distinct orders per (category, subcategory, year, month)."""
    # one row per (order, group) while the lines are still together by order:
    # distinct orders are then a count, and no order id is shuffled by group
    lines = completed_lines(star, "year", "month")
    p = star.product.select("product_id", "category", "subcategory")
    per_order = lines.join(p, "product_id").groupBy("order_id", "category", "subcategory", "year", "month").agg(
        F.sum("line_total").alias("_rev"), F.sum("quantity").alias("_qty"))
    return per_order.groupBy("category", "subcategory", "year", "month").agg(
        money(F.sum("_rev")).alias("line_revenue"),
        F.sum("_qty").cast("long").alias("units_sold"),
        F.count(F.lit(1)).alias("orders_with_category"),
    )


def revenue_by_category_in_month(star: Star, year: int = 1995, month: int = 3) -> DataFrame:
    """V3 over one month: of both facts only that month is read."""
    return revenue_by_category(star.in_year(year, month))


def _margin(star: Star) -> DataFrame:
    """Exact revenue and cost per (category, subcategory, year, month).

    Read by V10, B9, B10, B16 and B17; the table is small (category-month
    grain) and built once per star.
    """
    return per_star(star, "category_month", lambda: _build_margin(star))


def _build_margin(star: Star) -> DataFrame:
    return margin_of(_product_month(star), star.product)


def margin_of(product_month: DataFrame, product: DataFrame) -> DataFrame:
    """Exact revenue and cost by category and month from (product_id, year, month, _rev, _qty)."""
    p = product.select("product_id", "category", "subcategory", "cost")
    j = product_month.join(p, "product_id")
    return j.groupBy("category", "subcategory", "year", "month").agg(
        F.sum("_rev").alias("_rev"), F.sum(F.col("_qty") * F.col("cost")).alias("_cost"))


def _margin_cols(df: DataFrame) -> list:
    rev, cost = F.col("_rev"), F.col("_cost")
    pct = F.when(rev == 0, F.lit(0.0)).otherwise(round_ratio(cents(rev - cost) * 100, cents(rev), 2))
    return [money(rev).alias("revenue"), money(cost).alias("total_cost"),
            money(rev - cost).alias("gross_profit"), pct.alias("gross_margin_percent")]


def category_margin_monthly(star: Star) -> DataFrame:
    """Revenue, cost (quantity · current product cost), profit and margin % per category-month.

    Margin is 0 when revenue is 0; lines of products without a cost count in
    revenue but not in cost.
    """
    return margin_view(_margin(star))


def margin_view(m: DataFrame) -> DataFrame:
    return m.select("category", "subcategory", "year", "month", *_margin_cols(m))


def best_sellers(star: Star, k: int = 20) -> DataFrame:
    """Top k product names (with category, subcategory) by revenue, with units sold."""
    lines = completed_lines(star)
    per = lines.groupBy("product_id").agg(F.sum("line_total").alias("_rev"), F.sum("quantity").alias("_qty"))
    j = per.join(star.product.select("product_id", "product_name", "category", "subcategory"), "product_id")
    g = j.groupBy("product_name", "category", "subcategory").agg(
        F.sum("_rev").alias("_rev"), F.sum("_qty").cast("long").alias("units_sold"))
    best = top_k(g, [F.col("_rev").desc()], k,
                 tie=[F.col(c).asc_nulls_last() for c in ("product_name", "category", "subcategory")])
    return best.select("product_name", "category", "subcategory", money("_rev").alias("revenue"), "units_sold")


def product_profitability(star: Star, k: int = 20) -> DataFrame:
    """Top k (product name, category, cost) groups by gross profit."""
    lines = completed_lines(star)
    per = lines.groupBy("product_id").agg(F.sum("line_total").alias("_rev"), F.sum("quantity").alias("_qty"))
    j = per.join(star.product.select("product_id", "product_name", "category", "cost"), "product_id")
    g = j.groupBy("product_name", "category", "cost").agg(
        F.sum("_rev").alias("_rev"), F.sum(F.col("_qty") * F.col("cost")).alias("_cost"))
    g = g.withColumn("_profit", F.col("_rev") - F.col("_cost"))
    best = top_k(g, [F.col("_profit").desc_nulls_first()], k,
                 tie=[F.col(c).asc_nulls_last() for c in ("product_name", "category", "cost")])
    return best.select("product_name", "category", money("cost").alias("cost"), money("_rev").alias("revenue"),
                       money("_cost").alias("total_cost"), money("_profit").alias("gross_profit"))


def category_margin(star: Star) -> DataFrame:
    """V10 projected for reporting, sorted by year, month, category, subcategory."""
    v = category_margin_monthly(star)
    return v.select("year", "month", "category", "subcategory", "revenue", "total_cost", "gross_profit",
                    "gross_margin_percent").orderBy("year", "month", F.col("category").asc_nulls_last(),
                                                    F.col("subcategory").asc_nulls_last())


def top_category_margin(star: Star, n: int = 3) -> DataFrame:
    """Margin rows (B9) of the n categories with the most revenue, with a 'YYYY-MM' label.

    The category ranking drops a NULL category (as a dataframe group-by
    does).  The n-row set is joined back as a broadcast semi join.
    """
    m = _margin(star)
    cats = (m.where(F.col("category").isNotNull()).groupBy("category").agg(F.sum("_rev").alias("_cat_rev")))
    top = top_k(cats, [F.col("_cat_rev").desc()], n, tie=[F.col("category").asc()]).select("category")
    rows = m.join(F.broadcast(top), "category", "left_semi")
    return rows.select("year", "month", "category", "subcategory", *_margin_cols(rows),
                       year_month_label("year", "month").alias("year_month")).orderBy(
        "category", "year", "month", F.col("subcategory").asc_nulls_last())


def category_seasonality(star: Star) -> DataFrame:
    """Revenue per calendar month × category, over all years."""
    m = _margin(star)
    g = m.groupBy("month", "category").agg(money(F.sum("_rev")).alias("total_revenue"))
    return g.orderBy("month", F.col("category").asc_nulls_last())


def seasonality_matrix(star: Star) -> DataFrame:
    """B16 pivoted to one row per category and one column per calendar month 1..12; 0 where missing."""
    s = category_seasonality(star)
    return pivot_fill(s, index="category", columns="month", values="total_revenue", pivot_values=list(range(1, 13)))
