"""Customer views and reports: V4–V7, E3, E4, E8, E10, B4–B6, B18.

Every per-customer figure is aggregated on ``customer_id`` over the order
facts *before* the customer dimension is joined: the partial aggregate
collapses a very active customer map-side, and the join then sees one row
per customer instead of one per order.  (Grouping by the customer's
attributes, as SQL does, is the same as grouping by its primary key.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import avg_money, cents, money, month_start, round_avg_money, round_ratio
from tillscope.operators.joins import with_calendar
from tillscope.operators.ntile import ascending_key, descending_key, ntile, tiles_by_selection
from tillscope.operators.topk import top_k
from tillscope.plans.shared import per_star
from tillscope.sources.star import Star

# LTV tier names for revenue quartiles 1..4.
LTV_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]

LTV_ATTRS = ["customer_id", "customer_key", "first_name", "last_name", "segment", "country", "region", "city"]
RFM_ATTRS = ["customer_id", "customer_key", "first_name", "last_name", "segment"]


def _per_customer(star: Star) -> DataFrame:
    """Completed-order figures per customer, exact (decimal sum kept as ``_total``).

    Read by V4–V7, E3, B4–B6, B18 and the segment rows; one row per customer,
    built once per star.
    """
    return per_star(star, "per_customer", lambda: _build_per_customer(star))


def _build_per_customer(star: Star) -> DataFrame:
    o = star.completed_orders().select("order_id", "customer_id", "order_date_id", "order_total")
    o = with_calendar(star, o, "date_actual")
    return o.groupBy("customer_id").agg(
        F.min("date_actual").alias("first_order_date"),
        F.max("date_actual").alias("last_order_date"),
        F.countDistinct("order_id").alias("_orders"),
        F.sum("order_total").alias("_total"),
        F.count("order_total").alias("_n"),
    )


def _ltv(star: Star) -> DataFrame:
    per = _per_customer(star)
    return star.customer.select(*LTV_ATTRS).join(per, "customer_id")


def customer_lifetime_value(star: Star) -> DataFrame:
    """V4: one row per customer with at least one completed order."""
    return _ltv(star).select(
        *LTV_ATTRS, "first_order_date", "last_order_date",
        F.col("_orders").alias("total_orders"),
        money("_total").alias("total_revenue"),
        avg_money("_total", "_n").alias("avg_order_value"),
    )


def _rfm_figures(star: Star) -> DataFrame:
    """V5 without the recency, which needs the end of the calendar."""
    per = _per_customer(star)
    return star.customer.select(*RFM_ATTRS).join(per, "customer_id").select(
        *RFM_ATTRS, "first_order_date", "last_order_date", F.col("_orders").alias("frequency"), "_total")


def _with_recency(star: Star, figures: DataFrame, as_of: F.Column | None = None) -> DataFrame:
    if as_of is None:
        # recency is measured from the end of the calendar dimension: one
        # global max, evaluated once as a scalar subquery
        as_of = star.date.agg(F.max("date_actual")).scalar()
    tiles = [c for c in figures.columns if c.endswith("_score")]
    return figures.withColumn("_as_of", as_of).select(
        *RFM_ATTRS, "first_order_date", "last_order_date",
        F.datediff("_as_of", "last_order_date").cast("int").alias("recency_days"),
        "frequency", money("_total").alias("monetary_value"), "_total", *tiles,
    )


def _rfm_base(star: Star, as_of: F.Column | None = None) -> DataFrame:
    return _with_recency(star, _rfm_figures(star), as_of)


def rfm_base(star: Star, as_of: F.Column | None = None) -> DataFrame:
    """V5: recency (days from ``as_of``, default the calendar's last day), frequency, monetary."""
    return _rfm_base(star, as_of).drop("_total")


def rfm_scores(star: Star, best: str = "low", small: bool = False) -> DataFrame:
    """V6: RFM quintiles and the combined score/code (shared per star; see ``_rfm_scores``)."""
    return per_star(star, ("rfm_scores", best, small), lambda: _rfm_scores(star, best, small))


def _rfm_scores(star: Star, best: str = "low", small: bool = False) -> DataFrame:
    """V6: RFM quintiles and the combined score/code.

    As in the reference, tiles are taken over recency ascending, frequency
    descending and monetary descending, so 1 is the best tile
    (``best="low"``); ``best="high"`` flips them so 5 is best.  Ties are
    broken by ``customer_id`` so the tiles are deterministic.
    """
    if small:
        b = _rfm_base(star)
        tie = [F.col("customer_id").asc()]
        b = ntile(b, 5, [F.col("recency_days").asc()], "recency_score", tie, small)
        b = ntile(b, 5, [F.col("frequency").desc()], "frequency_score", tie, small)
        b = ntile(b, 5, [F.col("_total").desc()], "monetary_score", tie, small)
    else:  # the least recency is the latest date
        b = tiles_by_selection(_rfm_figures(star), 5, {
            "recency_score": descending_key(F.unix_date("last_order_date")),
            "frequency_score": descending_key(F.col("frequency")),
            "monetary_score": descending_key(cents("_total")),
        }, "customer_id")
        b = _with_recency(star, b)
    if best == "high":
        for c in ("recency_score", "frequency_score", "monetary_score"):
            b = b.withColumn(c, (6 - F.col(c)).cast("int"))
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return b.select(
        *RFM_ATTRS, "first_order_date", "last_order_date", "recency_days", "frequency", "monetary_value",
        "recency_score", "frequency_score", "monetary_score",
        (r * 100 + f * 10 + m).cast("int").alias("rfm_score"),
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_code"),
    )


def _ltv_tiers(star: Star, small: bool = False) -> DataFrame:
    return per_star(star, ("ltv_tiers", small), lambda: _build_ltv_tiers(star, small))


def _build_ltv_tiers(star: Star, small: bool = False) -> DataFrame:
    l = _ltv(star)
    if small:
        l = ntile(l, 4, [F.col("_total").asc()], "revenue_quartile", [F.col("customer_id").asc()], small)
    else:
        l = tiles_by_selection(l, 4, {"revenue_quartile": ascending_key(cents("_total"))}, "customer_id")
    tier = None
    for i, name in enumerate(LTV_TIERS, start=1):
        cond = F.col("revenue_quartile") == i
        tier = F.when(cond, F.lit(name)) if tier is None else tier.when(cond, F.lit(name))
    return l.withColumn("ltv_segment", tier)


def ltv_segments(star: Star, small: bool = False) -> DataFrame:
    """V7: V4 plus revenue quartile (ascending) and its tier name."""
    return _ltv_tiers(star, small).select(
        *LTV_ATTRS, "first_order_date", "last_order_date",
        F.col("_orders").alias("total_orders"),
        money("_total").alias("total_revenue"),
        avg_money("_total", "_n").alias("avg_order_value"),
        "revenue_quartile", "ltv_segment",
    )


def top_customers(star: Star, k: int = 20) -> DataFrame:
    """The k customers with the highest lifetime revenue."""
    v = _ltv(star)
    best = top_k(v, [F.col("_total").desc()], k, tie=[F.col("customer_id").asc()])
    return best.select("customer_key", "first_name", "last_name", "segment",
                       F.col("_orders").alias("total_orders"), money("_total").alias("total_revenue"),
                       avg_money("_total", "_n").alias("avg_order_value"))


def signup_cohorts(star: Star) -> DataFrame:
    """Completed orders and revenue by signup month × order month."""
    o = star.completed_orders().select("order_id", "customer_id", "order_date_id", "order_total")
    o = with_calendar(star, o, "year", "month")
    c = star.customer.select("customer_id", month_start("created_date").alias("cohort_month"))
    # an order is one customer's and one day's, so each customer's months can be
    # counted and summed up before they meet the customer table
    per = o.groupBy("customer_id", "year", "month").agg(F.countDistinct("order_id").alias("_n"), F.sum("order_total").alias("_total"))
    g = per.join(c, "customer_id").groupBy("cohort_month", "year", "month").agg(
        F.sum("_n").alias("orders"), money(F.sum("_total")).alias("revenue"))
    return g.orderBy(F.col("cohort_month").asc_nulls_last(), "year", "month")


def repeat_rate(star: Star) -> DataFrame:
    """One-time vs repeat customers among those with completed orders (one row)."""
    per = star.completed_orders().groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders"))
    a = per.agg(
        F.count_if(F.col("total_orders") == 1).alias("one_time_customers"),
        F.count_if(F.col("total_orders") > 1).alias("repeat_customers"),
        F.count(F.lit(1)).alias("_all"),
    )
    return a.select("one_time_customers", "repeat_customers",
                    round_ratio(F.col("repeat_customers") * 100, "_all", 2).alias("repeat_rate_percent"))


def segment_order_size(star: Star) -> DataFrame:
    """Orders, rounded average order value and revenue per customer segment."""
    per = star.completed_orders().groupBy("customer_id").agg(
        F.sum("order_total").alias("_total"), F.count(F.lit(1)).alias("_n"))
    j = per.join(star.customer.select("customer_id", "segment"), "customer_id")
    g = j.groupBy("segment").agg(F.sum("_total").alias("_total"), F.sum("_n").alias("total_orders"))
    return g.select("segment", "total_orders", round_avg_money("_total", "total_orders").alias("avg_order_value"),
                    money("_total").alias("total_revenue")).orderBy(F.col("total_revenue").desc())


def ltv_segment_summary(star: Star, small: bool = False) -> DataFrame:
    """Customers, rounded average and total revenue per LTV tier."""
    t = _ltv_tiers(star, small)
    g = t.groupBy("ltv_segment").agg(F.count(F.lit(1)).alias("customers"), F.sum("_total").alias("_sum"))
    return g.select("ltv_segment", "customers", round_avg_money("_sum", "customers").alias("avg_revenue"),
                    money("_sum").alias("total_revenue")).orderBy(F.col("total_revenue").desc())


def rfm_top(star: Star, k: int = 20, small: bool = False) -> DataFrame:
    """K rows of V6 by rfm_score DESC, monetary DESC (with tile 1 = best these are the weakest)."""
    s = rfm_scores(star, small=small)
    best = top_k(s, [F.col("rfm_score").desc(), F.col("monetary_value").desc()], k,
                 tie=[F.col("customer_id").asc()])
    return best.select("customer_key", "first_name", "last_name", "segment", "recency_days", "frequency",
                       "monetary_value", "recency_score", "frequency_score", "monetary_score", "rfm_score",
                       "rfm_code")


def rfm_points(star: Star) -> DataFrame:
    """Frequency, monetary and recency of every scored customer (V6 has V5's rows)."""
    return rfm_base(star).select("frequency", "monetary_value", "recency_days")


def rfm_features(star: Star) -> DataFrame:
    """The clustering features per customer."""
    return rfm_features_exact(star).drop("_total")


def rfm_features_exact(star: Star) -> DataFrame:
    """B18 with the exact monetary sum as ``_total``."""
    return _rfm_base(star).select("customer_id", "recency_days", "frequency", "monetary_value", "_total")
