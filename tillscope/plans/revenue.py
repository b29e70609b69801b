"""Revenue views and reports: V1, V2, E1, E2, E5, E9, B1, B2, B3, B13.

All start from completed order headers; the status filter is pushed into
the scan; the calendar is generated, so its size is known and small
calendars are joined map-side without a hint.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import (
    avg_money, money, round_avg_money, round_ratio, cents, weekday_name, year_month_label,
)
from tillscope.operators.joins import with_calendar
from tillscope.operators.topk import top_k
from tillscope.sources.star import Star


def daily_revenue(star: Star) -> DataFrame:
    """V1: completed orders per calendar day (days without orders are absent)."""
    o = star.completed_orders().select("order_date_id", "order_total", "order_subtotal", "order_tax", "order_shipping")
    o = with_calendar(star, o, "date_actual", "year", "month", "week_of_year")
    return (o.groupBy(F.col("date_actual").alias("order_date"), "year", "month", "week_of_year")
            .agg(money(F.sum("order_total")).alias("total_revenue"),
                 money(F.sum("order_subtotal")).alias("subtotal_revenue"),
                 money(F.sum("order_tax")).alias("total_tax"),
                 money(F.sum("order_shipping")).alias("total_shipping"),
                 F.count(F.lit(1)).alias("order_count")))


def daily_revenue_between(star: Star, first: dt.date = dt.date(1996, 2, 10), last: dt.date = dt.date(1996, 5, 20)) -> DataFrame:
    """V1 over a range of days: only what the range needs is read."""
    return daily_revenue(star.between(first, last))


def revenue_by_channel_in_year(star: Star, year: int = 1997) -> DataFrame:
    """V2 over one calendar year."""
    return revenue_by_channel(star.in_year(year))


def _channel_month(star: Star) -> DataFrame:
    """Exact per (channel_id, year, month) sums; the channel names are joined after."""
    o = star.completed_orders().select("order_date_id", "channel_id", "order_total")
    o = with_calendar(star, o, "year", "month")
    return o.groupBy("channel_id", "year", "month").agg(
        F.sum("order_total").alias("_total"), F.count(F.lit(1)).alias("_n"))


def revenue_by_channel(star: Star) -> DataFrame:
    """V2: completed orders per (channel, year, month); orders without a channel form a NULL group.

    The fact is aggregated by channel id first and the (tiny) channel
    dimension joined to the aggregate, left outer, then the groups are
    re-keyed by name/group — equal to grouping the joined rows by name,
    since ids map to one name each (unique channel name).
    """
    agg = _channel_month(star)
    ch = star.channel.select("channel_id", "channel_name", "channel_group")
    j = agg.join(ch, "channel_id", "left")
    g = j.groupBy("channel_name", "channel_group", "year", "month").agg(
        F.sum("_total").alias("_total"), F.sum("_n").alias("order_count"))
    return g.select("channel_name", "channel_group", "year", "month",
                    money("_total").alias("total_revenue"), "order_count",
                    avg_money("_total", "order_count").alias("avg_order_value"))


def _monthly(star: Star) -> DataFrame:
    o = star.completed_orders().select("order_date_id", "order_total")
    o = with_calendar(star, o, "year", "month")
    return o.groupBy("year", "month").agg(F.sum("order_total").alias("_total"), F.count(F.lit(1)).alias("order_count"))


def monthly_revenue(star: Star) -> DataFrame:
    """Revenue, order count and rounded average order value per month."""
    m = _monthly(star)
    return m.select("year", "month", money("_total").alias("total_revenue"), "order_count",
                    round_avg_money("_total", "order_count").alias("avg_order_value")).orderBy("year", "month")


def yoy_growth(star: Star) -> DataFrame:
    """Month revenue against the same month one year earlier (self-join on year + 1).

    A missing prior month gives NULL (not a neighbour's value, as lag would);
    a prior revenue of 0 gives NULL growth.  The monthly aggregate is built
    once and read twice; it has one row per month.
    """
    m = _monthly(star).select("year", "month", "_total")
    prev = m.select((F.col("year") + 1).alias("year"), "month", F.col("_total").alias("_prev"))
    j = m.join(prev, ["year", "month"], "left")
    growth = round_ratio(cents(F.col("_total") - F.col("_prev")) * 100, cents("_prev"), 2)
    return j.select("year", "month", money("_total").alias("total_revenue"),
                    money("_prev").alias("prev_year_revenue"),
                    growth.alias("yoy_growth_percent")).orderBy("year", "month")


def top_channel_months(star: Star, k: int = 10) -> DataFrame:
    """E5: top k (channel, year, month) cells of V2 by revenue."""
    agg = _channel_month(star)
    ch = star.channel.select("channel_id", "channel_name")
    g = (agg.join(ch, "channel_id", "left").groupBy("channel_name", "year", "month")
         .agg(money(F.sum("_total")).alias("revenue")))
    return top_k(g, [F.col("revenue").desc()], k,
                 tie=[F.col("channel_name").asc_nulls_last(), F.col("year").asc(), F.col("month").asc()])


def weekday_distribution(star: Star) -> DataFrame:
    """Completed orders per ISO weekday with its name."""
    o = with_calendar(star, star.completed_orders().select("order_date_id"), "day_of_week")
    g = o.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("orders"))
    return g.select("day_of_week", weekday_name("day_of_week").alias("weekday_name"), "orders").orderBy("day_of_week")


def kpis(star: Star) -> DataFrame:
    """B1: one row — orders, active customers, revenue and average order value (completed)."""
    # order ids are the primary key: counting them counts distinct orders, and
    # one row per customer counts customers without shuffling every order
    per = star.completed_orders().groupBy("customer_id").agg(
        F.count("order_id").alias("_orders"), F.sum("order_total").alias("_sum"), F.count("order_total").alias("_cnt"))
    return per.agg(
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"),
        F.count("customer_id").alias("active_customers"),
        F.sum("_sum").alias("_total"),
        F.coalesce(F.sum("_cnt"), F.lit(0)).alias("_n"),
    ).select("total_orders", "active_customers", money("_total").alias("total_revenue"),
             avg_money("_total", "_n").alias("avg_order_value"))


def revenue_trend(star: Star) -> DataFrame:
    """B2: V1 summed by month, with a 'YYYY-MM' label."""
    o = star.completed_orders().select("order_date_id", "order_total")
    o = with_calendar(star, o, "year", "month")
    g = o.groupBy("year", "month").agg(money(F.sum("order_total")).alias("total_revenue"))
    return g.withColumn("year_month", year_month_label("year", "month")).orderBy("year", "month")


def channel_totals(star: Star) -> DataFrame:
    """V2 summed per channel name, by revenue descending."""
    # the calendar join of V2 is inner: keep only orders whose date key resolves
    o = with_calendar(star, star.completed_orders().select("order_date_id", "channel_id", "order_total"))
    agg = o.groupBy("channel_id").agg(F.sum("order_total").alias("_total"))
    ch = star.channel.select("channel_id", "channel_name")
    g = agg.join(ch, "channel_id", "left").groupBy("channel_name").agg(money(F.sum("_total")).alias("revenue"))
    return g.orderBy(F.col("revenue").desc(), F.col("channel_name").asc_nulls_last())


def daily_series(star: Star) -> DataFrame:
    """Revenue per calendar day (completed orders)."""
    o = with_calendar(star, star.completed_orders().select("order_date_id", "order_total"), "date_actual")
    g = o.groupBy(F.col("date_actual").alias("date")).agg(money(F.sum("order_total")).alias("total_revenue"))
    return g.orderBy("date")
