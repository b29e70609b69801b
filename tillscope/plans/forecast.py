"""Monthly moving average and naive forecast: B14, B15.

The daily series is reduced to monthly totals (one row per month with
orders) before any ordering happens; the ordered 3-row window then runs
over at most 12 rows per calendar year, so its single partition holds a
calendar-bounded frame, not the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.common import money, month_start
from tillscope.operators.joins import with_calendar
from tillscope.sources.star import Star


def _monthly(star: Star) -> DataFrame:
    o = with_calendar(star, star.completed_orders().select("order_date_id", "order_total"), "date_actual")
    return o.groupBy(month_start("date_actual").alias("date")).agg(F.sum("order_total").alias("_total"))


def moving_average(df: DataFrame, value: str, order: str, n: int = 3, out: str = "ma") -> DataFrame:
    """Mean of the last ``n`` rows (by ``order``), NULL until ``n`` rows exist (pandas rolling(n).mean())."""
    w = Window.orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(F.lit(1)).over(w) == n,
                                     F.sum(value).over(w).cast("double") / F.lit(float(n))))


def monthly_moving_average(star: Star, n: int = 3) -> DataFrame:
    """Monthly revenue and its n-month moving average over the months present."""
    m = moving_average(_monthly(star), "_total", "date", n, "ma_3")
    return m.select("date", money("_total").alias("total_revenue"), "ma_3").orderBy("date")


def naive_forecast(star: Star, horizon: int = 6, n: int = 3) -> DataFrame:
    """The next ``horizon`` month starts after the last month, each at the last moving average."""
    m = moving_average(_monthly(star), "_total", "date", n, "ma_3")
    last = m.agg(F.max("date").alias("_last"), F.max_by("ma_3", "date").alias("_ma"))
    months = F.sequence(F.add_months("_last", 1), F.add_months("_last", horizon), F.expr("INTERVAL 1 MONTH"))
    return last.select(F.explode(months).alias("date"), F.col("_ma").alias("forecast_revenue")).orderBy("date")
