"""Generated dimensions: the calendar (L2) and the channel list (L3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.sources.schema import DIM_CHANNEL

# The eight acquisition channels (name, group, details), ids 1..8 in this order.
CHANNELS = [
    ("Direct", "Owned", "Direct traffic: URL or app open"),
    ("Organic Search", "Organic", "Search engine results (SEO)"),
    ("Paid Search", "Paid", "Search ads (PPC)"),
    ("Email", "Owned", "Email campaigns and newsletters"),
    ("Social", "Organic", "Organic social media traffic"),
    ("Paid Social", "Paid", "Paid ads on social platforms"),
    ("Referral", "Organic", "Traffic from other websites"),
    ("Display Ads", "Paid", "Banner/display ad campaigns"),
]

# The reference calendar range.
DEFAULT_START = dt.date(2020, 1, 1)
DEFAULT_END = dt.date(2024, 12, 31)


def date_key(d: Column) -> Column:
    """yyyymmdd integer key of a date."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The calendar attributes of a DATE column, in dim_date order."""
    iso_dow = (F.weekday(d) + 1).cast("int")  # 1 = Monday .. 7 = Sunday
    return [
        date_key(d).alias("date_id"),
        d.alias("date_actual"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        iso_dow.alias("day_of_week"),
        iso_dow.isin(6, 7).alias("is_weekend"),
        F.weekofyear(d).cast("int").alias("week_of_year"),  # ISO week beside the calendar year
    ]


def build_dim_date(spark: SparkSession, start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> DataFrame:
    """L2: one row per day of [start, end].

    Built from ``spark.range`` over day offsets, so the rows are generated
    in parallel rather than exploded from one array in one task.
    """
    n_days = (end - start).days + 1
    days = spark.range(0, max(n_days, 0), numPartitions=max(1, min(64, n_days // 4096 + 1)))
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return days.select(d.alias("d")).select(*calendar_columns(F.col("d")))


def dim_date_rows(start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> int:
    """Proven row count of ``build_dim_date(start, end)``."""
    return max((end - start).days + 1, 0)


def calendar_for(df: DataFrame, date_col: str, whole_years: bool = False) -> DataFrame:
    """Calendar rows covering [min, max] of a date column of ``df``, widened to whole years on request.

    The range is computed by Spark (one global min/max aggregate) and the
    days are generated with ``sequence`` + ``explode`` on the executors.
    Without dates there are no rows.
    """
    lo, hi = F.min(F.to_date(date_col)), F.max(F.to_date(date_col))
    if whole_years:
        lo, hi = F.make_date(F.year(lo), F.lit(1), F.lit(1)), F.make_date(F.year(hi), F.lit(12), F.lit(31))
    bounds = df.agg(lo.alias("lo"), hi.alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def build_dim_channel(spark: SparkSession) -> DataFrame:
    """L3: the static channel dimension (8 rows, ids 1..8)."""
    # literal rows expanded on the JVM (no Python-side RDD behind the table)
    rows = [F.struct(F.lit(i + 1).cast("long").alias("channel_id"), F.lit(name).alias("channel_name"),
                     F.lit(group).alias("channel_group"), F.lit(details).alias("details"))
            for i, (name, group, details) in enumerate(CHANNELS)]
    df = spark.range(1).select(F.inline(F.array(*rows)))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_CHANNEL.fields])
