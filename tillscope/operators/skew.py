"""Joins on skewed keys (J2): only heavy keys are salted, and only they are replicated.

A distributed frequent-items sketch over the left side's key finds every key
that holds at least ``support`` of its rows (and possibly a few that don't,
which costs a few copies and nothing else).  Left rows of such a key are spread
over ``salts`` values by a hash of the whole row, right rows of it are
replicated once per salt, and the join is on (key, salt).  All other rows join
as they would without.  The plan is lazy: the sketch, at most 1 / ``support``
keys, is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, support: float) -> Column:
    """The keys with at least ``support`` of the rows, as one array (a scalar subquery)."""
    return df.where(F.col(key).isNotNull()).freqItems([key], support).select(F.col(f"{key}_freqItems")).scalar()


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", support: float = 0.001, salts: int = 256) -> DataFrame:
    """``left`` joined with ``right`` on ``key``; ``how``: inner, left, left_semi or left_anti.

    A NULL key joins nothing.  Left rows that repeat as a whole share a salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: right rows are replicated, so only joins that keep left rows once are possible")
    salt = "_salt"
    while salt in left.columns or salt in right.columns:
        salt = "_" + salt
    heavy = heavy_keys(left, key, support)
    of_row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    is_heavy = lambda: F.coalesce(F.array_contains(F.col("_heavy"), F.col(key)), F.lit(False))
    spread = left.withColumn("_heavy", heavy).withColumn(salt, F.when(is_heavy(), of_row).otherwise(0)).drop("_heavy")
    copies = F.when(is_heavy(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.withColumn("_heavy", heavy).withColumn(salt, F.explode(copies)).drop("_heavy")
    return spread.join(copied, [key, salt], how).drop(salt)
