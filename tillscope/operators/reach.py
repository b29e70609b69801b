"""Exact distinct counts that roll up: bitmaps of ids.

A count of distinct ids cannot be added up over days, their bitmaps can: a table
of one bitmap per group and block of 64 ids is built once, in one aggregation
over the facts, and any coarser grouping follows by OR-ing bitmaps, without
going back to the facts.  A bitmap is one whole number, so groups with few ids
of a wide range take a row of fixed size an id and never more, and the
aggregations are hash aggregations that spill.  Ids are whole numbers; NULL ids
count for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "id_bits"


def id_bitmaps(df: DataFrame, groups: list[str], id_col: str) -> DataFrame:
    """(groups, id_block, id_bits): which ids of a block occur in the group."""
    known = df.where(F.col(id_col).isNotNull()).select(*groups, F.col(id_col).cast("long").alias("_id"))
    ids = known.select(*groups, F.shiftright("_id", 6).alias(BLOCK),
                       F.expr("shiftleft(1L, cast(_id & 63L as int))").alias("_bit"))  # & and >> keep negative ids apart, too
    return ids.groupBy(*groups, BLOCK).agg(F.bit_or("_bit").alias(BITS))


def merged_bitmaps(bitmaps: DataFrame, groups: list) -> DataFrame:
    """Bitmaps of coarser ``groups`` (columns of ``bitmaps``, or expressions over them with an alias); also joins batches."""
    return bitmaps.groupBy(*groups, BLOCK).agg(F.bit_or(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, groups: list, out: str) -> DataFrame:
    """(groups, out): the exact number of distinct ids per group."""
    per_block = merged_bitmaps(bitmaps, groups)
    names = [c for c in per_block.columns if c not in (BLOCK, BITS)]
    return per_block.groupBy(*names).agg(F.sum(F.bit_count(BITS)).cast("long").alias(out))
