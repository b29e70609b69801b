"""Co-occurrence counting of item pairs within baskets (J7, §4.3 basket pairs).

Input: (basket, item) rows, repeats allowed.  Output: (item_1, item_2, n) with
item_1 < item_2 and n = number of baskets holding both (n ≥ min_count), and on
request n_1, n_2 = number of baskets holding each item.

* A basket becomes one row with the sorted array of its distinct items, and its
  pairs are made inside that row: each item meets those behind it.  There is no
  self-join; rows move once by basket and once by pair (counts are combined
  before they move), and the plan is lazy.
* A basket of more than ``chunk_items`` items is cut into chunks of its array.
  Its pairs of chunks are dealt over the tasks before pairs of items are made,
  so one huge basket is not one task's work.  An array never holds more than the
  distinct items there are.
* A pair's threshold is applied to its count; items are counted from the same
  baskets and only joined to pairs that reached it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK_ITEMS = 2048


def basket_arrays(rows: DataFrame, basket: str, item: str) -> DataFrame:
    """(basket, items): the sorted distinct items of each basket; NULL baskets and items are left out."""
    return rows.where(F.col(basket).isNotNull()).groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))


def _behind(items: str, at: Column) -> Column:
    """The items behind place ``at`` of an array."""
    return F.slice(items, at + 2, F.size(items))


def _item_pairs(left: DataFrame) -> DataFrame:
    """(item_1, item_2) from rows (first, second): arrays to pair, ``second`` NULL for the pairs within ``first``."""
    each = left.select("first", "second", F.posexplode("first").alias("_at", "item_1"))
    partners = F.coalesce("second", _behind("first", F.col("_at")))
    return each.select("item_1", F.explode(partners).alias("item_2"))


def pair_counts(rows: DataFrame, basket: str, item: str, min_count: int = 1,
                chunk_items: int = DEFAULT_CHUNK_ITEMS, item_counts: bool = True) -> DataFrame:
    """(item_1, item_2, n) and, with ``item_counts``, (n_1, n_2) over (basket, item) rows, n ≥ min_count."""
    arrays = basket_arrays(rows, basket, item)
    none = F.lit(None).cast(arrays.schema["items"].dataType)
    short = arrays.where(F.size("items") <= chunk_items).select(F.col("items").alias("first"), none.alias("second"))
    # of a long basket every pair of chunks a <= b is a row of its own, dealt over the tasks
    last = F.ceil(F.size("items") / F.lit(chunk_items)).cast("int") - 1
    chunk = lambda c: F.slice("items", F.col(c) * chunk_items + 1, F.lit(chunk_items))
    long = (
        arrays.where(F.size("items") > chunk_items)
        .select(basket, "items", last.alias("_last"), F.explode(F.sequence(F.lit(0), last)).alias("_a"))
        .select(basket, "items", "_a", F.explode(F.sequence(F.col("_a"), F.col("_last"))).alias("_b"))
        .select(basket, "_a", "_b", chunk("_a").alias("first"), F.when(F.col("_a") < F.col("_b"), chunk("_b")).alias("second"))
        .repartition(basket, "_a", "_b").select("first", "second"))
    counted = _item_pairs(short.unionByName(long)).groupBy("item_1", "item_2").agg(F.count(F.lit(1)).alias("n"))
    if min_count > 1:
        counted = counted.where(F.col("n") >= min_count)
    if not item_counts:
        return counted
    per_item = arrays.select(F.explode("items").alias("_item")).groupBy("_item").agg(F.count(F.lit(1)).alias("_n"))
    of = lambda x: per_item.select(F.col("_item").alias(f"item_{x}"), F.col("_n").alias(f"n_{x}"))
    return counted.join(of(1), "item_1").join(of(2), "item_2").select("item_1", "item_2", "n", "n_1", "n_2")
