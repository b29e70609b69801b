"""Distributed operators against brute force on small inputs."""

import itertools
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillscope.operators.ntile import ntile
from tillscope.operators.pairs import pair_counts
from tillscope.operators.pivot import pivot_fill


def _tiles(spark, n, k, ties):
    rows = [(i, (i % ties) if ties else i) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = ntile(df, k, [F.col("v").desc()], "t", [F.col("id").asc()], partitions=3)
    want = df.withColumn("t", F.ntile(k).over(Window.orderBy(F.col("v").desc(), F.col("id").asc())))
    return sorted(got.select("id", "t").collect()), sorted(want.select("id", "t").collect())


def test_ntile_matches_window(spark):
    for n, k, ties in [(100, 5, 0), (101, 4, 3), (3, 5, 0), (17, 20, 2), (1, 5, 0), (250, 7, 1)]:
        got, want = _tiles(spark, n, k, ties)
        assert got == want, (n, k, ties)


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = spark.range(0, 1003).withColumn("v", F.col("id") % 11)
    t = ntile(df, 5, [F.col("v").asc()], "t", [F.col("id").asc()], partitions=4)
    sizes = [r["count"] for r in t.groupBy("t").count().collect()]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1


def _brute_pairs(rows, min_count):
    baskets = {}
    for b, i in set(rows):
        baskets.setdefault(b, set()).add(i)
    counts = {}
    for items in baskets.values():
        for x, y in itertools.combinations(sorted(items), 2):
            counts[(x, y)] = counts.get((x, y), 0) + 1
    return sorted((x, y, n) for (x, y), n in counts.items() if n >= min_count)


def test_pairs_match_brute_force_including_hot_basket(spark):
    rnd = random.Random(7)
    rows = [(b, rnd.randint(1, 30)) for b in range(1, 200) for _ in range(rnd.randint(1, 5))]
    rows += [(0, i) for i in range(1, 60)]  # one hot basket with many items
    rows += rows[:20]  # duplicated lines
    df = spark.createDataFrame(sorted(set(rows)), "basket long, item long")
    for min_count, chunk in [(1, 8), (2, 8), (3, 1000), (2, 1)]:
        res = pair_counts(df, "basket", "item", min_count, chunk_items=chunk).collect()
        got = sorted((r["item_1"], r["item_2"], r["n"]) for r in res)
        assert got == _brute_pairs(rows, min_count), (min_count, chunk)
        per_item = {i: len({b for b, j in set(rows) if j == i}) for _, i in rows}
        assert all(r["n_1"] == per_item[r["item_1"]] and r["n_2"] == per_item[r["item_2"]] for r in res)


def test_pivot_fill_drops_null_keys_and_fills_zero(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 2, 1.0), (None, 1, 9.0), ("c", None, 3.0)],
                               "k string, m int, v double")
    rows = {r["k"]: (r["1"], r["2"]) for r in pivot_fill(df, "k", "m", "v", [1, 2]).collect()}
    assert rows == {"a": (2.0, 4.0), "b": (0.0, 1.0)}


def test_ntile_default_partitioning_with_coalescing(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "50")  # AQE merges most of these ranges
    try:
        df = spark.range(0, 2000).withColumn("v", (F.col("id") * 7919) % 13)
        got = ntile(df, 9, [F.col("v").asc()], "t", [F.col("id").desc()])
        want = df.withColumn("t", F.ntile(9).over(Window.orderBy(F.col("v").asc(), F.col("id").desc())))
        assert sorted(got.select("id", "t").collect()) == sorted(want.select("id", "t").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tiles_by_selection_equal_window_tiles(spark, monkeypatch):
    from tillscope.operators import ntile as nt

    rows = [(i * 3 % 1009, None if i % 17 == 0 else i * 7919 % 13, i % 3, i * i * i % 100_003 - 50_000) for i in range(1000)]
    rows = [(i, 5 if j % 3 == 0 else v, w, x) for j, (i, v, w, x) in enumerate(rows)]  # a third has one value
    for grid in (1000, 7):  # coarse brackets hold many values
        monkeypatch.setattr(nt, "GRID", grid)
        for n, k in ((0, 4), (1, 4), (3, 4), (4, 4), (5, 1), (101, 5), (1000, 7)):
            df = spark.createDataFrame(rows[:n], "id long, v long, w int, x long").repartition(3)
            sorts = {"a": nt.ascending_key(F.col("v")), "b": nt.descending_key(F.col("v")),
                     "c": nt.descending_key(F.col("w")), "d": nt.ascending_key(F.col("x"))}
            got = nt.tiles_by_selection(df, k, sorts, "id").select("id", *sorts).collect()
            tile = lambda *order: F.ntile(k).over(Window.orderBy(*order, F.col("id").asc()))  # noqa: E731, B023
            want = df.select("id", tile(F.col("v").asc()), tile(F.col("v").desc()), tile(F.col("w").desc()), tile(F.col("x").asc())).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, want)), (n, k)


def test_tiles_by_selection_fail_rather_than_differ(spark, monkeypatch):
    import pytest

    from tillscope.operators import ntile as nt

    df = spark.range(1000)
    real = nt._sketched
    monkeypatch.setattr(nt, "_sketched", lambda *a: real(*a).withColumn("grid", F.transform("grid", lambda x: F.lit(-5).cast("long"))))
    with pytest.raises(Exception, match="tile cuts not found"):
        nt.tiles_by_selection(df, 5, {"t": nt.ascending_key(F.col("id"))}, "id").collect()
