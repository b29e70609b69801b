"""Bitmap counts that roll up, summaries that take in batches, and joins on heavy keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from star_tables import SMOKE, customer, item, make_star, order, product
from tillscope.operators.reach import distinct_counts, id_bitmaps, merged_bitmaps
from tillscope.operators.skew import heavy_keys, salted_join
from tillscope.plans import products, revenue
from tillscope.plans.summaries import SummaryStore
from tillscope.sources.driver import driver_star


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_bitmaps_count_exactly_at_every_level(spark):
    rnd = random.Random(5)
    rows = [(f"d{rnd.randrange(6)}", rnd.choice([None, "x", "y"]), rnd.choice([0, 32767, 32768, 10**12, rnd.randrange(200_000)]))
            for _ in range(3000)] + [("d1", "x", None), ("d9", None, None)]
    df = spark.createDataFrame(rows, "day string, kind string, id long").repartition(5)
    bits = id_bitmaps(df, ["day", "kind"], "id")
    for groups in (["day", "kind"], ["day"], ["kind"], []):
        want = df.where("id is not null").groupBy(*groups).agg(F.countDistinct("id").alias("n"))
        assert _rows(distinct_counts(bits, [F.col(g) for g in groups], "n").select(*groups, "n")) == _rows(want)
    halves = [id_bitmaps(df.where(F.col("id") % 2 == odd), ["day"], "id") for odd in (0, 1)]
    both = merged_bitmaps(halves[0].unionByName(halves[1]), ["day"])
    assert _rows(distinct_counts(both, ["day"], "n")) == _rows(df.where("id is not null").groupBy("day").agg(F.countDistinct("id").alias("n")))


def test_bitmaps_of_scattered_ids_stay_small(spark, capsys):
    df = spark.range(-50, 50).selectExpr("'d' || id % 3 as day", "id * 40000 as id")
    bits = id_bitmaps(df, ["day"], "id")
    assert dict(bits.dtypes)["id_bits"] == "bigint"  # 8 bytes, however few ids of a block a group has
    distinct_counts(bits, ["day"], "n").explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan  # sorted groups of binary bitmaps don't spill
    assert _rows(distinct_counts(bits, ["day"], "n")) == _rows(df.groupBy("day").agg(F.countDistinct("id").alias("n")))


def _views(star):
    return {"vw_daily_revenue": revenue.daily_revenue(star), "vw_revenue_by_channel": revenue.revenue_by_channel(star),
            "vw_revenue_by_category": products.revenue_by_category(star), "vw_category_margin_monthly": products.category_margin_monthly(star)}


def test_batches_give_the_views_of_a_rebuild(spark, tmp_path):
    whole = driver_star(spark, SMOKE)
    store = SummaryStore(spark, str(tmp_path / "store"))
    assert store.version() == 0 and store.read() == {}
    periods = [whole.in_year(1995), whole.in_year(1996)]
    for k, part in enumerate(periods):
        assert store.add(part, f"batch-{k}")
    names = store.register(whole)
    some = whole.between(dt.date(1995, 1, 1), dt.date(1996, 12, 31))
    for name, view in _views(some).items():
        assert _rows(spark.table(name)) == _rows(view), name
    rest = whole.between(dt.date(1997, 1, 1), dt.date(2030, 12, 31))
    assert store.add(rest, "rest") and not store.add(rest, "rest") and not store.add(periods[0], "batch-0")
    assert store.version() == 3
    (tmp_path / "store" / "v-00000004-unfinished").mkdir()  # a batch that failed half way
    assert store.version() == 3
    store.register(whole)
    for name, view in _views(whole).items():
        assert name in names and _rows(spark.table(name)) == _rows(view), name


def test_summaries_follow_product_costs(spark, tmp_path):
    day = dt.date(2020, 5, 1)
    star = make_star(spark, [customer(1)], [product(1, cost=2.0)], [order(1, 1, day, 10)], [item(1, 1, 1, 3, 12)])
    store = SummaryStore(spark, str(tmp_path))
    store.add(star, "a")
    dearer = make_star(spark, [customer(1)], [product(1, cost=3.0)], [order(1, 1, day, 10)], [item(1, 1, 1, 3, 12)])
    store.register(dearer)
    assert _rows(spark.table("vw_category_margin_monthly")) == _rows(products.category_margin_monthly(dearer))


def _skewed(spark):
    rows = [(1 if i % 3 == 0 else 2 + i % 997, i) for i in range(30_000)] + [(None, -1), (5000, -2)]
    left = spark.createDataFrame(rows, "k long, v long").repartition(4)
    right = spark.createDataFrame([(k, f"r{k}") for k in range(1, 900)] + [(1, "again"), (None, "n")], "k long, w string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left, right = _skewed(spark)
    got = salted_join(left, right, "k", how, support=0.01, salts=16)
    want = left.join(right, "k", how)
    assert got.columns == want.columns and _rows(got) == _rows(want)


def test_only_heavy_keys_are_salted_and_their_rows_spread(spark):
    left, right = _skewed(spark)
    heavy = left.limit(1).select(heavy_keys(left, "k", 0.05).alias("h")).first().h
    assert 1 in heavy and len(heavy) <= 20
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        plain, salted = sizes(left.join(right, "k")), sizes(salted_join(left, right, "k", support=0.05, salts=64))
        median = lambda s: s[len(s) // 2]
        assert plain[-1] > 3 * median(plain) and salted[-1] <= 3 * median(salted) and sum(plain) == sum(salted)
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def test_joins_that_would_repeat_right_rows_are_refused(spark):
    left, right = _skewed(spark)
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "full")
