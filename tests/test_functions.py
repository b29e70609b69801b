"""Exact rounding helpers against Python's decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillscope.functions.common import round_avg_money, round_ratio, weekday_name, year_month_label


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-10**9, 10**9), st.integers(0, 4)),
                min_size=50, max_size=200))
def test_round_ratio_matches_decimal(spark, rows):
    rows = rows + [(5, 10, 0), (-5, 10, 0), (25, 1000, 2), (-25, 1000, 2), (1, 3, 4), (2, 3, 4), (7, 0, 2)]
    df = spark.createDataFrame(rows, "n long, d long, k int")
    for k in range(5):
        got = df.where(F.col("k") == k).select("n", "d", round_ratio("n", "d", k).alias("r")).collect()
        for r in got:
            # exact decimal division is precise to 28 digits, enough for these magnitudes
            want = None if r["d"] == 0 else float(
                (Decimal(r["n"]) / Decimal(r["d"])).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP))
            assert r["r"] == want, (r["n"], r["d"], k, r["r"], want)


def test_round_avg_money_half_cent(spark):
    # 2493163.80 / 8 = 311645.475 exactly: half away from zero gives .48
    df = spark.createDataFrame([(Decimal("2493163.80"), 8)], "s decimal(22,2), n long")
    assert df.select(round_avg_money("s", "n").alias("a")).collect()[0]["a"] == 311645.48


def test_labels(spark):
    df = spark.createDataFrame([(2021, 3, 1), (1999, 12, 7), (2000, 1, 8)], "y int, m int, d int")
    got = [tuple(r) for r in df.select(year_month_label("y", "m"), weekday_name("d")).collect()]
    assert got == [("2021-03", "Monday"), ("1999-12", "Sunday"), ("2000-01", None)]
