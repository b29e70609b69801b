"""RFM standardisation and k-means segments: M1–M5.

Features are the per-customer RFM base (V5).  Standardisation (M1) reads the
global means and population standard deviations as scalar subqueries, which
Catalyst merges into one aggregate pass.

The segments are a k-means over the standard scores in steps of 1 / ``STEPS``
(``operators.kmeans``: ten restarts in one pass a round, exact sums, start
centres in hash order).  Means and deviations come from exact sums, the rounds
read a narrow table that is written once and deleted when the fit is done, and
the labelled result is a plan over the features and the best restart's centres.
Clusters are numbered 0..k-1 by descending mean monetary value, since raw
numbers are arbitrary.
"""

from __future__ import annotations

from fractions import Fraction
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import avg_money
from tillscope.operators import kmeans
from tillscope.plans.customers import rfm_features, rfm_features_exact
from tillscope.plans.shared import per_star, scratch
from tillscope.sources.star import Star

FEATURES = ["recency_days", "frequency", "monetary_value"]

#: Steps of a standard score in the segments' whole-number coordinates.  Squared distances stay within 64 bits
#: for scores up to 80,000, which no value among fewer than 6 billion customers can exceed.
STEPS = 10_000


def standardize(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """z = (x − mean) / population std; a constant column gives 0."""
    # one global aggregate per statistic, as scalar subqueries over the same
    # input; Catalyst merges them into a single aggregate pass
    out = df
    for c in cols:
        x = F.col(c).cast("double")
        mean = df.agg(F.avg(x)).scalar()
        std = df.agg(F.stddev_pop(x)).scalar()
        out = out.withColumn(f"{c}{suffix}", F.when(std > 0, (x - mean) / std).otherwise(0.0))
    return out


def standardized_features(star: Star, digits: int | None = 6) -> DataFrame:
    """M1: customer_id and the z-scores of recency, frequency and monetary (rounded for display)."""
    z = standardize(rfm_features(star), FEATURES)
    names = [f"{c}_z" for c in FEATURES]
    cols = [(F.round(F.col(n), digits) if digits is not None else F.col(n)).alias(n) for n in names]
    return z.select("customer_id", *cols)


def kmeans_segments(star: Star, **kw) -> DataFrame:
    """M2: customer_id, the three features and a cluster label 0..k-1 (0 = highest mean monetary)."""
    return _segments(star, **kw).drop("_total")


def _segments(star: Star, **kw) -> DataFrame:
    """Fitted once for a sharing star (``plans.shared``), whose other segment queries read the labelled table."""
    return per_star(star, ("segments", *sorted(kw.items())), lambda: _fit_segments(star, **kw))


def _steps(x: str, count: int, total: int, squares: int) -> Column:
    """A whole-number feature's standard score in steps, from exact sums; a constant feature gives 0."""
    spread = count * squares - total * total
    if not spread:
        return F.lit(0).cast("long")
    mean, std = float(Fraction(total, count)), sqrt(float(spread)) / count
    return F.floor((F.col(x).cast("double") - F.lit(mean)) / F.lit(std) * F.lit(float(STEPS)) + F.lit(0.5)).cast("long")


def _fit_segments(star: Star, k: int = 4, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4) -> DataFrame:
    base = rfm_features_exact(star)
    whole = ["recency_days", "frequency", "_cents"]
    cents = (F.col("_total") * 100).cast("long").alias("_cents")
    with scratch(base.select("customer_id", "recency_days", "frequency", cents)) as rows:
        exact = lambda x: F.col(x).cast("decimal(19,0)")
        sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(exact(x)).alias(f"s_{x}") for x in whole],
                        *[F.sum(exact(x) * exact(x)).alias(f"q_{x}") for x in whole]).first()
        steps = [_steps(x, sums.n, int(sums[f"s_{x}"]), int(sums[f"q_{x}"])).alias(f"_z{i}") if sums.n else F.lit(0).alias(f"_z{i}")
                 for i, x in enumerate(whole)]
        dims = [f"_z{i}" for i in range(len(whole))]
        fits = kmeans.fit(rows.select("customer_id", "_cents", *steps), "customer_id", dims, "_cents", k, n_init, max_iter,
                          int(tol * STEPS * STEPS))
    labelled = base.withColumn("_cents", cents)
    if not fits:
        return labelled.select("customer_id", *FEATURES, F.lit(0).alias("cluster"), "_total")
    best = fits[0]
    used = [c for c in range(k) if best.sizes[c]]
    by_money = sorted(used, key=lambda c: (-Fraction(int(best.amounts[c]), best.sizes[c]), c))
    number = {c: i for i, c in enumerate(by_money)}
    names = F.array(*[F.lit(number.get(c, -1)) for c in range(k)])
    raw = kmeans.nearest(dims, best.centres)
    return labelled.select("*", *steps).select("customer_id", *FEATURES, F.get(names, raw).alias("cluster"), "_total")


def cluster_sizes(star: Star, **kw) -> DataFrame:
    """M3: customers per cluster, largest first."""
    s = kmeans_segments(star, **kw)
    return s.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers")).orderBy(
        F.col("customers").desc(), "cluster")


def cluster_summary(star: Star, **kw) -> DataFrame:
    """M4: mean recency, frequency, monetary and size per cluster, by mean monetary descending."""
    g = _segments(star, **kw).groupBy("cluster").agg(
        F.avg(F.col("recency_days").cast("double")).alias("avg_recency"),
        F.avg(F.col("frequency").cast("double")).alias("avg_frequency"),
        F.sum("_total").alias("_total"),
        F.count("customer_id").alias("customers"),
    )
    return g.select("cluster", "avg_recency", "avg_frequency", avg_money("_total", "customers").alias("avg_monetary"),
                    "customers").orderBy(F.col("avg_monetary").desc(), "cluster")


def cluster_points(star: Star, **kw) -> DataFrame:
    """M5: per-cluster (frequency, monetary) points."""
    s = kmeans_segments(star, **kw)
    # the features in the key keep a cluster from being one task's range
    return s.select("cluster", "frequency", "monetary_value").orderBy("cluster", "frequency", "monetary_value")


def cluster_totals(star: Star, **kw) -> DataFrame:
    """What the cluster table must add up to: clusters, customers, orders and revenue (one row)."""
    s = cluster_summary(star, **kw).select("customers", (F.col("avg_frequency") * F.col("customers")).alias("f"),
                                           (F.col("avg_monetary") * F.col("customers")).alias("m"))
    return s.agg(F.count(F.lit(1)).alias("clusters"), F.sum("customers").alias("customers"),
                 F.round(F.sum("f")).cast("long").alias("orders"), F.round(F.sum("m"), 2).alias("revenue"))
