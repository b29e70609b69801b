"""Cross-query invariants on the driver data."""

from pyspark.sql import functions as F

from star_tables import SMOKE
from tillscope.plans import basket, customers, revenue, segments
from tillscope.sources.driver import driver_star


def test_revenue_totals_agree(spark):
    s = driver_star(spark, SMOKE)
    daily = revenue.daily_revenue(s).agg(F.sum("total_revenue")).collect()[0][0]
    monthly = revenue.monthly_revenue(s).agg(F.sum("total_revenue")).collect()[0][0]
    kpi = revenue.kpis(s).collect()[0]["total_revenue"]
    assert abs(daily - kpi) < 1e-6 * kpi and abs(monthly - kpi) < 1e-6 * kpi


def test_pair_support_bounded_by_items(spark):
    s = driver_star(spark, SMOKE)
    r = basket.association_rules(s, min_orders=2)
    bad = r.where((F.col("confidence_1_to_2") > 1) | (F.col("confidence_2_to_1") > 1) | (F.col("support") > 1))
    assert r.count() > 0 and bad.count() == 0


def test_ltv_quartiles_balanced(spark):
    s = driver_star(spark, SMOKE)
    sizes = [r["count"] for r in customers.ltv_segments(s).groupBy("revenue_quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_kmeans_clusters_cover_all_customers(spark):
    s = driver_star(spark, SMOKE)
    n = customers.rfm_features(s).count()
    sizes = segments.cluster_sizes(s, n_init=2).collect()
    assert sum(r["customers"] for r in sizes) == n
    assert sorted(r["cluster"] for r in sizes) == [0, 1, 2, 3]
    summ = segments.cluster_summary(s, n_init=2).collect()
    monetary = [r["avg_monetary"] for r in summ]
    assert monetary == sorted(monetary, reverse=True)


def test_pairs_agree_with_fpgrowth(spark):
    """Cross-check of the pair counts with Spark ML's FP-growth frequent 2-itemsets."""
    from pyspark.ml.fpm import FPGrowth

    s = driver_star(spark, SMOKE)
    b = basket.baskets(s)
    n_baskets = b.select("order_id").distinct().count()
    items = b.groupBy("order_id").agg(F.collect_set("product_id").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=2 / n_baskets - 1e-12, minConfidence=0.0).fit(items)
    fp = {(min(r["items"]), max(r["items"])): r["freq"]
          for r in model.freqItemsets.where(F.size("items") == 2).collect()}
    ours = {(r["product_id_1"], r["product_id_2"]): r["cooccurrence_orders"]
            for r in basket.product_pairs(s, min_orders=2).collect()}
    assert ours and ours == fp


def test_distributed_tiles_equal_window_tiles(spark):
    s = driver_star(spark, SMOKE)
    key = ["customer_id", "recency_score", "frequency_score", "monetary_score", "rfm_score"]
    big = sorted(tuple(r) for r in customers.rfm_scores(s).select(*key).collect())
    small = sorted(tuple(r) for r in customers.rfm_scores(s, small=True).select(*key).collect())
    assert big == small
    q = ["customer_id", "revenue_quartile"]
    assert sorted(tuple(r) for r in customers.ltv_segments(s).select(*q).collect()) == \
        sorted(tuple(r) for r in customers.ltv_segments(s, small=True).select(*q).collect())


def test_kmeans_inertia_close_to_brute_force(spark):
    """Our best-of-n Spark k-means reaches (about) the inertia of a plain numpy Lloyd search."""
    import numpy as np

    s = driver_star(spark, SMOKE)
    z = segments.standardized_features(s, digits=None).orderBy("customer_id").collect()
    x = np.array([[r["recency_days_z"], r["frequency_z"], r["monetary_value_z"]] for r in z])
    seg = {r["customer_id"]: r["cluster"] for r in segments.kmeans_segments(s, n_init=4).collect()}
    labels = np.array([seg[r["customer_id"]] for r in z])
    ours = sum(((x[labels == c] - x[labels == c].mean(axis=0)) ** 2).sum() for c in set(labels))

    rng = np.random.default_rng(0)
    best = np.inf
    for _ in range(20):
        centers = x[rng.choice(len(x), 4, replace=False)]
        for _ in range(100):
            lab = ((x[:, None, :] - centers[None]) ** 2).sum(-1).argmin(1)
            new = np.array([x[lab == c].mean(0) if (lab == c).any() else centers[c] for c in range(4)])
            if np.allclose(new, centers):
                break
            centers = new
        best = min(best, ((x - centers[lab]) ** 2).sum())
    assert ours <= best * 1.10


def test_status_predicates_reach_the_scan(spark):
    s = driver_star(spark, SMOKE)
    for status, code in (("Completed", "F"), ("Cancelled", "P")):
        df = s.orders_with_status(status).select("order_id")
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert f"EqualTo(o_orderstatus,{code})" in plan
        assert df.count() == s.orders.where(F.col("order_status") == status).count()
    assert s.orders_with_status("Unknown").count() == 0


def test_unused_geography_is_not_read(spark):
    from tillscope.plans import cohorts

    s = driver_star(spark, SMOKE)
    for plan, read in ((customers.rfm_base, False), (customers.segment_order_size, False), (cohorts.cohort_retention, False),
                       (customers.customer_lifetime_value, True)):
        text = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan(s)._jdf.queryExecution(), "formatted")
        assert ("nation.parquet" in text) == ("region.parquet" in text) == read, plan.__name__
