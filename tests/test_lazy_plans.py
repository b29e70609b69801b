"""Building a query runs no Spark job, and registered views follow their tables."""

import datetime as dt

from star_tables import SMOKE, customer, item, make_star, order, product
from tillscope.registry import PLANS
from tillscope.sources.driver import driver_star
from tillscope.sources.star import load_star, register_views, write_star

#: k-means finds its centres in rounds when the plan is built.
ITERATIVE = {"kmeans_segments", "cluster_sizes", "cluster_summary", "cluster_points", "cluster_totals"}
#: Their columns are values of the data.
PIVOTS = {"cohort_matrix", "seasonality_matrix"}


def jobs_of(spark, group, act):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        act()
    finally:
        sc._jsc.clearJobGroup()
    return list(sc.statusTracker().getJobIdsForGroup(group))


def test_building_a_query_runs_no_job(spark):
    driver_star(spark, SMOKE)  # schemas are read once in a session
    assert len(jobs_of(spark, "lazy-probe", lambda: spark.range(3).count())) > 0
    for name in sorted(set(PLANS) - ITERATIVE - PIVOTS):
        assert jobs_of(spark, f"lazy-{name}", lambda: PLANS[name](driver_star(spark, SMOKE))) == [], name  # noqa: B023


VIEWS = ["vw_daily_revenue", "vw_revenue_by_channel", "vw_revenue_by_category", "vw_customer_lifetime_value", "vw_customer_rfm_base",
         "vw_customer_rfm_scores", "vw_customer_ltv_segments", "vw_cohort_retention", "vw_product_pairs",
         "vw_category_margin_monthly", "vw_product_association_rules"]


def _star(spark, days):
    orders = [order(i, 1 + i % 3, dt.date(2020, 1, 1) + dt.timedelta(days=11 * i), 10 + i) for i in days]
    items = [item(10 * i + p, i, p, 1, 5) for i in days for p in (1, 2, 3)]
    return make_star(spark, [customer(c) for c in (1, 2, 3)], [product(p) for p in (1, 2, 3)], orders, items)


def test_views_show_appended_rows(spark, tmp_path):
    path = str(tmp_path)
    write_star(_star(spark, range(1, 8)), path)
    register_views(spark, load_star(spark, path))
    rows = lambda: {name: sorted(map(str, spark.table(name).collect())) for name in VIEWS}
    before = rows()
    more = _star(spark, range(8, 20))
    write_star(more.with_tables(customer=more.customer.limit(0), product=more.product.limit(0), date=more.date.limit(0),
                                channel=more.channel.limit(0)), path, mode="append")
    for name in VIEWS:
        spark.catalog.refreshTable(name)
    after = rows()
    assert all(after[name] != before[name] for name in VIEWS)
    register_views(spark, _star(spark, range(1, 20)))
    assert after == rows()
