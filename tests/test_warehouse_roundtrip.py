"""The driver star written as a partitioned warehouse and read back answers every view the same."""

import datetime as dt
import tempfile

from star_tables import SMOKE, customer, item, make_star, order, product
from tillscope.plans import basket, cohorts, customers, products, revenue
from tillscope.sources.driver import driver_star
from tillscope.sources.star import load_star, write_star


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_written_star_gives_same_views(spark):
    src = driver_star(spark, SMOKE)
    path = tempfile.mkdtemp(prefix="tillscope-wh-", dir="/tmp")
    write_star(src, path)
    back = load_star(spark, path)
    for plan in (revenue.daily_revenue, revenue.revenue_by_channel, products.revenue_by_category,
                 customers.customer_lifetime_value, customers.rfm_scores, customers.ltv_segments,
                 cohorts.cohort_retention, products.category_margin_monthly):
        assert _rows(plan(back)) == _rows(plan(src)), plan.__name__
    assert _rows(basket.association_rules(back, min_orders=2)) == _rows(basket.association_rules(src, min_orders=2))


def _explained(df):
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_periods_read_their_partitions_only(spark, tmp_path):
    src = driver_star(spark, SMOKE)
    write_star(src, str(tmp_path))
    back = load_star(spark, str(tmp_path))
    months = spark.read.parquet(f"{tmp_path}/fact_order").select("p_year", "p_month").distinct().count()
    periods = {"year": lambda s: s.in_year(1995), "month": lambda s: s.in_year(1995, 3),
               "days": lambda s: s.between(dt.date(1996, 2, 10), dt.date(1996, 5, 20)),
               "none": lambda s: s.between(dt.date(2050, 1, 1), dt.date(2050, 2, 1))}
    for name, of in periods.items():
        part, plain = of(back), of(src)
        assert [f.dataType for f in part.orders.schema] == [f.dataType for f in back.orders.schema]
        assert part.items.columns == back.items.columns
        for df in (part.orders, part.items):
            plan = _explained(df)
            assert "PartitionFilters: [isnotnull(p_year" in plan and "p_month" in plan, name
        files = len({f for f in part.orders.inputFiles()} & set(back.orders.inputFiles()))
        read = spark.read.parquet(f"{tmp_path}/fact_order").where(part_months(name)).select("p_year", "p_month").distinct().count()
        assert read < months and files
        for plan in (revenue.daily_revenue, revenue.revenue_by_channel, products.revenue_by_category):
            assert _rows(plan(part)) == _rows(plan(plain)), (name, plan.__name__)
        assert part.items.count() == plain.items.count() and part.orders.count() == plain.orders.count()
        assert (part.orders.count() > 0) == (name != "none")
    narrowed = back.in_year(1995).between(dt.date(1994, 6, 1), dt.date(1995, 1, 31))
    assert _rows(revenue.daily_revenue(narrowed)) == _rows(revenue.daily_revenue(src.in_year(1995, 1)))


def part_months(name):
    return {"year": "p_year = 1995", "month": "p_year = 1995 and p_month = 3",
            "days": "p_year = 1996 and p_month between 2 and 5", "none": "p_year = 2050"}[name]


def test_period_of_the_driver_tables_reaches_the_scan(spark):
    s = driver_star(spark, SMOKE).between(dt.date(1996, 2, 10), dt.date(1996, 5, 20))
    plan = _explained(s.completed_orders().select("order_id"))
    assert "GreaterThanOrEqual(o_orderdate,1996-02-10" in plan and "LessThan(o_orderdate,1996-05-21" in plan
    assert "EqualTo(o_orderstatus,F)" in plan


def test_lines_without_a_header_are_kept_by_a_full_load(spark, tmp_path):
    day = dt.date(2020, 5, 1)
    s = make_star(spark, [customer(1)], [product(1)], [order(1, 1, day, 10)], [item(1, 1, 1, 1, 10), item(2, 99, 1, 1, 10)])
    write_star(s, str(tmp_path))
    back = load_star(spark, str(tmp_path))
    assert back.items.count() == 2 and back.in_year(2020).items.count() == 1
    assert s.in_year(2020, 5).items.count() == 1 and s.in_year(2021).orders.count() == 0
