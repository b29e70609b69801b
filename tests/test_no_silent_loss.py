"""Inputs that once lost rows silently: they fail now, or keep every row."""

import datetime as dt

import pytest

from star_tables import SMOKE, customer, item, make_star, order, product
from tillscope.operators.audit import check_predicate
from tillscope.operators.maintenance import insert_new
from tillscope.plans import customers, revenue
from tillscope.plans.shared import sharing
from tillscope.sources.driver import calendar_span, driver_star, map_items
from tillscope.sources.star import bucket_count, load_star


def test_order_outside_the_calendar_fails(spark):
    orders = [order(1, 1, dt.date(2020, 5, 1), 10), order(2, 1, dt.date(2030, 5, 1), 90)]
    star = make_star(spark, [customer(1)], [product(1)], orders, [item(1, 1, 1, 1, 10)])
    with pytest.raises(Exception, match="without a calendar row: 20300501"):
        revenue.monthly_revenue(star).collect()
    assert revenue.kpis(star).collect()[0].total_orders == 2


def test_driver_calendar_follows_the_order_dates(spark):
    rows = spark.createDataFrame([(dt.datetime(1993, 3, 1),), (dt.datetime(2031, 2, 1),)], "o_orderdate timestamp")
    assert calendar_span(rows) == (dt.date(1993, 1, 1), dt.date(2031, 12, 31))
    assert calendar_span(rows.limit(0))[0].month == 1


def test_line_keys_of_long_orders_do_not_meet(spark):
    lines = spark.read.parquet(f"{SMOKE}/lineitem.parquet").limit(1).collect()[0].asDict()
    many = [lines | {"l_orderkey": 1, "l_linenumber": k % 3} for k in range(150)] + [lines | {"l_orderkey": 2}]
    schema = spark.read.parquet(f"{SMOKE}/lineitem.parquet").schema
    keyed = map_items(spark.createDataFrame([tuple(r[f.name] for f in schema) for r in many], schema))
    assert keyed.select("order_item_id").distinct().count() == 151


def test_missing_required_column_raises(spark, tmp_path):
    star = driver_star(spark, SMOKE)
    for name, df in star.tables().items():
        df = df.withColumnRenamed("order_status", "status") if name == "fact_order" else df
        df.limit(5).write.parquet(f"{tmp_path}/{name}")
    with pytest.raises(ValueError, match="fact_order: required columns are missing: order_status"):
        load_star(spark, str(tmp_path))


def test_insert_conflicts_with_stored_rows_first(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a long, b string")
    out = insert_new(frame([(9, "x")]), frame([(1, "x"), (1, "y")]), [["a"], ["b"]]).collect()
    assert {tuple(r) for r in out} == {(9, "x"), (1, "y")}
    out = insert_new(frame([(9, "x")]), frame([(None, "p"), (None, "q"), (9, "r")]), ["a"]).collect()
    assert {tuple(r) for r in out} == {(9, "x"), (None, "p"), (None, "q")}
    twice = insert_new(frame([]), frame([(1, "z"), (1, "k"), (2, None)]), ["a"]).collect()
    assert {tuple(r) for r in twice} == {(1, "k"), (2, None)}


def test_predicates_may_hold_quotes(spark):
    df = spark.createDataFrame([("Completed",), ("x",), (None,)], "order_status string")
    assert check_predicate(df, "t", "known", "order_status IN ('Completed')").collect()[0].violations == 1


def test_sharing_writes_once_and_releases(spark):
    star = driver_star(spark, SMOKE)
    assert star.shared is None
    with sharing(star) as kept:
        first = customers.customer_lifetime_value(kept).count()
        assert len(kept.shared) == 1 and customers.rfm_base(kept).count() == first and len(kept.shared) == 1
    assert kept.shared == {} and customers.customer_lifetime_value(star).count() == first


def test_bucket_count_follows_the_bytes():
    assert bucket_count(0) == 1 and bucket_count(100 * 2**40) == 100 * 2**40 // (256 * 2**20)
