"""Hand-made edge rows (FIXTURES §5) through the named plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from star_tables import customer, item, make_star, order, product
from tillscope.operators.audit import audit_star
from tillscope.operators.maintenance import attach_date_key, cascade_delete, insert_new
from tillscope.plans import basket, cohorts, customers, forecast, products, revenue
from tillscope.sources.dims import build_dim_channel, build_dim_date

d = dt.date


@pytest.fixture(scope="module")
def star(spark):
    custs = [customer(1, "VIP"), customer(2), customer(3, "Wholesale"), customer(4)]
    prods = [product(10, "Home", "Decor", 1.0), product(11, "Toys", "Board Games", 2.0),
             product(12, "Home", "Kitchen", None), product(13, None, None, 1.0)]
    orders = [
        order(100, 1, d(2020, 1, 5), 10, channel_id=None),     # NULL channel
        order(101, 1, d(2021, 1, 1), 20),                      # ISO week 53 of 2020, calendar year 2021
        order(102, 2, d(2021, 3, 3), 30),
        order(103, 3, d(2021, 3, 4), 5, status="Cancelled"),  # customer 3 only cancelled
        order(104, 2, d(2021, 4, 4), 0),                       # completed order without lines, zero total
        order(105, 4, d(2022, 2, 2), 7),
    ]
    items = [
        item(1, 100, 10, 1, 4), item(2, 100, 11, 1, 6),
        item(3, 101, 10, 2, 8), item(4, 101, 10, 1, 4), item(5, 101, 11, 1, 8),   # product 10 twice in 101
        item(6, 102, 10, 1, 10), item(7, 102, 11, 2, 10), item(8, 102, 12, 1, 10),
        item(9, 103, 10, 1, 5),
        item(10, 105, 13, 1, 0),                                                   # zero revenue, NULL category
    ]
    return make_star(spark, custs, prods, orders, items)


def test_null_channel_is_a_group(star):
    rows = revenue.revenue_by_channel(star).collect()
    assert any(r["channel_name"] is None and r["total_revenue"] == 10.0 for r in rows)


def test_iso_week_53(star):
    r = revenue.daily_revenue(star).where(F.col("order_date") == d(2021, 1, 1)).collect()[0]
    assert (r["year"], r["week_of_year"]) == (2021, 53)


def test_yoy_missing_and_zero_prior(star):
    rows = {(r["year"], r["month"]): r for r in revenue.yoy_growth(star).collect()}
    assert rows[(2021, 1)]["prev_year_revenue"] == 10.0 and rows[(2021, 1)]["yoy_growth_percent"] == 100.0
    assert rows[(2021, 3)]["prev_year_revenue"] is None and rows[(2021, 3)]["yoy_growth_percent"] is None


def test_cancelled_only_customer_absent(star):
    ids = {r["customer_id"] for r in customers.customer_lifetime_value(star).collect()}
    assert ids == {1, 2, 4}
    assert {r["customer_id"] for r in customers.rfm_base(star).collect()} == {1, 2, 4}


def test_more_tiles_than_customers(star):
    s = customers.rfm_scores(star).collect()
    assert sorted(r["recency_score"] for r in s) == [1, 2, 3]
    small = customers.rfm_scores(star, small=True).collect()
    assert sorted((r["customer_id"], r["rfm_score"]) for r in s) == sorted((r["customer_id"], r["rfm_score"]) for r in small)


def test_duplicate_product_counts_once_in_pairs(star):
    pairs = {(r["product_id_1"], r["product_id_2"]): r["cooccurrence_orders"]
             for r in basket.product_pairs(star, min_orders=1).collect()}
    assert pairs[(10, 11)] == 3  # orders 100, 101, 102 (101 has product 10 twice)


def test_rules_denominator_includes_orders_without_lines(star):
    r = [x for x in basket.association_rules(star, min_orders=1).collect()
         if (x["product_id_1"], x["product_id_2"]) == (10, 11)][0]
    assert r["support"] == 3 / 5  # 5 completed orders, one of them without lines


def test_zero_revenue_margin_is_zero_and_null_cost(star):
    m = products.category_margin_monthly(star).collect()
    zero = [r for r in m if r["category"] is None][0]
    assert zero["revenue"] == 0.0 and zero["gross_margin_percent"] == 0.0
    kitchen = [r for r in m if r["subcategory"] == "Kitchen"][0]
    assert kitchen["revenue"] == 10.0 and kitchen["total_cost"] is None and kitchen["gross_margin_percent"] is None


def test_null_category_dropped_by_pivot(star):
    cats = [r["category"] for r in products.seasonality_matrix(star).collect()]
    assert None not in cats and sorted(cats) == ["Home", "Toys"]


def test_cohort_month_zero_is_full_retention(star):
    rows = cohorts.cohort_retention(star).where(F.col("months_since_cohort_start") == 0).collect()
    assert rows and all(r["retention_percent"] == 100.0 for r in rows)


def test_two_months_give_null_average_and_forecast(spark):
    s = make_star(spark, [customer(1)], [product(10)],
                  [order(1, 1, d(2020, 1, 1), 5), order(2, 1, d(2020, 2, 1), 7)], [item(1, 1, 10, 1, 5)])
    ma = forecast.monthly_moving_average(s).collect()
    assert [r["ma_3"] for r in ma] == [None, None]
    f = forecast.naive_forecast(s).collect()
    assert [r["date"] for r in f] == [d(2020, m, 1) for m in range(3, 9)]
    assert all(r["forecast_revenue"] is None for r in f)


def test_moving_average_three_months(spark):
    s = make_star(spark, [customer(1)], [product(10)],
                  [order(i, 1, d(2020, i, 1), i * 3) for i in range(1, 5)], [])
    ma = [r["ma_3"] for r in forecast.monthly_moving_average(s).collect()]
    assert ma == [None, None, 6.0, 9.0]


def test_audit_finds_each_broken_rule(spark):
    s = make_star(spark, [customer(1), customer(1)], [product(10)],
                  [order(1, 1, d(2020, 1, 1), 5), order(2, 9, d(2020, 1, 2), 5)],
                  [item(1, 1, 10, 0, 0), item(2, 3, 10, 1, 1)])
    s = s.with_tables(orders=s.orders.withColumn("order_number", F.lit("ORD-1"))
                      .withColumn("order_status", F.when(F.col("order_id") == 2, F.lit(None)).otherwise("Completed")))
    a = {(r["table"], r["rule"], r["columns"]): r["violations"] for r in audit_star(s).collect()}
    assert a[("dim_customer", "primary_key", "customer_id")] == 2
    assert a[("fact_order", "unique", "order_number")] == 2
    assert a[("fact_order", "foreign_key", "customer_id")] == 1
    assert a[("fact_order", "not_null", "order_status")] == 1
    assert a[("fact_order_item", "check:quantity_positive", "quantity > 0")] == 1
    assert a[("fact_order_item", "foreign_key", "order_id")] == 1
    assert a[("fact_order", "foreign_key", "channel_id")] == 0


def test_seed_loaded_twice_is_idempotent(spark):
    ch = build_dim_channel(spark)
    again = insert_new(ch, ch, [["channel_id"], ["channel_name"]])
    assert again.count() == 8
    cal = build_dim_date(spark, d(2020, 1, 1), d(2020, 1, 10))
    more = build_dim_date(spark, d(2020, 1, 5), d(2020, 1, 20))
    assert insert_new(cal, more, ["date_id"]).count() == 20


def test_attach_date_key_and_cascade(spark, star):
    cal = build_dim_date(spark, d(2020, 1, 1), d(2020, 1, 31))
    df = spark.createDataFrame([(d(2020, 1, 2),)], "x date")
    assert attach_date_key(df, cal, "x").collect()[0]["date_id"] == 20200102
    late = spark.createDataFrame([(d(2021, 1, 2),)], "x date")
    with pytest.raises(Exception, match="outside the calendar"):
        attach_date_key(late, cal, "x").collect()
    assert attach_date_key(late, cal, "x", strict=False).collect()[0]["date_id"] is None
    o, i = cascade_delete(star.orders, star.items, star.orders.where(F.col("order_status") == "Cancelled"))
    assert o.count() == 5 and i.where(F.col("order_id") == 103).count() == 0 and i.count() == 9


def test_calendar_2020_leap_year(spark):
    cal = build_dim_date(spark)
    assert cal.count() == 1827
    r = cal.where(F.col("date_actual") == d(2024, 12, 29)).collect()[0]
    assert (r["day_of_week"], r["is_weekend"], r["date_id"]) == (7, True, 20241229)


def test_rfm_best_high_flips_tiles(star):
    low = {r["customer_id"]: r for r in customers.rfm_scores(star, small=True).collect()}
    high = {r["customer_id"]: r for r in customers.rfm_scores(star, best="high", small=True).collect()}
    for cid, r in low.items():
        h = high[cid]
        assert (h["recency_score"], h["frequency_score"], h["monetary_score"]) == \
            (6 - r["recency_score"], 6 - r["frequency_score"], 6 - r["monetary_score"])
        assert h["rfm_code"] == f"{h['recency_score']}{h['frequency_score']}{h['monetary_score']}"


def test_audit_reads_each_table_once_and_shuffles_once(spark, tmp_path):
    from tillscope.sources.schema import RULES
    from tillscope.sources.star import load_star, write_star

    path = str(tmp_path)
    d = dt.date(2020, 1, 5)
    write_star(make_star(spark, [customer(1)], [product(1)], [order(1, 1, d, 10)], [item(1, 1, 1, 1, 10)]), path)
    audit = audit_star(load_star(spark, path))
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(RULES)  # each file scan is one table's
    assert plan.count("Exchange hashpartitioning") == 2  # by key, and the totals by rule
    assert audit.count() == len(audit.select("table", "rule", "columns").distinct().collect())
    assert audit.where("violations > 0").count() == 0


def test_audit_of_composite_keys_and_hot_references(spark, monkeypatch):
    from tillscope.operators import audit as module
    from tillscope.sources.schema import TableRules

    d = dt.date(2020, 1, 5)
    s = make_star(spark, [customer(1)], [product(1)], [order(1, 1, d, 10), order(2, 7, d, 10), order(3, 7, d, 10)],
                  [item(1, 1, 1, 1, 10), item(2, 1, 1, 1, 10), item(3, 9, 1, 1, 10)])
    rules = dict(module.RULES)
    rules["fact_order_item"] = TableRules(
        primary_key=("order_id", "product_id"), unique=(("order_item_id",), ("line_total", "quantity")),
        foreign_keys=(("order_id", "fact_order", "order_id"),))
    monkeypatch.setattr(module, "RULES", rules)
    got = {(r.rule, r.columns): r.violations for r in audit_star(s, ["fact_order_item"]).collect() if r.rule in ("primary_key", "unique", "foreign_key")}
    assert got == {("primary_key", "order_id,product_id"): 2, ("unique", "order_item_id"): 0,
                   ("unique", "line_total,quantity"): 3, ("foreign_key", "order_id"): 1}
    orders = {(r.rule, r.columns): r.violations for r in audit_star(s, ["fact_order"]).collect()}
    assert orders["foreign_key", "customer_id"] == 2


def test_a_header_that_comes_twice_counts_once(spark):
    from tillscope.plans import customers

    d = dt.date(2020, 1, 5)
    twice = order(1, 1, d, 10)
    s = make_star(spark, [customer(1, created=d)], [product(1)], [twice, twice, order(2, 1, d, 30)], [])
    assert customers.customer_lifetime_value(s).first().total_orders == 2
    assert [r.orders for r in customers.signup_cohorts(s).collect()] == [2]
