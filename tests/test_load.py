"""Load, write, views and per-row helpers."""

import datetime as dt
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from star_tables import customer, item, make_star, order, product
from tillscope.operators.audit import apply_defaults
from tillscope.operators.finance import line_financials, order_financials
from tillscope.operators.maintenance import email_of, natural_key, product_name_of
from tillscope.sources.star import drop_views, load_star, register_views, run_query, write_star

d = dt.date


def _star(spark):
    return make_star(spark, [customer(1), customer(2)], [product(10), product(11, "Toys", "Gym", 3.0)],
                     [order(1, 1, d(2020, 1, 5), 10), order(2, 2, d(2020, 2, 5), 20, status="Refunded")],
                     [item(1, 1, 10, 1, 4), item(2, 1, 11, 2, 6), item(3, 2, 10, 1, 20)])


def test_write_then_load_roundtrip(spark):
    path = tempfile.mkdtemp(prefix="tillscope-star-", dir="/tmp")
    s = _star(spark)
    write_star(s, path)
    back = load_star(spark, path)
    for name, df in s.tables().items():
        assert back.table(name).count() == df.count(), name
        shape = lambda sc: [(f.name, f.dataType) for f in sc.fields]  # noqa: E731 (parquet relaxes NOT NULL)
        assert shape(back.table(name).schema) == shape(df.schema), name
    assert back.completed_orders().count() == 1


def test_views_and_parametrised_sql(spark):
    s = _star(spark)
    names = register_views(spark, s)
    assert "vw_customer_rfm_scores" in names and names.index("vw_customer_rfm_base") < names.index(
        "vw_customer_rfm_scores")
    r = run_query(spark, "SELECT SUM(total_revenue) AS t FROM vw_daily_revenue WHERE year = :y", {"y": 2020})
    assert r.collect()[0]["t"] == 10.0
    drop_views(spark, names)


def test_line_and_order_financials(spark):
    items = spark.createDataFrame(
        [(1, 10, 3, Decimal("1.25"), Decimal("0.10")), (1, 11, 1, Decimal("2.00"), None), (2, 10, 1, Decimal("5.00"), Decimal("0"))],
        "order_id long, product_id long, quantity int, unit_price decimal(10,2), unit_discount decimal(10,2)")
    lines = line_financials(items)
    got = {(r["order_id"], r["product_id"]): (r["line_subtotal"], r["line_discount_total"], r["line_total"])
           for r in lines.collect()}
    assert got[(1, 10)] == (Decimal("3.75"), Decimal("0.30"), Decimal("3.45"))
    assert got[(1, 11)] == (Decimal("2.00"), Decimal("0.00"), Decimal("2.00"))
    orders = spark.createDataFrame([(1, Decimal("4.99")), (2, Decimal("0")), (3, Decimal("9.99"))],
                                   "order_id long, order_shipping decimal(12,2)")
    f = {r["order_id"]: r for r in order_financials(orders, lines).collect()}
    assert f[1]["order_subtotal"] == Decimal("5.75") and f[1]["order_discount"] == Decimal("0.30")
    assert f[1]["order_tax"] == Decimal("0.44")  # 8% of 5.45 = 0.436
    assert f[1]["order_total"] == Decimal("5.45") + Decimal("0.44") + Decimal("4.99")
    assert f[3]["order_total"] == Decimal("9.99") and f[3]["order_tax"] == Decimal("0.00")  # no lines


def test_natural_keys(spark):
    df = spark.createDataFrame([(7, "Ann", "Lee", "Shop.COM", "Acme", "Gym", 3)],
                               "id long, f string, l string, dom string, brand string, sub string, n int")
    r = df.select(natural_key("CUST", 5, "id").alias("c"), natural_key("ORD", 7, "id").alias("o"),
                  email_of("f", "l", "dom").alias("e"), product_name_of("brand", "sub", "n").alias("p")).collect()[0]
    assert (r["c"], r["o"], r["e"], r["p"]) == ("CUST-00007", "ORD-0000007", "ann.lee@shop.com", "Acme Gym 3")


def test_defaults(spark):
    s = _star(spark)
    o = s.orders.withColumn("order_tax", F.lit(None).cast("decimal(12,2)"))
    r = apply_defaults(o, "fact_order").collect()
    assert all(x["order_tax"] == Decimal("0.00") for x in r)


def test_cluster_conf_sizes_partitions():
    from tillscope.session import cluster_conf

    small = cluster_conf(10 * 2**20, 16)
    assert small["spark.sql.shuffle.partitions"] == "32"  # at least 2 x cores
    big = cluster_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_bucketed_facts_join_without_shuffle(spark):
    from tillscope.plans import products
    from tillscope.sources.star import load_star_tables, save_star_tables

    s = _star(spark)
    save_star_tables(s, buckets=4, prefix="t_")
    back = load_star_tables(spark, prefix="t_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join strategy
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        lines = products.completed_lines(back)  # without the calendar, which this setting would shuffle too
        lines.collect()
        plan = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(order_id" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    got = sorted(tuple(r) for r in products.revenue_by_category(back).collect())
    want = sorted(tuple(r) for r in products.revenue_by_category(s).collect())
    assert got == want
