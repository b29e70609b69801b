"""A customer holding a third of all orders, and a basket holding many items: results stay exact."""

import datetime as dt

from pyspark.sql import functions as F

from star_tables import customer, item, make_star, order, product
from tillscope.plans import basket, cohorts, customers


def test_hot_customer_and_hot_basket(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=3 * i) for i in range(300)]
    orders, items = [], []
    for i, day in enumerate(days):
        cid = 1 if i % 3 == 0 else 2 + i % 7          # customer 1 holds a third of the orders
        orders.append(order(1000 + i, cid, day, 10 + i % 5))
        items.append(item(10 * i, 1000 + i, 1 + i % 4, 1, 5))
    for p in range(20, 80):                           # order 1000 becomes one very large basket
        items.append(item(90000 + p, 1000, p, 1, 1))
    prods = [product(p) for p in list(range(1, 5)) + list(range(20, 80))]
    s = make_star(spark, [customer(c) for c in range(1, 9)], prods, orders, items)

    ltv = {r["customer_id"]: r for r in customers.customer_lifetime_value(s).collect()}
    assert ltv[1]["total_orders"] == 100
    assert ltv[1]["total_revenue"] == float(sum(10 + i % 5 for i in range(0, 300, 3)))

    ret = cohorts.cohort_retention(s).where(F.col("cohort_month") == dt.date(2020, 1, 1)).collect()
    sizes = {r["cohort_size"] for r in ret}
    assert len(sizes) == 1 and all(r["active_customers"] <= r["cohort_size"] for r in ret)

    pairs = basket.product_pairs(s, min_orders=1)
    big = pairs.where((F.col("product_id_1") >= 20)).count()
    assert big == 60 * 59 // 2                        # every pair inside the big basket, once
