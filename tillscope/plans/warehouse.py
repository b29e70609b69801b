"""Warehouse load and audit steps as queries: L2, L9, L12, L13, C1–C5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import money
from tillscope.operators.audit import apply_defaults, audit_star
from tillscope.operators.finance import order_financials as _order_financials
from tillscope.operators.maintenance import active_products, attach_date_key, cascade_delete, insert_new
from tillscope.operators.pivot import sorted_values
from tillscope.operators.topk import top_k
from tillscope.sources.dims import calendar_for
from tillscope.sources.star import Star


def star_audit(star: Star) -> DataFrame:
    """Violation counts of every declared constraint of the six tables."""
    return audit_star(star)


def order_financials(star: Star, tax_rate: str = "0.08") -> DataFrame:
    """Order headers recomputed from their lines (shipping taken from the header)."""
    o = star.orders.select("order_id", "order_shipping")
    f = _order_financials(o, star.items, tax_rate)
    return f.select("order_id", *[money(c).alias(c) for c in
                                  ("order_subtotal", "order_discount", "order_tax", "order_shipping", "order_total")])


def order_calendar(star: Star) -> DataFrame:
    """L2: the calendar dimension over the span of the order dates."""
    return calendar_for(star.orders, "created_at")


def sellable_products(star: Star) -> DataFrame:
    """Active products with their list price."""
    return active_products(star.product).select("product_id", money("list_price").alias("list_price"))


def lines_after_cancel_purge(star: Star) -> DataFrame:
    """Order lines left after deleting the cancelled orders (FK ON DELETE CASCADE)."""
    doomed = star.orders_with_status("Cancelled").select("order_id")
    if star.items_without:  # a source that numbers its lines drops the rows first
        items = star.items_without(doomed)
    else:
        _, items = cascade_delete(star.orders, star.items, doomed)
    return items.select(F.col("order_item_id").cast("string").alias("order_item_id"), "order_id", "product_id", "quantity", money("line_total").alias("line_total"))


def calendar_reseed(star: Star) -> DataFrame:
    """L4: loading the calendar seed a second time adds nothing (conflicts on either unique key)."""
    cal = order_calendar(star)
    return insert_new(cal, order_calendar(star), [["date_id"], ["date_actual"]])


def calendar_merge(star: Star) -> DataFrame:
    """L4 on conflicting data: the calendar's odd months are stored, a seed of the days 1 to 20 of all months comes in twice."""
    cal = order_calendar(star)
    seed = cal.where("day <= 20").withColumn("week_of_year", F.lit(0))
    return insert_new(cal.where("month % 2 = 1"), seed.unionByName(seed), [["date_id"], ["date_actual"]])


def broken_orders(star: Star) -> DataFrame:
    """Order headers with violations of every kind, by the order's id (money as delivered: text)."""
    every = lambda n: F.col("order_id") % n == 0
    o = star.orders
    return o.select(
        "order_id",
        F.when(every(7), F.lit("ORD-DUP")).otherwise(F.col("order_number")).alias("order_number"),
        F.when(every(11), -F.col("customer_id")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(every(13), F.lit(19000101)).otherwise(F.col("order_date_id")).alias("order_date_id"),
        F.when(every(17), F.lit(99)).otherwise(F.col("channel_id")).alias("channel_id"),
        F.when(every(19), F.lit(None)).when(every(23), F.repeat(F.lit("x"), 60)).otherwise(F.col("order_status")).alias("order_status"),
        "order_subtotal", "order_tax", "order_shipping", "order_discount",
        F.when(every(29), F.lit("99999999999.99")).otherwise(F.col("order_total").cast("string")).alias("order_total"),
        "created_at")


def broken_order_audit(star: Star) -> DataFrame:
    """C1–C5 on order headers with known violations."""
    return audit_star(star.with_tables(orders=broken_orders(star)), ["fact_order"])


def order_defaults(star: Star) -> DataFrame:
    """Headers that arrive without tax or discount get the declared defaults."""
    gaps = star.orders.select(
        "order_id", F.when(F.col("order_id") % 5 != 0, F.col("order_tax")).alias("order_tax"),
        F.when(F.col("order_id") % 3 != 0, F.col("order_discount")).alias("order_discount"))
    filled = apply_defaults(gaps, "fact_order")
    return filled.select("order_id", money("order_tax").alias("order_tax"), money("order_discount").alias("order_discount"))


def last_calendar_days(star: Star, k: int = 5) -> DataFrame:
    """The last k days of the calendar, in order (a tail: the top k from the other end)."""
    tail = top_k(star.date.select("date_id", "date_actual"), [F.col("date_id").desc()], k, tie=[])
    return tail.orderBy("date_id")


def calendar_years(star: Star) -> DataFrame:
    """The distinct years of the calendar, sorted."""
    return sorted_values(star.date, "year")


def order_date_keys(star: Star) -> DataFrame:
    """Each order's calendar key looked up by its creation date (unknown dates raise)."""
    o = star.orders.select("order_id", "created_at")
    return attach_date_key(o, star.date, "created_at").select("order_id", "date_id")
