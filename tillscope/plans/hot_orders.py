"""J2 where one order holds a third of all lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import money
from tillscope.operators.skew import salted_join
from tillscope.sources.star import Star


def one_hot_order(star: Star) -> DataFrame:
    """The order lines, every third of them (by product) moved to the order with the smallest number."""
    hot = star.orders.agg(F.min("order_id")).scalar()
    moved = F.when(F.col("product_id") % 3 == 0, F.col("_hot")).otherwise(F.col("order_id"))
    return star.items.select("order_id", "product_id", "quantity", "line_total").withColumn("_hot", hot).withColumn("order_id", moved).drop("_hot")


def hot_order_revenue(star: Star) -> DataFrame:
    """Line revenue by status and channel with one hot order, joined by measured key frequencies."""
    lines = one_hot_order(star)
    orders = star.orders.select("order_id", "order_status", "channel_id")
    joined = salted_join(lines, orders, "order_id")
    return joined.groupBy("order_status", "channel_id").agg(
        money(F.sum("line_total")).alias("line_revenue"), F.sum("quantity").cast("long").alias("units"), F.count(F.lit(1)).alias("lines"))
