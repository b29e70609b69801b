"""Line and order financials (L8, L9) as set operations on the facts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.sources.schema import MONEY_12


def line_financials(items: DataFrame) -> DataFrame:
    """subtotal = unit_price·qty, discount = unit_discount·qty, total = subtotal − discount.

    Each is rounded to cents in exact decimal arithmetic (half away from zero).
    """
    qty = F.col("quantity")
    sub = F.round(F.col("unit_price") * qty, 2).cast(MONEY_12)
    disc = F.round(F.coalesce(F.col("unit_discount"), F.lit(Decimal("0.00"))) * qty, 2).cast(MONEY_12)
    return (items.withColumn("line_subtotal", sub)
            .withColumn("line_discount_total", disc)
            .withColumn("line_total", F.round(F.col("line_subtotal") - F.col("line_discount_total"), 2).cast(MONEY_12)))


def order_rollup(items: DataFrame, tax_rate: Decimal | str = "0.08") -> DataFrame:
    """Per order: subtotal, discount and tax rolled up from its lines.

    One aggregate keyed by ``order_id``; Spark combines map-side first, so a
    very large order collapses to one row per task before the shuffle.
    """
    rate = F.lit(Decimal(str(tax_rate)))
    agg = items.groupBy("order_id").agg(
        F.sum("line_subtotal").alias("_sub"),
        F.sum("line_discount_total").alias("_disc"),
    )
    taxable = F.greatest(F.col("_sub") - F.col("_disc"), F.lit(Decimal("0.00")))
    return agg.select(
        "order_id",
        F.round(F.col("_sub"), 2).cast(MONEY_12).alias("order_subtotal"),
        F.round(F.col("_disc"), 2).cast(MONEY_12).alias("order_discount"),
        taxable.cast(MONEY_12).alias("taxable_amount"),
        F.round(taxable * rate, 2).cast(MONEY_12).alias("order_tax"),
    )


def order_financials(orders: DataFrame, items: DataFrame, tax_rate: Decimal | str = "0.08",
                     shipping_col: str = "order_shipping") -> DataFrame:
    """Write the line roll-up back onto the order header.

    taxable = max(subtotal − discount, 0); tax = round(taxable · rate, 2);
    total = taxable + tax + shipping.  Orders without lines get zeros (and
    total = shipping).  Shipping is read from the header, 0 when absent.
    """
    zero = F.lit(Decimal("0.00"))
    roll = order_rollup(items, tax_rate)
    base = orders
    if shipping_col not in orders.columns:
        base = base.withColumn(shipping_col, zero.cast(MONEY_12))
    keep = [c for c in base.columns if c not in ("order_subtotal", "order_discount", "order_tax", "order_total")]
    joined = base.select(*keep).join(roll, "order_id", "left")
    ship = F.coalesce(F.col(shipping_col), zero)
    out = joined.select(
        *[F.col(c) for c in keep],
        F.coalesce("order_subtotal", zero).cast(MONEY_12).alias("order_subtotal"),
        F.coalesce("order_discount", zero).cast(MONEY_12).alias("order_discount"),
        F.coalesce("order_tax", zero).cast(MONEY_12).alias("order_tax"),
        (F.coalesce("taxable_amount", zero) + F.coalesce("order_tax", zero) + ship).cast(MONEY_12).alias("order_total"),
    )
    return out
