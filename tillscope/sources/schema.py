"""Typed schemas of the six warehouse tables, plus column rules.

The warehouse is a fixed star schema: four dimensions (customer, product,
date, channel) and two facts (order header, order line).  Money is exact
decimal; keys are 64-bit; dates are DATE; the header timestamp has no zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY_10 = T.DecimalType(10, 2)
MONEY_12 = T.DecimalType(12, 2)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


DIM_CUSTOMER = T.StructType([
    _f("customer_id", T.LongType(), False),
    _f("customer_key", T.StringType(), False),
    _f("first_name", T.StringType()),
    _f("last_name", T.StringType()),
    _f("email", T.StringType()),
    _f("phone", T.StringType()),
    _f("created_date", T.DateType()),
    _f("country", T.StringType()),
    _f("region", T.StringType()),
    _f("city", T.StringType()),
    _f("postal_code", T.StringType()),
    _f("segment", T.StringType()),
])

DIM_PRODUCT = T.StructType([
    _f("product_id", T.LongType(), False),
    _f("product_sku", T.StringType(), False),
    _f("product_name", T.StringType(), False),
    _f("brand", T.StringType()),
    _f("category", T.StringType()),
    _f("subcategory", T.StringType()),
    _f("list_price", MONEY_10),
    _f("cost", MONEY_10),
    _f("is_active", T.BooleanType(), False),
])

DIM_DATE = T.StructType([
    _f("date_id", T.IntegerType(), False),
    _f("date_actual", T.DateType(), False),
    _f("year", T.IntegerType(), False),
    _f("quarter", T.IntegerType(), False),
    _f("month", T.IntegerType(), False),
    _f("day", T.IntegerType(), False),
    _f("day_of_week", T.IntegerType(), False),
    _f("is_weekend", T.BooleanType(), False),
    _f("week_of_year", T.IntegerType(), False),
])

DIM_CHANNEL = T.StructType([
    _f("channel_id", T.LongType(), False),
    _f("channel_name", T.StringType(), False),
    _f("channel_group", T.StringType()),
    _f("details", T.StringType()),
])

FACT_ORDER = T.StructType([
    _f("order_id", T.LongType(), False),
    _f("order_number", T.StringType(), False),
    _f("customer_id", T.LongType(), False),
    _f("order_date_id", T.IntegerType(), False),
    _f("channel_id", T.LongType()),
    _f("order_status", T.StringType(), False),
    _f("order_subtotal", MONEY_12, False),
    _f("order_tax", MONEY_12, False),
    _f("order_shipping", MONEY_12, False),
    _f("order_discount", MONEY_12, False),
    _f("order_total", MONEY_12, False),
    _f("created_at", T.TimestampNTZType(), False),
])

FACT_ORDER_ITEM = T.StructType([
    _f("order_item_id", T.DecimalType(38, 0), False),
    _f("order_id", T.LongType(), False),
    _f("product_id", T.LongType(), False),
    _f("quantity", T.IntegerType(), False),
    _f("unit_price", MONEY_10, False),
    _f("unit_discount", MONEY_10, False),
    _f("line_subtotal", MONEY_12, False),
    _f("line_discount_total", MONEY_12, False),
    _f("line_total", MONEY_12, False),
])

SCHEMAS = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "dim_channel": DIM_CHANNEL,
    "fact_order": FACT_ORDER,
    "fact_order_item": FACT_ORDER_ITEM,
}


@dataclass(frozen=True)
class TableRules:
    """Declared constraints of one table (what the DDL enforces)."""

    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent key)
    checks: tuple[tuple[str, str], ...] = ()  # (name, SQL predicate that must hold)
    defaults: tuple[tuple[str, object], ...] = ()


# Declared varchar lengths, keys and defaults of the warehouse DDL.
RULES = {
    "dim_customer": TableRules(
        primary_key=("customer_id",),
        unique=(("customer_key",),),
        not_null=("customer_id", "customer_key"),
        max_length=(("customer_key", 50), ("first_name", 100), ("last_name", 100), ("email", 255),
                    ("phone", 50), ("country", 100), ("region", 100), ("city", 100),
                    ("postal_code", 20), ("segment", 50)),
    ),
    "dim_product": TableRules(
        primary_key=("product_id",),
        unique=(("product_sku",),),
        not_null=("product_id", "product_sku", "product_name", "is_active"),
        max_length=(("product_sku", 50), ("product_name", 255), ("brand", 100), ("category", 100),
                    ("subcategory", 100)),
        defaults=(("is_active", True),),
    ),
    "dim_date": TableRules(
        primary_key=("date_id",),
        unique=(("date_actual",),),
        not_null=("date_id", "date_actual", "year", "quarter", "month", "day", "day_of_week",
                  "is_weekend", "week_of_year"),
    ),
    "dim_channel": TableRules(
        primary_key=("channel_id",),
        unique=(("channel_name",),),
        not_null=("channel_id", "channel_name"),
        max_length=(("channel_name", 100), ("channel_group", 100), ("details", 255)),
    ),
    "fact_order": TableRules(
        primary_key=("order_id",),
        unique=(("order_number",),),
        not_null=("order_id", "order_number", "customer_id", "order_date_id", "order_status",
                  "order_subtotal", "order_tax", "order_shipping", "order_discount", "order_total",
                  "created_at"),
        max_length=(("order_number", 50), ("order_status", 50)),
        foreign_keys=(("customer_id", "dim_customer", "customer_id"),
                      ("order_date_id", "dim_date", "date_id"),
                      ("channel_id", "dim_channel", "channel_id")),
        defaults=(("order_subtotal", 0), ("order_tax", 0), ("order_shipping", 0),
                  ("order_discount", 0), ("order_total", 0), ("created_at", "now")),
    ),
    "fact_order_item": TableRules(
        primary_key=("order_item_id",),
        not_null=("order_item_id", "order_id", "product_id", "quantity", "unit_price",
                  "unit_discount", "line_subtotal", "line_discount_total", "line_total"),
        foreign_keys=(("order_id", "fact_order", "order_id"),
                      ("product_id", "dim_product", "product_id")),
        checks=(("quantity_positive", "quantity > 0"),),
        defaults=(("unit_discount", 0), ("line_discount_total", 0)),
    ),
}
