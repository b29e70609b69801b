"""Mapping of the driver's TPC-H-like tables onto the retail star.

The test data ships ``customer part orders lineitem nation region`` as
parquet.  This module re-expresses them as the six warehouse tables with
column expressions only (no collect), so every query runs over the whole
input and its work grows with it.  The same expressions are written in the
DuckDB oracle (``tillscope.oracle``).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillscope.operators.finance import order_rollup
from tillscope.sources.dims import build_dim_channel, build_dim_date, calendar_for, date_key
from tillscope.sources.schema import MONEY_10, MONEY_12
from tillscope.sources.star import Star

# Order priority → channel id, order status letter → status.
PRIORITY_CHANNEL = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("5-LOW", 4)]  # '4-NOT SPECIFIED' → NULL
STATUS_NAMES = [("F", "Completed"), ("O", "Refunded"), ("P", "Cancelled")]


#: Schemas met so far, by application and path: a table's footers are read once, not for every query.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    reader = spark.read.schema(_SCHEMAS[key]) if key in _SCHEMAS else spark.read
    table = reader.parquet(path)
    _SCHEMAS[key] = table.schema
    return table


def _case(column: str, pairs) -> F.Column:
    expr = None
    for key, value in pairs:
        expr = F.when(F.col(column) == key, F.lit(value)) if expr is None else expr.when(F.col(column) == key, F.lit(value))
    return expr


def map_customer(customer: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame) -> DataFrame:
    first_order = (orders.groupBy(F.col("o_custkey").alias("c_custkey"))
                   .agg(F.to_date(F.min("o_orderdate")).alias("created_date")))
    # one row a nation: grouped by the key, which shows the optimizer that a query without geography can do without the join
    regions = region.groupBy("r_regionkey").agg(F.first("r_name").alias("r_name"))
    geo = nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("n_nationkey").agg(
        F.first("n_name").alias("n_name"), F.first("r_name").alias("r_name"))
    c = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    c = c.join(first_order, "c_custkey", "left")
    null = F.lit(None).cast("string")
    return c.select(
        F.col("c_custkey").cast("long").alias("customer_id"),
        F.col("c_name").alias("customer_key"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        null.alias("email"),
        null.alias("phone"),
        F.col("created_date"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.concat(F.col("n_name"), F.lit("-C"), (F.col("c_custkey") % 10).cast("string")).alias("city"),
        null.alias("postal_code"),
        F.col("c_mktsegment").alias("segment"),
    )


def map_product(part: DataFrame) -> DataFrame:
    list_price = F.col("p_retailprice").cast(MONEY_10)
    return part.select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.format_string("SKU-%05d", F.col("p_partkey")).alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("size-"), F.floor((F.col("p_size") - 1) / 10).cast("int").cast("string")).alias("subcategory"),
        list_price.alias("list_price"),
        F.round(list_price * F.lit(Decimal("0.60")), 2).cast(MONEY_10).alias("cost"),
        (F.col("p_partkey") % 20 != 0).alias("is_active"),
    )


def map_items(lineitem: DataFrame) -> DataFrame:
    sub = F.col("l_extendedprice").cast(MONEY_12)
    disc = F.round(sub * F.col("l_discount").cast("decimal(4,2)"), 2).cast(MONEY_12)
    qty = F.col("l_quantity").cast("int")
    # Order and line number are no key of the lines: lines that share both are
    # numbered (over the other columns, so equal lines are interchangeable).
    # A long order falls apart into its line numbers, and the window is pruned
    # away whenever order_item_id is not read.  18 digits stay free below the
    # order key, 9 of them for the line number, so keys cannot meet.
    pair = ["l_orderkey", "l_linenumber"]
    w = Window.partitionBy(*pair).orderBy(*[F.col(c).asc_nulls_first() for c in lineitem.columns if c not in pair])
    key = (F.col("l_orderkey").cast("decimal(20,0)") * F.lit(Decimal(10**18))
           + F.coalesce("l_linenumber", F.lit(0)).cast("decimal(18,0)") * F.lit(Decimal(10**9)) + F.row_number().over(w))
    return lineitem.select(
        key.cast("decimal(38,0)").alias("order_item_id"),
        F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        qty.alias("quantity"),
        F.round(sub / F.when(qty != 0, qty), 2).cast(MONEY_10).alias("unit_price"),
        F.round(disc / F.when(qty != 0, qty), 2).cast(MONEY_10).alias("unit_discount"),
        sub.alias("line_subtotal"),
        disc.alias("line_discount_total"),
        (sub - disc).cast(MONEY_12).alias("line_total"),
    )


def map_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    zero = F.lit(Decimal("0.00")).cast(MONEY_12)
    roll = order_rollup(items).select(
        F.col("order_id").alias("o_orderkey"), "order_subtotal", "order_discount", "order_tax")
    o = orders.join(roll, "o_orderkey", "left")
    d = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.format_string("ORD-%07d", F.col("o_orderkey")).alias("order_number"),
        F.col("o_custkey").cast("long").alias("customer_id"),
        date_key(d).alias("order_date_id"),
        _case("o_orderpriority", PRIORITY_CHANNEL).cast("long").alias("channel_id"),
        _case("o_orderstatus", STATUS_NAMES).alias("order_status"),
        F.coalesce("order_subtotal", zero).alias("order_subtotal"),
        F.coalesce("order_tax", zero).alias("order_tax"),
        zero.alias("order_shipping"),
        F.coalesce("order_discount", zero).alias("order_discount"),
        F.col("o_totalprice").cast(MONEY_12).alias("order_total"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
    )


def calendar_span(orders: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last order date, widened to whole years: a ``span`` to hand to ``driver_star`` (one aggregate, run now)."""
    first, last = orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    today = dt.date.today()
    return dt.date((first or today).year, 1, 1), dt.date((last or today).year, 12, 31)


def driver_star(spark: SparkSession, sf_dir: str, span: tuple[dt.date, dt.date] | None = None) -> Star:
    """The star over ``{sf_dir}/*.parquet``, all of it lazy plans.

    The calendar covers the years of the order dates, which a query that needs
    it finds while it runs; give ``span`` (first and last day) to save that pass
    over one column where the days are known.
    """
    lineitem = _read(spark, sf_dir, "lineitem")
    orders_raw = _read(spark, sf_dir, "orders")
    customer = map_customer(_read(spark, sf_dir, "customer"), _read(spark, sf_dir, "nation"),
                            _read(spark, sf_dir, "region"), orders_raw)
    return _facts_star(Star(
        customer=customer,
        product=map_product(_read(spark, sf_dir, "part")),
        date=build_dim_date(spark, *span) if span else calendar_for(orders_raw, "o_orderdate", whole_years=True),
        channel=build_dim_channel(spark), orders=orders_raw, items=lineitem), orders_raw, lineitem)


def _facts_star(dims: Star, orders_raw: DataFrame, lineitem: DataFrame) -> Star:
    """The dimensions of ``dims`` with facts mapped from the given raw tables."""
    items = map_items(lineitem)
    codes = {name: code for code, name in STATUS_NAMES}
    by_status: dict = {}

    def lines_of(raw: DataFrame) -> DataFrame:
        own = lineitem.join(raw.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        return own.select(*lineitem.columns)

    def orders_with_status(status: str) -> DataFrame:
        # same rows as filtering the mapped status, but the predicate is on the
        # raw column, so it reaches the parquet scan as a pushed filter
        if status not in by_status:
            code = codes.get(status)
            raw = orders_raw.where(F.col("o_orderstatus") == code) if code else orders_raw.where(F.lit(False))
            by_status[status] = map_orders(raw, map_items(lines_of(raw)))
        return by_status[status]

    def period(lo: int, hi: int) -> Star:
        # days as a range of the raw column, for the scan's row group statistics
        first, last = (dt.date(x // 10000, x // 100 % 100, x % 100) for x in (lo, hi))
        raw = orders_raw.where((F.col("o_orderdate") >= F.lit(first)) & (F.col("o_orderdate") < F.lit(last + dt.timedelta(days=1))))
        return _facts_star(dims, raw, lines_of(raw))

    return dims.with_tables(
        orders=map_orders(orders_raw, items),
        items=items,
        status_builder=orders_with_status,
        items_without=lambda ids: map_items(lineitem.join(ids.select(F.col("order_id").alias("l_orderkey")), "l_orderkey", "left_anti")
                                            .select(*lineitem.columns)),
        period_builder=period,
    )
