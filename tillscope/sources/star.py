"""The star: six DataFrames plus what is known about their sizes.

Loading (L1), writing (L7), view registration (L5) and parametrised SQL
(L6).  Every table stays a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions.common import completed
from tillscope.sources.schema import RULES, SCHEMAS

FACTS = ("fact_order", "fact_order_item")
TABLES = ("dim_customer", "dim_product", "dim_date", "dim_channel", "fact_order", "fact_order_item")


#: Partition columns of the stored facts: year and month of the order date.
PERIOD = ["p_year", "p_month"]


def date_id_of(day: dt.date) -> int:
    """The calendar key (yyyymmdd) of a day."""
    return day.year * 10000 + day.month * 100 + day.day


def _whole_months(lo: int, hi: int) -> bool:
    """Whether two date keys are a month's first and a month's last day."""
    return lo % 100 == 1 and hi % 100 == calendar.monthrange(hi // 10000, hi // 100 % 100)[1]


@dataclass(frozen=True)
class Star:
    customer: DataFrame
    product: DataFrame
    date: DataFrame
    channel: DataFrame
    orders: DataFrame
    items: DataFrame
    # Optional source-aware builder of orders with one status (lets a mapped
    # source push its raw status predicate into the scan).
    status_builder: object = None
    # Optional builder of the lines whose order is not among given ids, for
    # sources that can drop rows before they number them.
    items_without: object = None
    # Optional builder of the star of the orders between two date keys, for
    # sources that can leave whole partitions or row groups unread.
    period_builder: object = None
    # Intermediates kept by ``plans.shared`` for a star that shares them.
    shared: dict | None = field(default=None, compare=False)

    def orders_with_status(self, status: str) -> DataFrame:
        """Order headers with the given status."""
        if self.status_builder is not None:
            return self.status_builder(status)
        return self.orders.where(F.col("order_status") == F.lit(status))

    def completed_orders(self) -> DataFrame:
        """Order headers with status 'Completed'."""
        if self.status_builder is not None:
            return self.status_builder("Completed")
        return completed(self.orders)

    def between(self, first: dt.date, last: dt.date) -> "Star":
        """The star of the orders dated ``first`` to ``last`` and of their lines; dimensions stay whole.

        A loaded warehouse reads the partitions of those months only, of both
        facts; the driver's tables get the days as a filter on the scan.
        """
        lo, hi = date_id_of(first), date_id_of(last)
        if self.period_builder is not None:
            return self.period_builder(lo, hi)
        orders = self.orders.where(F.col("order_date_id").between(lo, hi))
        return replace(self, orders=orders, items=_lines_of(self.items, orders), status_builder=None, items_without=None, shared=None)

    def in_year(self, year: int, month: int | None = None) -> "Star":
        """``between`` for a calendar year or one of its months."""
        if month is None:
            return self.between(dt.date(year, 1, 1), dt.date(year, 12, 31))
        return self.between(dt.date(year, month, 1), dt.date(year, month, calendar.monthrange(year, month)[1]))

    def table(self, name: str) -> DataFrame:
        return {
            "dim_customer": self.customer,
            "dim_product": self.product,
            "dim_date": self.date,
            "dim_channel": self.channel,
            "fact_order": self.orders,
            "fact_order_item": self.items,
        }[name]

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def with_tables(self, **kw) -> "Star":
        return replace(self, **kw)


def _lines_of(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The lines of the given orders."""
    return items.join(orders.select("order_id"), "order_id", "left_semi").select(*items.columns)


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast to the declared schema; an absent optional column is NULL, an absent required one an error."""
    schema = SCHEMAS[name]
    present = set(df.columns)
    absent = [f.name for f in schema.fields if f.name not in present and (not f.nullable or f.name in RULES[name].not_null)]
    if absent:
        raise ValueError(f"{name}: required columns are missing: {', '.join(absent)}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in present else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def load_star(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> Star:
    """L1: scan the six warehouse tables stored as ``{path}/{table}`` in any Spark format.

    Each table is cast to its declared schema, so later plans can rely on
    decimal money and typed keys.  Facts that carry the partition columns of
    ``write_star`` are read by month: ``Star.between`` leaves others unread.  ``fmt="jdbc"`` passes through (give
    ``options`` with url/user; ``dbtable`` is set per table).
    """
    opts = dict(options or {})

    def read(name: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**opts)
        if fmt == "jdbc":
            return reader.option("dbtable", name).load()
        return reader.load(f"{path.rstrip('/')}/{name}")

    raw = {name: read(name) for name in TABLES}
    t = {name: _conform(df, name) for name, df in raw.items()}
    star = Star(t["dim_customer"], t["dim_product"], t["dim_date"], t["dim_channel"], t["fact_order"], t["fact_order_item"])
    if not all(set(PERIOD) <= set(raw[name].columns) for name in FACTS):
        return star

    def period(lo: int, hi: int) -> Star:
        month = F.col("p_year") * 100 + F.col("p_month")
        orders, items = (_conform(raw[name].where(month.between(lo // 100, hi // 100)), name) for name in FACTS)
        if not _whole_months(lo, hi):
            orders = orders.where(F.col("order_date_id").between(lo, hi))
            items = _lines_of(items, orders)
        return star.with_tables(orders=orders, items=items, period_builder=period_within(lo, hi))

    def period_within(first: int, last: int):
        return lambda lo, hi: period(max(lo, first), min(hi, last))

    return star.with_tables(period_builder=period)


def write_star(star: Star, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Bulk write of the star.

    Facts are partitioned by year and month of the order date; each month's rows
    are dealt over as many files as its share needs (``REBALANCE`` sizes them),
    so the number of files follows the data and not the tasks.  The line table
    carries the partition columns of its header (NULL for a line without one).
    """
    base = path.rstrip("/")
    for name in ("dim_customer", "dim_product", "dim_date", "dim_channel"):
        star.table(name).write.mode(mode).format(fmt).save(f"{base}/{name}")
    day = F.col("order_date_id")
    orders = star.orders.withColumn("p_year", F.floor(day / 10000).cast("int")).withColumn("p_month", F.floor(day / 100 % 100).cast("int"))
    items = star.items.join(orders.select("order_id", *PERIOD), "order_id", "left")
    for name, df in (("fact_order", orders), ("fact_order_item", items)):
        df.hint("rebalance", *PERIOD).write.mode(mode).format(fmt).partitionBy(*PERIOD).save(f"{base}/{name}")


def bucket_count(input_bytes: int, target_bytes: int = 256 * 2**20) -> int:
    """Buckets for a fact table of that size, so that one bucket is about ``target_bytes``."""
    return max(1, -(-input_bytes // target_bytes))


def save_star_tables(star: Star, buckets: int, database: str = "default", mode: str = "overwrite",
                     prefix: str = "") -> list[str]:
    """L7, table form: the star as catalog tables, facts bucketed by ``order_id``.

    ``buckets`` is best taken from ``bucket_count`` of the line table's bytes.
    Both facts are written with the same bucket count on ``order_id`` (and
    sorted by it inside each bucket), so the line-to-order join of every
    line-level query reads matching buckets side by side: no shuffle of
    either fact.  Dimensions are plain tables.  Files go to the session's
    warehouse folder (``spark.sql.warehouse.dir``).
    """
    names = []
    for name, df in star.tables().items():
        table = f"{database}.{prefix}{name}"
        writer = df.write.mode(mode).format("parquet")
        if name in FACTS:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        writer.saveAsTable(table)
        names.append(table)
    return names


def load_star_tables(spark: SparkSession, database: str = "default", prefix: str = "") -> Star:
    """L1, table form: read a star saved by ``save_star_tables`` (bucketing is kept)."""
    t = {name: _conform(spark.table(f"{database}.{prefix}{name}"), name) for name in TABLES}
    return Star(t["dim_customer"], t["dim_product"], t["dim_date"], t["dim_channel"],
                t["fact_order"], t["fact_order_item"])


def register_views(spark: SparkSession, star: Star) -> list[str]:
    """Register the base tables and the eleven named views as temp views.

    Views are registered in dependency order (base tables, then views that
    read only base tables, then the views built on other views).  All of them
    are plans over the base tables: registering runs nothing, and a view shows
    appended rows once the session has refreshed its tables.
    """
    from tillscope.plans import basket, cohorts, customers, products, revenue

    names = []
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)
        names.append(name)
    views = [
        ("vw_daily_revenue", lambda: revenue.daily_revenue(star)),
        ("vw_revenue_by_channel", lambda: revenue.revenue_by_channel(star)),
        ("vw_revenue_by_category", lambda: products.revenue_by_category(star)),
        ("vw_customer_lifetime_value", lambda: customers.customer_lifetime_value(star)),
        ("vw_customer_rfm_base", lambda: customers.rfm_base(star)),
        ("vw_customer_rfm_scores", lambda: customers.rfm_scores(star)),
        ("vw_customer_ltv_segments", lambda: customers.ltv_segments(star)),
        ("vw_cohort_retention", lambda: cohorts.cohort_retention(star)),
        ("vw_product_pairs", lambda: basket.product_pairs(star)),
        ("vw_category_margin_monthly", lambda: products.category_margin_monthly(star)),
        ("vw_product_association_rules", lambda: basket.association_rules(star)),
    ]
    for name, build in views:
        build().createOrReplaceTempView(name)
        names.append(name)
    return names


def drop_views(spark: SparkSession, names: list[str]) -> None:
    """Drop registered views, dependants first."""
    for name in reversed(names):
        spark.catalog.dropTempView(name)


def run_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """Run parametrised SQL (named ``:param`` markers) and return a DataFrame."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)
