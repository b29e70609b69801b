"""Summary tables of V1, V2, V3 and V10 that take in new batches of orders.

What is stored are sums and counts at the views' own grain, so a batch of new
orders with their lines is summed up on its own and added: the facts loaded
before are not read again.  Margins are kept by product and month, without the
product's cost, so V10 follows cost changes as the view over the facts does.

A store is a folder of versions.  A batch writes a whole new version of these
small tables and then a mark beside them; readers take the latest marked
version, so they see a batch entirely or not at all, and a batch that failed
half way leaves nothing behind that is read.  A batch's id is kept, and a batch
that comes again adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions.common import avg_money, money
from tillscope.operators.joins import with_calendar
from tillscope.plans import products
from tillscope.sources.star import Star

#: Keys of each summary; all its other columns add up.
KEYS = {
    "daily": ["order_date", "year", "month", "week_of_year"],
    "channel_month": ["channel_id", "year", "month"],
    "category_month": ["category", "subcategory", "year", "month"],
    "product_month": ["product_id", "year", "month"],
}
_BATCHES, _MARK = "batches", "_COMPLETE"


def summarize(star: Star) -> dict[str, DataFrame]:
    """The summaries of a star, or of a batch that has the star's dimensions and new orders with all their lines."""
    orders = with_calendar(star, star.completed_orders(), "date_actual", "year", "month", "week_of_year")
    lines = products.completed_lines(star, "year", "month")
    per_order = lines.join(star.product.select("product_id", "category", "subcategory"), "product_id").groupBy(
        "order_id", *KEYS["category_month"]).agg(F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units"))
    return {
        "daily": orders.groupBy(F.col("date_actual").alias("order_date"), *KEYS["daily"][1:]).agg(
            *[F.sum(f"order_{x}").alias(x) for x in ("total", "subtotal", "tax", "shipping")], F.count(F.lit(1)).alias("orders")),
        "channel_month": orders.groupBy(*KEYS["channel_month"]).agg(F.sum("order_total").alias("total"), F.count(F.lit(1)).alias("orders")),
        "category_month": per_order.groupBy(*KEYS["category_month"]).agg(
            F.sum("revenue").alias("revenue"), F.sum("units").cast("long").alias("units"), F.count(F.lit(1)).alias("orders")),
        "product_month": lines.groupBy(*KEYS["product_month"]).agg(
            F.sum("line_total").alias("revenue"), F.sum("quantity").cast("long").alias("units")),
    }


def add_up(name: str, *parts: DataFrame) -> DataFrame:
    """Summaries of one kind added up, in the first one's types."""
    both = parts[0]
    for more in parts[1:]:
        both = both.unionByName(more)
    sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in parts[0].schema if f.name not in KEYS[name]]
    return both.groupBy(*KEYS[name]).agg(*sums)


def views_of(star: Star, summaries: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """V1, V2, V3 and V10 from summaries; of ``star`` only dimensions are read."""
    daily, channel, category = (summaries[x] for x in ("daily", "channel_month", "category_month"))
    named = channel.join(star.channel.select("channel_id", "channel_name", "channel_group"), "channel_id", "left").groupBy(
        "channel_name", "channel_group", "year", "month").agg(F.sum("total").alias("total"), F.sum("orders").alias("order_count"))
    by_product = summaries["product_month"].select("product_id", "year", "month", F.col("revenue").alias("_rev"), F.col("units").alias("_qty"))
    return {
        "vw_daily_revenue": daily.select(
            *KEYS["daily"], money("total").alias("total_revenue"), money("subtotal").alias("subtotal_revenue"),
            money("tax").alias("total_tax"), money("shipping").alias("total_shipping"), F.col("orders").alias("order_count")),
        "vw_revenue_by_channel": named.select(
            "channel_name", "channel_group", "year", "month", money("total").alias("total_revenue"), "order_count",
            avg_money("total", "order_count").alias("avg_order_value")),
        "vw_revenue_by_category": category.select(
            *KEYS["category_month"], money("revenue").alias("line_revenue"), F.col("units").alias("units_sold"),
            F.col("orders").alias("orders_with_category")),
        "vw_category_margin_monthly": products.margin_view(products.margin_of(by_product, star.product)),
    }


class SummaryStore:
    """Versions of the summaries below ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The latest complete version, 0 for an empty store."""
        root = self._at(self.path)
        found = self._fs.listStatus(root) if self._fs.exists(root) else []
        names = [s.getPath().getName() for s in found]
        done = [int(n[2:].split("-")[0]) for n in names if n.startswith("v-") and self._fs.exists(self._at(f"{self.path}/{n}/{_MARK}"))]
        return max(done, default=0)

    def _folder(self, version: int) -> str:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path))]
        return next(f"{self.path}/{n}" for n in sorted(names)
                    if n.startswith(f"v-{version:08d}-") and self._fs.exists(self._at(f"{self.path}/{n}/{_MARK}")))

    def read(self) -> dict[str, DataFrame]:
        """The summaries of the latest version; empty for an empty store."""
        if not self.version():
            return {}
        folder = self._folder(self.version())
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in KEYS}

    def add(self, batch: Star, batch_id: str) -> bool:
        """Take in a batch of new orders; False if this id was taken in before."""
        last = self.version()
        ids = self.spark.read.parquet(f"{self._folder(last)}/{_BATCHES}") if last else self.spark.createDataFrame([], "batch string")
        if last and ids.where(F.col("batch") == batch_id).limit(1).count():
            return False
        old, new = self.read(), summarize(batch)
        folder = f"{self.path}/v-{last + 1:08d}-{uuid.uuid4().hex}"
        for name in KEYS:
            (add_up(name, old[name], new[name]) if old else new[name]).write.parquet(f"{folder}/{name}")
        ids.union(self.spark.createDataFrame([(batch_id,)], "batch string")).coalesce(1).write.parquet(f"{folder}/{_BATCHES}")
        self._fs.create(self._at(f"{folder}/{_MARK}"), False).close()
        return True

    def register(self, star: Star) -> list[str]:
        """Replace the four views by the latest version's; ``star`` gives the dimensions."""
        views = views_of(star, self.read())
        for name, view in views.items():
            view.createOrReplaceTempView(name)
        return list(views)


def summarized_margin(star: Star) -> DataFrame:
    """V10 out of summaries of two batches (orders of even and odd months) added up."""
    return views_of(star, _two_batches(star))["vw_category_margin_monthly"]


def summarized_categories(star: Star) -> DataFrame:
    """V3 out of summaries of two batches added up."""
    return views_of(star, _two_batches(star))["vw_revenue_by_category"]


def summarized_channels(star: Star) -> DataFrame:
    """V2 out of summaries of two batches added up."""
    return views_of(star, _two_batches(star))["vw_revenue_by_channel"]


def summarized_days(star: Star) -> DataFrame:
    """V1 out of summaries of two batches added up."""
    return views_of(star, _two_batches(star))["vw_daily_revenue"]


def _two_batches(star: Star) -> dict[str, DataFrame]:
    """Batches split by order number, so that both have rows of every group."""
    parts = []
    for odd in (0, 1):
        own = F.col("order_id") % 2 == odd
        done = star.completed_orders()
        parts.append(summarize(star.with_tables(orders=done.where(own), items=star.items.where(own), status_builder=None,
                                                items_without=None, period_builder=None, shared=None)))
    return {name: add_up(name, parts[0][name], parts[1][name]) for name in KEYS}
