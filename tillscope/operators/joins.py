"""Join helpers.

No join carries a broadcast hint: Spark's size estimates and the adaptive
planner choose from bytes, and a dimension that has grown is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.sources.star import Star


def with_calendar(star: Star, orders: DataFrame, *cols: str) -> DataFrame:
    """Attach calendar columns to order rows by ``order_date_id = date_id``.

    An order date without a calendar row fails the query, as the foreign key
    of the warehouse would: dropping the order silently would change totals.
    """
    dates = star.date.select("date_id", *cols)
    joined = orders.join(dates, orders["order_date_id"] == dates["date_id"], "left")
    problem = F.concat(F.lit("order date without a calendar row: "), F.coalesce(F.col("order_date_id").cast("string"), F.lit("NULL")))
    return joined.where(F.when(F.col("date_id").isNotNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))).drop("date_id")
