"""Warehouse maintenance as set operations: L4, L10–L13."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_new(existing: DataFrame, incoming: DataFrame, keys: list[str] | list[list[str]]) -> DataFrame:
    """L4: idempotent insert: ``existing`` plus the incoming rows that conflict with nothing.

    ``keys`` is one conflict target (list of columns) or several unique keys
    (list of lists: a row is skipped when it conflicts on any of them, as ``ON
    CONFLICT DO NOTHING`` without a target does).  Rows that conflict with
    stored rows go first; then each key in turn keeps, of incoming rows that
    share it, the first in the order of all columns.  A key with a NULL
    conflicts with nothing, as in SQL.

    Within a batch this is the set that inserting in that order would give for
    one key; for several keys a row that loses on one no longer holds its place
    on the next.
    """
    targets = [keys] if keys and isinstance(keys[0], str) else list(keys)
    fresh = incoming.select(*existing.columns)
    for t in targets:
        fresh = fresh.join(existing.select(*t), t, "left_anti").select(*existing.columns)
    for t in targets:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in t])
        first = fresh.where(whole).groupBy(*t).agg(F.min(F.struct(*existing.columns)).alias("row")).select("row.*")
        fresh = first.unionByName(fresh.where(~whole))
    return existing.unionByName(fresh)


def attach_date_key(df: DataFrame, dim_date: DataFrame, date_col: str, out: str = "date_id",
                    strict: bool = True) -> DataFrame:
    """Add the calendar key of ``date_col`` by equality on ``date_actual``.

    With ``strict`` a date outside the calendar fails the query that reads the
    result (in the same pass); otherwise it gets NULL.
    """
    d = dim_date.select(F.col("date_actual").alias("_d"), F.col("date_id").alias(out))
    keyed = df.join(d, F.to_date(F.col(date_col)) == F.col("_d"), "left").drop("_d")
    if not strict:
        return keyed
    problem = F.concat(F.lit(f"{date_col}: date outside the calendar dimension: "), F.col(date_col).cast("string"))
    known = F.when(F.col(date_col).isNull() | F.col(out).isNotNull(), F.lit(True))
    return keyed.where(known.otherwise(F.raise_error(problem).cast("boolean")))


def natural_key(prefix: str, width: int, id_col: str) -> Column:
    """L11: 'PREFIX-000042' style key from a numeric id."""
    return F.format_string(f"{prefix}-%0{width}d", F.col(id_col))


def email_of(first: str, last: str, domain: str) -> Column:
    """L11: 'first.last@domain', lower-cased."""
    return F.lower(F.concat_ws("", F.col(first), F.lit("."), F.col(last), F.lit("@"), F.col(domain)))


def product_name_of(brand: str, subcategory: str, n: str) -> Column:
    """L11: 'brand subcategory n'."""
    return F.concat_ws(" ", F.col(brand), F.col(subcategory), F.col(n).cast("string"))


def active_products(products: DataFrame) -> DataFrame:
    """Sellable products — active ones, with id and list price."""
    return products.where(F.col("is_active")).select("product_id", "list_price")


def cascade_delete(orders: DataFrame, items: DataFrame, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove orders whose ``order_id`` is in ``doomed`` and, by cascade, their lines."""
    ids = doomed.select("order_id").distinct()
    return orders.join(ids, "order_id", "left_anti"), items.join(ids, "order_id", "left_anti")

