"""Mean pivot with zero fill (A17), the DataFrame form of a pandas pivot table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_fill(df: DataFrame, index: str, columns: str, values: str, pivot_values: list, fill: float = 0.0) -> DataFrame:
    """One row per ``index``, one column per value of ``pivot_values``, mean of ``values``.

    Rows with a NULL index or column key are dropped and missing cells are
    ``fill``.  Result columns are named by the key's string form.
    """
    keyed = df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
    wide = keyed.groupBy(index).pivot(columns, pivot_values).agg(F.avg(values))
    return wide.na.fill(fill, subset=[str(v) for v in pivot_values]).orderBy(index)


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-NULL values of a column in order, as a one-column table."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
