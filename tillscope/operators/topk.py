"""Top-k with a unique tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, order: list[Column], k: int, tie: list[Column] | None = None) -> DataFrame:
    """The first ``k`` rows of ``df`` under ``order`` then ``tie``.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own k best rows and only those reach the final merge, so no
    full sort or shuffle of the input happens.  ``tie`` must make the order
    total, otherwise which of several equal rows is kept is arbitrary.
    """
    return df.orderBy(*order, *(tie or [])).limit(k)
