"""Explicit sharing of tables that several named queries read.

A star's plans are lazy and read its tables anew each time.  Inside
``sharing(star)`` the intermediates named by ``per_star`` (the per-customer
figures, the category-month margins, the frequent pairs, the tiles, the
segments) are written once as Parquet below the shared
``spark.checkpoint.dir`` and read back by every query built on the star that
the block is given; the files go when it ends.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillscope.session import ensure_checkpoint_dir

_LOCK = threading.RLock()


def per_star(star, key: Hashable, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as it is; for a sharing star, written on first use and read back."""
    if star.shared is None:
        return build()
    with _LOCK:
        if key not in star.shared:
            df = build()
            path = f"{ensure_checkpoint_dir(df.sparkSession)}/star-{uuid.uuid4().hex}"
            df.write.parquet(path)
            star.shared[key] = (path, df.sparkSession.read.schema(df.schema).parquet(path))
        return star.shared[key][1]


def shared(star):
    """A copy of the star that shares its intermediates until ``release``."""
    return star.with_tables(shared={})


def release(star) -> None:
    """Delete what a sharing star has written."""
    with _LOCK:
        for path, df in (star.shared or {}).values():
            _delete(df.sparkSession, path)
        if star.shared:
            star.shared.clear()


@contextmanager
def sharing(star) -> Iterator:
    kept = shared(star)
    try:
        yield kept
    finally:
        release(kept)


@contextmanager
def scratch(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written as Parquet below the shared ``spark.checkpoint.dir`` for steps that read it many times; deleted afterwards."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
