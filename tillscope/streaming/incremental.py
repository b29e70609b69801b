"""Micro-batch loading of fact rows with insert-if-absent semantics.

The reference has no streaming queries; its loader appends rows and relies
on ``ON CONFLICT DO NOTHING`` so a re-run does not duplicate them.  The
same contract for a continuously arriving feed is a Structured Streaming
query whose ``foreachBatch`` sink keeps only rows whose key is not already
in the target table and appends them, as ``operators.maintenance.insert_new``
would: of rows of a batch that share a key the first in the order of all
columns is kept, and a key with a NULL conflicts with nothing.  Re-delivered
batches and replays after a failure are therefore harmless.

Of the stored table only files are read that may hold a key of the batch
(``streaming.key_index``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillscope.streaming.key_index import exists, files_that_may_hold, write_index


def fresh_rows(batch: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """The batch's rows whose key is not among ``existing`` (columns ``keys``), one of each key."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    first = batch.where(whole).groupBy(*keys).agg(F.min(row).alias("_row")).select("_row.*")
    if existing is not None:
        first = first.join(existing, keys, "left_anti").select(*batch.columns)
    return first.unionByName(batch.where(~whole))


def append_absent(batch: DataFrame, path: str, keys: list[str], fmt: str = "parquet",
                  partition_by: list[str] | None = None) -> list[str]:
    """Append the rows of ``batch`` whose ``keys`` are not yet stored at ``path``; returns the stored files that were read."""
    spark = batch.sparkSession
    stored: list[str] = []
    read: list[str] = []
    existing = None
    if exists(spark, path):  # any other read error is raised
        stored = list(spark.read.format(fmt).load(path).inputFiles())
        read = files_that_may_hold(batch, path, keys, stored)
        if read:
            existing = spark.read.format(fmt).option("basePath", path).load(read).select(*keys)
    writer = fresh_rows(batch, existing, keys).write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    before = set(stored)
    write_index(spark, path, keys, fmt, [f for f in spark.read.format(fmt).load(path).inputFiles() if f not in before])
    return read


def start_idempotent_load(stream: DataFrame, path: str, keys: list[str], checkpoint: str,
                          fmt: str = "parquet", partition_by: list[str] | None = None,
                          trigger: dict | None = None) -> StreamingQuery:
    """Start a streaming load of ``stream`` into ``path`` (insert-if-absent on ``keys``).

    ``checkpoint`` must be a reliable shared folder (the query's progress
    and offsets live there).  ``trigger`` is passed to ``DataStreamWriter.trigger``,
    e.g. ``{"availableNow": True}`` for catch-up runs.
    """
    def load(batch: DataFrame, _epoch: int) -> None:
        append_absent(batch, path, keys, fmt, partition_by)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
