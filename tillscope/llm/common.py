"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
import weakref
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space that separates words.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def package_on_workers(spark: SparkSession) -> None:
    """Let local Python workers import this package from where the driver has it; a cluster gets it by ``--py-files``."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def crc_mod(col: Column, k: int) -> Column:
    """crc32 of the value's text modulo k; a null value counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


#: Where ``written`` tables lie, for ``discard``.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and any executor can read it."""
    spark = df.sparkSession
    path = shared_folder(spark, tag)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of ``written`` tables that nothing reads any more; others are left alone."""
    for table in tables:
        path = _PATHS.pop(table, None) if table is not None else None
        if path:
            spark = table.sparkSession
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, chars: int = 8_000_000):
    """Cut a batch into runs of rows whose texts hold about ``chars`` bytes, at least one row each,
    so that what a task holds at once follows the longest text and not the batch's row count."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.binary_length(col).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start, len(sizes) - start)


def summed_blocks(parts: DataFrame, dtype: str, block_items: int, salts: int = 8):
    """Element-wise sum of equally long arrays that tasks emit in blocks.

    ``parts`` has ``block`` (int) and ``data`` (binary, ``block_items`` items of
    ``dtype``).  Blocks are added up in streams, dealt by (block, salt), so a
    task holds a few sums however many parts there are; the driver gets at most
    ``salts`` partial sums a block.  Returns block to sum.
    """
    import numpy as np

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["data"].to_pylist(), strict=True):
                values = np.frombuffer(data, dtype)
                sums[block] = sums[block] + values if block in sums else values
        yield pa.RecordBatch.from_pydict(
            {"block": list(sums), "data": [v.tobytes() for v in sums.values()]},
            schema=pa.schema([("block", pa.int32()), ("data", pa.binary())]))

    dealt = parts.withColumn("salt", F.spark_partition_id() % salts).repartition("block", "salt").select("block", "data")
    out: dict[int, np.ndarray] = {}
    for row in dealt.mapInArrow(add, "block int, data binary").collect():  # salts sums a block
        values = np.frombuffer(bytes(row.data), dtype)
        out[row.block] = out[row.block] + values if row.block in out else values
    return {k: out.get(k, np.zeros(block_items, dtype)) for k in range(max(out, default=-1) + 1)}
