"""An index of stored keys by file, so that an append reads only files that may hold one of its keys (L4).

Beside a table lies a small table of what its files hold: per file the smallest
and the largest key, and a one-hash Bloom filter of its keys in blocks of
32,768 bits, sized by the file's rows (``BITS_PER_KEY`` or more bits a key).  A
batch meets the index by an equi-join on (filter size, block); files that pass
both tests for some key of the batch are read, no other file is.  The filter can
only name too many files, and files that the index doesn't know (an append that
failed before it was indexed, files written by others) are always read, so the
index decides what is read and never what is stored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_KEY = 8
BLOCK_BITS = 32_768


def index_folder(path: str) -> str:
    """Where a table's index lies: beside the table, not in it."""
    return f"{path.rstrip('/')}.keys"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _same_form(file: str) -> str:
    """A file's name as the index has it: listings differ in the slashes behind the scheme."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", file)


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _slots(bits: Column, h: Column) -> tuple[Column, Column]:
    """Block and bit of a hash in a filter of so many bits."""
    slot = F.pmod(h, bits)
    return F.floor(slot / BLOCK_BITS).cast("long"), (slot % BLOCK_BITS).cast("long")


def index_rows(stored: DataFrame, keys: list[str]) -> DataFrame:
    """(file, bits, block, filter, low, high) of the files of ``stored``, a table read from files."""
    name = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")
    rows = stored.select(name.alias("file"), F.struct(*keys).alias("key"), _hash(keys).alias("h"))
    size = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") * BITS_PER_KEY, F.lit(BLOCK_BITS))))).cast("long")
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).select(
        "file", "low", "high", size.alias("bits"))
    block, bit = _slots(F.col("bits"), F.col("h"))
    return (
        rows.join(files, "file").groupBy("file", "low", "high", "bits", block.alias("block"))
        .agg(F.bitmap_construct_agg(bit).alias("filter"))
        .select("file", "bits", "block", "filter", "low", "high"))


def write_index(spark: SparkSession, path: str, keys: list[str], fmt: str, files: list[str]) -> None:
    """Add the given files of the table at ``path`` to its index."""
    if files:
        stored = spark.read.format(fmt).option("basePath", path).load(files)
        index_rows(stored, keys).write.mode("append").parquet(index_folder(path))


def _bit_set(filter_: Column, bit: Column) -> Column:
    """Whether a bitmap (bit i: byte i div 8, lowest bit first) has the bit."""
    byte = F.conv(F.hex(F.substring(filter_, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def files_that_may_hold(batch: DataFrame, path: str, keys: list[str], files: list[str]) -> list[str]:
    """The ``files`` of the table that may hold one of the batch's keys (a list of names, as a scan's file listing is)."""
    spark = batch.sparkSession
    folder = index_folder(path)
    if not exists(spark, folder):
        return files
    index = spark.read.parquet(folder)
    known = {r.file for r in index.select("file").distinct().collect()}
    sizes = index.select("bits").distinct()  # a power of two each: a few dozen rows at most
    own = batch.select(*keys).distinct().select(F.struct(*keys).alias("key"), _hash(keys).alias("h"))
    block, bit = _slots(F.col("bits"), F.col("h"))
    bits = sizes.agg(F.collect_set("bits")).scalar()
    sought = own.select("key", "h", F.explode(bits).alias("bits")).select("key", "bits", block.alias("block"), bit.alias("bit"))
    hit = sought.join(index, ["bits", "block"]).where(
        (F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high")) & _bit_set(F.col("filter"), F.col("bit")))
    named = {r.file for r in hit.select("file").distinct().collect()}
    return [f for f in files if _same_form(f) in named or _same_form(f) not in known]
