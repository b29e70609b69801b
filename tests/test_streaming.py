"""Streaming insert-if-absent load: a replayed feed adds nothing."""

import random
import tempfile

from pyspark.sql import functions as F

from star_tables import SMOKE
from tillscope.streaming.incremental import start_idempotent_load


def test_replayed_feed_is_idempotent(spark):
    work = tempfile.mkdtemp(prefix="tillscope-stream-", dir="/tmp")
    src = spark.read.parquet(f"{SMOKE}/orders.parquet")
    src.where(F.col("o_orderkey") % 2 == 0).write.parquet(f"{work}/in/part=a")
    schema = src.schema
    target = f"{work}/out"
    for run in range(2):
        if run == 1:  # a second file re-delivers every row, plus the rest
            src.write.parquet(f"{work}/in/part=b")
        stream = spark.readStream.schema(schema).parquet(f"{work}/in")
        q = start_idempotent_load(stream, target, ["o_orderkey"], f"{work}/ckpt", trigger={"availableNow": True})
        q.awaitTermination(300)
    out = spark.read.parquet(target)
    assert out.count() == src.count()
    assert out.select("o_orderkey").distinct().count() == src.count()


def _stored(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_append_equals_insert_new_and_skips_files(spark, tmp_path):
    from tillscope.operators.maintenance import insert_new
    from tillscope.streaming.incremental import append_absent

    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "k long, s string, v int")
    table = frame([])
    rnd = random.Random(3)
    read = []
    for start in (0, 1000, 2000, 3000):
        rows = [(start + i, "ab"[i % 2], rnd.randrange(9)) for i in range(400)]
        rows += [(start + 5, "b", 1), (start + 5, "b", 0), (start + 5, "b", 0)]  # ties within the batch
        batch = frame(rows).coalesce(1)
        read.append(append_absent(batch, path, ["k", "s"]))
        table = insert_new(table, batch, ["k", "s"])
        assert _stored(spark, path) == sorted(tuple(r) for r in table.collect())
    assert read == [[], [], [], []]  # key ranges do not meet: nothing stored was read
    again = frame([(1005, "b", 7), (1006, "a", 7), (1006, "z", 7), (1007, "b", 7)])
    files = spark.read.parquet(path).inputFiles()
    read = append_absent(again, path, ["k", "s"])
    assert 0 < len(read) < len(files)
    table = insert_new(table, again, ["k", "s"])
    assert _stored(spark, path) == sorted(tuple(r) for r in table.collect())


def test_filter_skips_files_whose_range_holds_the_key(spark, tmp_path):
    from tillscope.streaming.incremental import append_absent
    from tillscope.streaming.key_index import files_that_may_hold

    path = str(tmp_path / "t")
    for part in range(4):  # every file spans the whole range
        append_absent(spark.range(part, 4000, 4).withColumn("v", F.lit(part)).coalesce(1), path, ["id"])
    files = spark.read.parquet(path).inputFiles()
    owner = {r.id: r.f for r in spark.read.parquet(path).select("id", F.col("_metadata.file_path").alias("f")).collect()}
    seen = [files_that_may_hold(spark.createDataFrame([(k,)], "id long"), path, ["id"], files) for k in (7, 1234, 3999)]
    for k, named in zip((7, 1234, 3999), seen, strict=True):
        assert owner[k].rsplit("/", 1)[1] in {f.rsplit("/", 1)[1] for f in named}
    assert min(len(named) for named in seen) < len(files)


def test_unindexed_files_are_read(spark, tmp_path):
    from tillscope.streaming.incremental import append_absent

    path = str(tmp_path / "t")
    append_absent(spark.range(10).coalesce(1), path, ["id"])
    spark.range(100, 110).coalesce(1).write.mode("append").parquet(path)  # written by others
    read = append_absent(spark.range(105, 112).coalesce(1), path, ["id"])
    assert len(read) == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [*range(10), *range(100, 112)]


def test_null_keys_conflict_with_nothing(spark, tmp_path):
    from tillscope.streaming.incremental import append_absent

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "k long, v int")
    for _ in range(2):
        append_absent(rows, path, ["k"])
    assert sorted(map(str, _stored_any(spark, path))) == sorted(map(str, [(None, 1)] * 4 + [(2, 1)]))


def _stored_any(spark, path):
    return [tuple(r) for r in spark.read.parquet(path).collect()]
