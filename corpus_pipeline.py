"""A corpus pipeline of five stages: toxicity, quality, near duplicates, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

* toxicity: documents that the classifier rejects go (it learns from the labels
  outside the held-out third).
* quality: documents that fail the base rules or lie far outside their
  language's and source's statistics go.
* near_duplicates: of every group of documents linked at a similarity of 0.8 on
  five-word shingles, the one with the smallest id stays.  Groups are of texts,
  not of ids: different texts under one id are documents of their own.  Rows
  without an id come last in their group; rows without a word are in no group
  and stay.
* secrets: every finding is replaced by a mark, ``n_chars`` follows.
* packing: token sequences of 2048.

Rows travel as one struct, so columns of any name pass through unchanged.  Texts
that are null pass the toxicity stage and fail the quality rules; empty tables
give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import ngram_join, packing, quality_rules, secret_scan, toxicity
from tillscope.llm.common import WORD_CLASS, crc_mod, discard, read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(docs, labels)
    packed = docs.select(F.struct("*").alias("row"), "text")
    return toxicity.score(packed, model, ["row"]).where("not rejected").select("row.*")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang", "source", F.xxhash64("text", "lang", "source").alias("key"))
    verdicts = quality_rules.judge(packed, ["doc_id", "key"])
    rejected = verdicts.where("not kept").select(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key")).distinct()
    same = packed["doc_id"].eqNullSafe(rejected["r_id"]) & (packed["key"] == rejected["r_key"])
    return packed.join(rejected.hint("shuffle_hash"), same, "left_anti").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    packed = packed.withColumn("key", F.xxhash64("text")).withColumn("tie", F.xxhash64("row"))
    words = F.rlike(F.coalesce("text", F.lit("")), F.lit(WORD_CLASS))
    worded = packed.where(words)
    groups = ngram_join.near_duplicates(worded.select("key", "text"), n=5, share=80, id_col="key")
    of_key = groups.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("group"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "key")
    first_of_key = worded.groupBy("key").agg(F.min(rank).alias("first"))
    firsts = first_of_key.join(of_key, "key").groupBy("group").agg(F.min("first").alias("first")).select("first.key", "first.tie")
    one = worded.join(firsts, ["key", "tie"], "left_semi").groupBy("key", "tie").agg(F.first("row").alias("row"))
    return one.select("row.*").unionByName(packed.where(~words).select("row.*"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    paths, ledger = secret_scan.scan(docs)
    found = secret_scan.findings_of(paths.select("blob", F.col("blob").alias("path")).distinct(), ledger)
    found = found.where(F.size("findings") > 0).select("blob", "findings")
    packed = docs.select(F.struct("*").alias("row"), secret_scan.address(F.col("text")).alias("blob"))
    text = F.col("row").getField("text")
    clean = F.when(F.col("findings").isNull(), text).otherwise(secret_scan.redact(text, F.col("findings")))
    joined = packed.join(found, "blob", "left").select("row", "findings", clean.alias("clean"))
    length = F.when(F.col("findings").isNull(), F.col("row").getField("n_chars")).otherwise(F.length("clean").cast("long"))
    changed = {"text": F.col("clean"), "n_chars": length}
    return joined.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the covariance estimates; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = written(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)
        docs = done
    return docs
