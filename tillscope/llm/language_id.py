"""Language identification by compression.

For every language a raw-content zstandard dictionary is made from excerpts of
its labelled documents; a text belongs to the language whose dictionary
compresses it to the fewest bytes.  Texts are lower-cased and reduced to
letters first and compressed in blocks of ``BLOCK`` bytes, each against the
dictionary alone, so that a long text does not become its own dictionary.  A
prediction whose runner-up is hardly larger (relative margin below
``min_margin``) is marked ``rejected``; its best guess stays in ``lang_pred``.

The dictionaries are the only thing learned: ``docs_per_lang`` documents a
language at most (those with the smallest hash of their id in each of
``HASH_CLASSES`` classes, so that no task ranks a whole language), ``EXCERPT``
characters of each, ``DICT_BYTES`` bytes a language at most (the rest is cut in
the order of the hashes, so with full excerpts of one-byte letters about 55
documents enter a dictionary).  They are built in the driver
and broadcast; ``MAX_LANGS`` languages at most are accepted, more raise.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected; ties go to the language with more of the sampled rows, then by name;
null languages teach nothing; without any labelled row everything is ``und``.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import slices

DICT_BYTES, EXCERPT, BLOCK, MAX_LANGS = 110_000, 2_000, 4_000, 1_000
HASH_CLASSES = 40
UNKNOWN = "und"
_RESULT = "doc_id long, lang_pred string, score double, margin double, rejected boolean"
_not_letters = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> str:
    return _not_letters.sub(" ", text.lower())


def learn_dictionaries(
    labelled: DataFrame, docs_per_lang: int = 400, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, bytes]:
    """Language to dictionary content, from a bounded sample."""
    rows = labelled.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).where("lang is not null and text is not null")
    by_hash = Window.partitionBy("lang", "class").orderBy("hash", "doc_id")
    each = -(-docs_per_lang // HASH_CLASSES)
    chosen = (
        rows.select("doc_id", "lang").distinct().withColumn("hash", F.xxhash64("doc_id"))
        .withColumn("class", F.pmod(F.xxhash64(F.lit("class"), "doc_id"), F.lit(HASH_CLASSES)))
        .withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= each).select("doc_id", "lang", "hash")
    )
    langs = rows.select("lang").distinct().limit(MAX_LANGS + 1).count()
    if langs > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    excerpts = (  # of an id with several rows one text: docs_per_lang x MAX_LANGS narrow rows at most
        rows.join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("doc_id", "lang", "hash").agg(F.min(F.substring("text", 1, EXCERPT)).alias("text"))
        .select("lang", "hash", "text").collect()
    )
    parts: dict[str, list[str]] = {}
    for row in sorted(excerpts, key=lambda r: (r.lang, r.hash, r.text)):
        parts.setdefault(row.lang, []).append(letters_only(row.text))
    order = sorted(parts, key=lambda x: (-len(parts[x]), x))
    return {lang: " ".join(dict.fromkeys(parts[lang])).encode()[:DICT_BYTES] for lang in order}


def _compressors(dictionaries: dict[str, bytes]):
    import zstandard as z

    out = []
    for content in dictionaries.values():
        params = z.ZstdCompressionParameters.from_level(
            6, min_match=3, strategy=z.STRATEGY_LAZY, window_log=17, hash_log=16, chain_log=17, search_log=3,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        if len(content) < 8:  # too short for a dictionary
            out.append(z.ZstdCompressor(compression_params=params).compress)
            continue
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append(z.ZstdCompressor(dict_data=d, compression_params=params).compress)
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], min_margin: float):
        import regex

        self.langs, self.compress, self.min_margin = list(dictionaries), _compressors(dictionaries), min_margin
        self.letter = regex.compile(r"\p{L}").search

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, relative margin to the runner-up, rejected."""
        if not text or not self.langs or not self.letter(text):
            return UNKNOWN, 0.0, 0.0, True
        raw = letters_only(text).encode()
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = [sum(len(c(b)) for b in blocks) for c in self.compress]
        best = min(sizes)
        score = 1 / sum(math.exp((best - s) / 2) for s in sizes)
        rest = sorted(sizes)[1] if len(sizes) > 1 else 2 * best
        margin = (rest - best) / rest
        return self.langs[sizes.index(best)], score, margin, margin < self.min_margin


def predict_language(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``margin``, ``rejected`` for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # DICT_BYTES a language

    def run(batches):
        predict = Classifier(sent.value, min_margin).predict
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, margin, rejected = zip(*map(predict, part["text"].to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(lang), pa.array(score, pa.float64()), pa.array(margin, pa.float64()),
                     pa.array(rejected)], ["doc_id", "lang_pred", "score", "margin", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _RESULT)
