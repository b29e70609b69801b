"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

A document is the set of its distinct ``n``-word shingles (64-bit hashes).  Two
documents link when their Jaccard similarity reaches a threshold; the result is
the component of every document.

1. One pass gives each document its set size and a 128-bit signature of the
   set, and counts all shingles into a sketch of fixed size.  Equal signatures
   are one class, represented by its smallest id: copies meet no further work.
2. A second pass sorts each set by the sketch (rarest first; any common order is
   exact) and hands on a prefix.  Sets of x and y tokens that link at threshold t
   share at least a = ceil(t (x + y) / (1 + t)) tokens, so the first L of these
   lie among the first ``x - a + L`` of the one and ``y - a + L`` of the other.
   A document picks the L whose estimated cost (tokens handed on, rows met, and
   candidates, which drop as 1 / L) is lowest, and a pair is a candidate if it
   shares min(L, L') tokens of the prefixes that belong to that number.
3. Tokens in the prefix of one document only are dropped.  In pivot rounds each
   token's documents are compared with one of them, which takes linearly many
   pairs and joins most of a large group of near copies.  The first pivots are
   the documents with most exact copies, then those with the fewest tokens of their
   own, which near copies most often stem from; further rounds choose by hash.  Only
   pairs that share a token within the prefixes of their two sizes are verified.
4. Tokens whose documents are still in different components and make many pairs
   are dealt by size bands: sizes fall into sixteen bands an octave, and a document enters one
   bucket of a token for every band its partners' sizes may lie in, if the token
   lies within the prefix that partners of that band call for.  Near copies of
   one length whose own rare tokens exceed that prefix never meet.
5. The rest is exact: in buckets that hold documents of different components,
   those outside the bucket's largest component meet all documents of the other
   side.  Pairs inside one component are left out (they cannot change it), pairs
   with too few shared prefix tokens too, and pairs that cannot reach the
   threshold because too few tokens lie behind the last shared one.  What remains
   is verified on whole sets.

All steps are joins and aggregations; broadcast are the sketch and a bitmap of
candidate ids, both of fixed size, and they affect cost, not results.
Intermediate tables are deleted as soon as the next ones are written.

Defined cases: a text without words has the empty set, links with nothing and
is its own component; with fewer words than ``n`` the whole sequence is the one
shingle; rows of one id are one document and share its component; a null id
gets its set size and a null component; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import discard, slices, written
from tillscope.llm.components import components

SKETCH_BITS, SKETCH_BLOCK = 24, 1 << 16
SKETCH_SALTS = 8
STEP_CHARS = 1_000_000  #: of text worked on at once, at least one document
BITMAP_BITS = 23
MET_COST = 2.0  #: of a row met in a bucket, in tokens handed on
PAIR_COST = 8.0  #: of a candidate pair, in tokens handed on
BANDS = 16  #: of sizes, an octave
LIGHT = 256  #: pairs of a token that are met without dealing it by bands; changes cost only
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD[1]
    h = (h ^ (h >> np.uint64(29))) * _ODD[3]
    return h ^ (h >> np.uint64(32))


class Shingler(dict):
    """Word to a code; the words' hashes by code.  Starts afresh after ``LIMIT`` words."""

    LIMIT = 150_000

    def __init__(self, n: int):
        if not 1 <= n <= len(_ODD):
            raise ValueError(f"n must be 1 to {len(_ODD)}")
        self.n, self.hashes = n, array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return code

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text."""
        if len(self) > self.LIMIT:
            self.clear()
            self.hashes = array("Q")
        codes, sizes = [], []
        for text in texts:
            words = text.encode().lower().split() if text else ()
            sizes.append(len(words))
            codes.extend(map(self.__getitem__, words))
        own = np.frombuffer(self.hashes, np.uint64) if len(self.hashes) else np.zeros(0, np.uint64)
        h = own[np.array(codes, np.int64)] if codes else np.zeros(0, np.uint64)
        m = max(0, len(h) - self.n + 1)
        grams = np.zeros(m, np.uint64)
        for k in range(self.n):
            grams += h[k : k + m] * _ODD[k]
        grams = _mix(grams)
        out, at = [], 0
        for size in sizes:
            if size >= self.n:
                out.append(np.unique(grams[at : at + size - self.n + 1]))
            elif size:
                short = h[at : at + size]
                out.append(_mix(np.atleast_1d((short * _ODD[:size]).sum(dtype=np.uint64) + np.uint64(size))))
            else:
                out.append(grams[:0])
            at += size
        return out


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def _signatures(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, size, signature) of every row, and the sketch of all shingles."""
    names = ["doc_id", "size", "signature", "block", "data"]

    def run(batches):
        shingler, sketch = Shingler(n), np.zeros(1 << SKETCH_BITS, np.uint16)
        for batch in batches:
            for part in slices(batch, "text", STEP_CHARS):
                sets = shingler.sets(part["text"].to_pylist())
                signs = [np.array([s.sum(dtype=np.uint64), _mix(s + _ODD[2]).sum(dtype=np.uint64)], np.uint64).tobytes() for s in sets]
                at, often = np.unique(np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS), return_counts=True)
                sketch[at] = np.minimum(sketch[at].astype(np.int64) + often, 0xFFFF)
                rows = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(signs, pa.binary()),
                     pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        blocks = sketch.reshape(-1, SKETCH_BLOCK)
        used = np.flatnonzero(blocks.any(1)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()),
             pa.array(used, pa.int32()), pa.array([zlib.compress(blocks[i].tobytes(), 1) for i in used], pa.binary())], names)

    both = written(docs.mapInArrow(run, "doc_id long, size long, signature binary, block int, data binary"), "signatures")
    return both.where("block is null").select("doc_id", "size", "signature"), _summed(both.where("block is not null"))


def _summed(parts: DataFrame) -> np.ndarray:
    """The tasks' sketches added up, on a scale of eighths of a power of two (one byte a counter).

    Blocks are added in streams, first by (block, salt), then by block, so a
    task holds a few blocks however many there are; the driver gets the result.
    """
    def add(kind, last):
        def run(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, data in zip(batch["block"].to_pylist(), batch["data"].to_pylist(), strict=True):
                    values = np.frombuffer(zlib.decompress(data), kind)
                    sums[block] = sums[block] + values if block in sums else values.astype(np.int64)
            scaled = lambda v: np.minimum(255, np.round(8 * np.log2(1 + v))).astype(np.uint8) if last else v
            yield pa.RecordBatch.from_pydict(
                {"block": list(sums), "data": [zlib.compress(scaled(v).tobytes(), 1) for v in sums.values()]},
                schema=pa.schema([("block", pa.int32()), ("data", pa.binary())]))
        return run

    dealt = parts.select("block", "data", (F.spark_partition_id() % SKETCH_SALTS).alias("salt")).repartition("block", "salt")
    some = dealt.select("block", "data").mapInArrow(add("<u2", False), "block int, data binary")
    whole = some.repartition("block").mapInArrow(add("<i8", True), "block int, data binary")
    sketch = np.zeros(((1 << SKETCH_BITS) // SKETCH_BLOCK, SKETCH_BLOCK), np.uint8)
    for row in whole.collect():  # 2^SKETCH_BITS bytes
        sketch[row.block] = np.frombuffer(zlib.decompress(bytes(row.data)), np.uint8)
    return sketch.reshape(-1)


def sketch_counts(scaled: np.ndarray) -> np.ndarray:
    return np.exp2(scaled / 8.0) - 1


def prefix_length(size, matches, share: int):
    """Tokens among which a linked set shares ``matches`` at least; numbers, arrays or columns."""
    return size - -(-share * size // 100) + matches


def choose_matches(cost: np.ndarray, size: int, share: int) -> int:
    """The number of shared prefix tokens to ask for; ``cost``: estimated bucket sizes of all tokens in prefix order.

    Rows met are those of the prefix for partners of about the same size, where large groups of near copies lie.
    """
    needed = -(-share * size // 100)
    alike = -(-2 * share * size // (100 + share))
    matches = np.arange(1, needed + 1)
    met = np.cumsum(cost)[np.minimum(size - alike + matches, size) - 1]
    return int(np.argmin(size - needed + matches + MET_COST * met + PAIR_COST * met / matches)) + 1


def _prefix_tokens(docs: DataFrame, sketch: np.ndarray, n: int, share: int) -> DataFrame:
    """(token, doc_id, size, place, matches, lone) of every row's prefix; ``lone``: its tokens that no other document seems to hold."""
    noise = float(np.median(sketch_counts(sketch[: 1 << 20])))
    noise += 2 * np.sqrt(noise) + 1  # what a counter holds besides, and the document itself
    sent = docs.sparkSession.sparkContext.broadcast(sketch)  # 2^SKETCH_BITS counters

    def run(batches):
        shingler, counts = Shingler(n), sent.value
        for batch in batches:
            for part in slices(batch, "text", STEP_CHARS):
                out: list[tuple] = []
                for doc_id, tokens in zip(part["doc_id"].to_pylist(), shingler.sets(part["text"].to_pylist()), strict=True):
                    size = len(tokens)
                    if not size or doc_id is None:
                        continue
                    often = counts[tokens >> np.uint64(64 - SKETCH_BITS)]
                    order = np.lexsort((tokens, often))
                    cost = np.maximum(sketch_counts(often[order]) - noise, 0)
                    matches = choose_matches(cost, size, share)
                    handed = prefix_length(size, matches, share)
                    chosen = tokens[order[:handed]].view(np.int64)
                    out.append((doc_id, size, matches, chosen, int((cost[:handed] == 0).sum())))
                if not out:
                    continue
                lengths = [len(x[3]) for x in out]
                repeat = lambda i, kind: pa.array(np.repeat(np.array([x[i] for x in out], kind), lengths))
                place = np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[3] for x in out])), repeat(0, np.int64), repeat(1, np.int32), pa.array(place),
                     repeat(2, np.int32), repeat(4, np.int32)], ["token", "doc_id", "size", "place", "matches", "lone"])

    return docs.mapInArrow(run, "token long, doc_id long, size int, place int, matches int, lone int")


def _band(size: Column) -> Column:
    """Number of a size's band: sixteen of equal width in every octave."""
    octave = F.length(F.bin(size)) - 1
    return octave * BANDS + (F.floor(size * BANDS / F.pow(F.lit(2), octave)) - BANDS).cast("int")


def _band_start(band: Column) -> Column:
    """The least size of a band."""
    return F.ceil((BANDS + band % BANDS) * F.pow(F.lit(2), F.floor(band / BANDS)) / BANDS).cast("int")


def _dealt(held: DataFrame, share: int) -> DataFrame:
    """``held`` by (token, bands of the smaller and the larger set) as ``bucket``, without what lies behind a band's prefix.

    ``side``: 0 for the smaller set's band, 1 for the larger one's, 2 if they are the same.
    """
    size = F.col("size").cast("long")
    least, most = F.floor((F.lit(share) * size + 99) / 100), F.floor(size * 100 / share)
    with_bands = held.withColumn("_own", _band(size)).withColumn("_least", least).withColumn(
        "_band", F.explode(F.sequence(_band(least), _band(most))))
    smallest = F.greatest(_band_start(F.col("_band")), F.col("_least"))
    overlap = F.floor((F.lit(share) * (size + smallest) + (100 + share - 1)) / (100 + share))
    side = F.when(F.col("_own") == F.col("_band"), 2).otherwise(F.when(F.col("_own") < F.col("_band"), 0).otherwise(1))
    return with_bands.select(
        F.xxhash64("token", F.least("_own", "_band"), F.greatest("_own", "_band")).alias("bucket"),
        "doc_id", "size", "place", "matches", "label", side.alias("side"), (size - overlap + F.col("matches") > F.col("place")).alias("_in"),
    ).where("_in").drop("_in")


def _sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, tokens) of the documents in ``ids``; a bitmap of the ids keeps most others from leaving their task."""
    slot = F.col("doc_id").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = (  # 2^BITMAP_BITS / 32 rows at most
        ids.select(F.shiftright(slot, 5).alias("word"), slot.bitwiseAND(F.lit(31)).cast("int").alias("bit")).distinct()
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for row in words:
        bitmap[row.word] = row.bits
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        shingler, bits = Shingler(n), sent.value
        for batch in batches:
            own = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False) & ((1 << BITMAP_BITS) - 1)
            hit = (bits[own >> 5] >> (own & 31).astype(np.uint32)) & 1 == 1
            wanted = batch.filter(pa.array(hit & ~batch["doc_id"].is_null().to_numpy(zero_copy_only=False)))
            for part in slices(wanted, "text", STEP_CHARS):
                sets = shingler.sets(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "tokens"])

    found = docs.mapInArrow(run, "doc_id long, tokens array<long>")
    return written(found.join(ids, "doc_id", "left_semi").distinct(), "sets")  # rows of one id and text are one set


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("set_a"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(a, "a").join(b, "b").select(
        "a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    return written(both.where(100 * F.col("common") >= share * (F.col("sizes") - F.col("common"))).select("a", "b"), "links")


def _can_link(common: Column, a: Column, b: Column, share: int) -> Column:
    """Whether sets of ``a`` and ``b`` tokens that share ``common`` at most may reach the threshold."""
    return 100 * common >= share * (a + b - common)


def _several(held: DataFrame) -> DataFrame:
    """``held`` without the tokens that one document holds alone."""
    several = written(held.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("token"), "several")
    kept = written(held.join(several, "token"), "entries")
    discard(several)
    return kept


def _as(side: str, *columns: str) -> list[Column]:
    return [F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "size", "place", "matches", "label", *columns)]


def _worth(met: DataFrame, share: int, all_shared: bool = True) -> DataFrame:
    """(a, b) of the rows met (entries _a and _b of a shared token) that share as many prefix tokens as both ask for and may reach the threshold.

    With ``all_shared``, ``met`` holds a row for every token that a pair shares
    within its prefixes; otherwise some of them, so that counts bound nothing
    and every pair met within its prefixes is worth it.
    """
    asked = F.least("matches_a", "matches_b")
    sizes = (F.col("size_a") + F.col("size_b")).cast("long")
    overlap = F.floor((F.lit(share) * sizes + (100 + share - 1)) / (100 + share))
    # within the prefixes that these two sizes call for: at most those of their bands
    inside = (F.col("size_a") - overlap + asked > F.col("place_a")) & (F.col("size_b") - overlap + asked > F.col("place_b"))
    fitting = met.where(
        (F.col("label_a") != F.col("label_b")) & inside
        & _can_link(F.least("size_a", "size_b"), F.col("size_a"), F.col("size_b"), share))
    if not all_shared:
        return fitting.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()
    pairs = fitting.groupBy(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).agg(
        F.count(F.lit(1)).alias("common"), F.max(asked).alias("asked"), F.max("size_a").alias("x"), F.max("size_b").alias("y"),
        F.least(F.min(F.col("size_a") - F.col("place_a")), F.min(F.col("size_b") - F.col("place_b"))).alias("behind"))
    # what lies behind the last shared token of either set, and the shared tokens up to it
    return pairs.where(
        (F.col("common") >= F.col("asked")) & _can_link(F.col("common") + F.col("behind") - 1, F.col("x"), F.col("y"), share)
    ).select("a", "b")


def _pivot_pairs(entries: DataFrame, round_: int, share: int) -> DataFrame:
    """Pairs of every document with the pivots of its tokens: most copies, then fewest tokens of its own; in later rounds by hash.

    A rank is a document's, not a token's, so that one document is the pivot of
    most tokens of its group.
    """
    hashed = F.xxhash64(F.lit(round_), "doc_id")
    rank = hashed if round_ else F.struct((-F.col("copies")).alias("c"), "lone", hashed.alias("h"))
    entry = F.struct(rank.alias("rank"), *[F.col(c) for c in ("doc_id", "size", "place", "matches", "label")])
    pivots = written(
        entries.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(entry).alias("pivot"))
        .where("low < high").select("token", "pivot.*").select("token", *_as("b")), "pivots")
    pairs = written(_worth(entries.select("token", *_as("a")).join(pivots, "token"), share, all_shared=False), "pairs")
    discard(pivots)
    return pairs


def _rest_pairs(entries: DataFrame, share: int) -> DataFrame:
    """Pairs of different components: those outside a bucket's largest component with all of the bucket's other side."""
    counted = entries.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.count(F.lit(1)).alias("kinds"))
    unlike = counted.where("kinds > 1").select("token", ((F.col("n") - F.col("most")) * F.col("n") > LIGHT).alias("heavy"))
    open_ = written(entries.join(unlike, "token"), "open")
    whole = open_.where("not heavy").select(F.xxhash64("token").alias("bucket"), "doc_id", "size", "place", "matches", "label", F.lit(2).alias("side"))
    dealt = written(_dealt(open_.where("heavy"), share).unionByName(whole), "dealt")
    discard(open_)
    per_label = dealt.groupBy("bucket", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min("side").alias("least"), F.max("side").alias("most"))
    major = written(
        per_label.groupBy("bucket").agg(
            F.max(F.struct("n", "label")).alias("first"), F.count(F.lit(1)).alias("kinds"), F.min("least").alias("least"), F.max("most").alias("most"))
        .where("kinds > 1 and (most = 2 or least < most)").select("bucket", F.col("first.label").alias("major")), "major")
    mixed = written(dealt.join(major, "bucket").withColumn("minor", F.col("label") != F.col("major")), "mixed")
    other = F.when(F.col("side") == 2, 2).otherwise(1 - F.col("side"))
    minor = mixed.where("minor").select("bucket", other.alias("meets"), *_as("a"))
    partners = mixed.select("bucket", F.col("side").alias("meets"), *_as("b", "minor"))
    met = minor.join(partners, ["bucket", "meets"]).where(~F.col("minor_b") | (F.col("doc_id_a") < F.col("doc_id_b")))
    pairs = written(_worth(met, share), "pairs")
    discard(dealt, major, mixed)
    return pairs


def find_links(docs: DataFrame, representatives: DataFrame, sketch: np.ndarray, n: int, share: int, pivot_rounds: int = 1) -> DataFrame:
    """Links (a, b) between representatives (``doc_id``, ``copies``) that join every pair at or above the threshold into one component."""
    tokens = written(_prefix_tokens(docs, sketch, n, share), "tokens")
    several = written(
        tokens.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("token"),
        "several")
    held = written(tokens.join(several, "token").join(representatives, "doc_id").distinct(), "held")  # rows of one id and text are one
    discard(tokens, several)
    entries = _several(held)
    discard(held)
    links = checked = None
    for k in range(pivot_rounds + 1):
        labels = None
        if links is None:
            labelled = entries.withColumn("label", F.col("doc_id"))
        else:
            labels = components(links)
            labelled = entries.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        found = _pivot_pairs(labelled, k, share) if k < pivot_rounds else _rest_pairs(labelled, share)
        discard(labels)
        pairs = found if checked is None else written(found.join(checked, ["a", "b"], "left_anti"), "pairs")
        ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        sets = _sets_of(docs, ids, n)
        new = _verified(pairs, sets, share)
        discard(sets)
        if links is None:
            links, checked = new, pairs
        else:
            all_links, all_checked = written(links.union(new), "links"), written(checked.union(pairs), "checked")
            discard(links, new, found, pairs, checked)
            links, checked = all_links, all_checked
    discard(entries, checked)
    return links


def near_duplicates(docs: DataFrame, n: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest linked id) of each row.

    Documents link when 100 * intersection >= ``share`` * union of their sets
    of ``n``-word shingles.
    """
    texts = _texts(docs, id_col, text_col)
    rows, sketch = _signatures(texts, n)
    classes = written(
        rows.where("size > 0 and doc_id is not null").groupBy("size", "signature")
        .agg(F.min("doc_id").alias("representative"), F.count(F.lit(1)).alias("copies")), "classes")
    representatives = classes.groupBy(F.col("representative").alias("doc_id")).agg(F.max("copies").alias("copies"))
    links = find_links(texts, representatives, sketch, n, share)
    several = (  # ids whose rows have different sets: their classes belong together
        rows.where("size > 0 and doc_id is not null").groupBy("doc_id")
        .agg(F.min(F.struct("size", "signature")).alias("x"), F.max(F.struct("size", "signature")).alias("y")).where("x <> y").select("doc_id"))
    versions = rows.join(several, "doc_id", "left_semi").join(classes, ["size", "signature"]).select("doc_id", "representative")
    same_id = versions.join(versions.groupBy("doc_id").agg(F.min("representative").alias("b")), "doc_id").select(
        F.col("representative").alias("a"), "b")
    labels = components(links.union(same_id))
    of_class = written(
        classes.join(labels, classes["representative"] == labels["node"], "left")
        .select("size", "signature", F.coalesce("label", "representative").alias("component_id")), "classes")
    found = rows.join(of_class, ["size", "signature"], "left")
    return found.select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
