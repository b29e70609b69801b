"""Language model scoring: a hashed maximum-entropy model over word classes and the words inside them.

P(word | history) = P(class | history) * P(word | class, history).  The first
factor is a softmax over ``CLASSES`` classes (the end of a text, and hashes of a
word's last two bytes) whose logits add a bias and one row of a hashed weight
table for each feature of the history: the previous word, the pair of words
before, and the word before the previous one alone (a skip).

The second factor is a maximum-entropy choice too: the words of a class hang on
a binary tree by the first bits of their hash, four leaves a word or more as long
as ``MOST_BITS`` allow, and each node on a word's path is a logistic choice from
the same three features, whose hashed cells depend on the node.  A node's bias
is the log-odds of the training counts (plus one) below it, so that untrained
cells give the counts' shares.  Words that share a leaf are told apart by their
training count plus one over the leaf's; the share of one unseen word in every
class is dealt evenly over its leaves.

Training: counts are gathered over all training texts (tasks count their own
words first).  Both factors are trained by synchronous distributed updates: the
training texts are dealt into ``rounds`` by a hash of their id, and in each
round every task computes the gradient of its texts of that round, blocks of
gradients are summed across tasks, and the driver takes one diagonally scaled
step.  The weight tables' sizes are fixed by parameters, and so is what a task
hands on, so a round has a task for every ``TASK_TOKENS`` tokens at most.

Scoring: counts of the most frequent words, ``head`` at most, are broadcast; all other words of a text leave the task as (text, word, times) rows
and meet their counts in a join, so any vocabulary size is exact.

Texts are read in blocks of about ``BLOCK_BYTES`` and handled in numpy chunks of
``CHUNK`` tokens, which stay in a core's cache; words are split, hashed and
found among the head words in whole columns, a byte of all words at a time.

Defined cases: a null or empty text is the end token alone; a null id is in no
fold but that of the empty id text; repeated rows are scored each; without
training rows every count is zero and the classes are uniform.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from tillscope.llm.common import crc_mod, slices, summed_blocks, written
from tillscope.llm.word_columns import crc32s, same_words, spans

CLASSES = 25
PAIRS = (CLASSES + 1) // 2
ROWS = 1 << 14
MOST_BITS = 14  #: levels of a class's tree at most
CELLS = 1 << 14  #: weights of one feature on one level of the trees
CHUNK = 1 << 14
SUM_ITEMS = 1 << 16  #: numbers in one block of summed gradients
BLOCK_BYTES = 2_000_000
TASK_WORDS = 400_000  #: words a task counts before it hands them on
TASK_TOKENS = 1_000_000  #: tokens of a round for each task that hands on a gradient of fixed size
END = b""  #: no word is empty
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space; ``bytes`` methods do exactly that."""
    return text.encode().lower().split() if text else []


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % (CLASSES - 1) + 1 if word else 0


@dataclass
class Trees:
    """The words inside the classes: nodes are numbered class * 2^bits + 2^level + the path's first bits."""

    bits: int
    bias: np.ndarray  #: log-odds of the right side, by node
    leaf_mass: np.ndarray  #: counts plus one and unseen shares, by class * 2^bits + path
    cells: np.ndarray  #: weights by (level, feature, hash)


@dataclass
class Model:
    weights: np.ndarray
    bias: np.ndarray
    trees: Trees
    head: Head
    tokens: int  #: N
    kinds: int  #: V
    class_total: np.ndarray


@dataclass
class Tokens:
    """A block's tokens: two starts before and one end after the words of each text."""

    data: bytes  #: the texts, A-Z lower-cased, a space after each
    starts: np.ndarray  #: of each word in ``data``
    lengths: np.ndarray
    places: np.ndarray  #: of each word among the tokens
    firsts: np.ndarray  #: each text's first word, and the number of words
    hashes: np.ndarray  #: by token
    classes: np.ndarray


_KINDS = (~np.isin(np.arange(256), list(b" \t\n\v\f\r"))).astype(np.uint8)
_CUTS = np.array([[False, True], [True, False]])


def _classes(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``class_of`` each word; none is empty."""
    width = np.minimum(lengths, 2)
    return (crc32s(data, starts + lengths - width, width) % np.uint32(CLASSES - 1) + np.uint32(1)).astype(np.int32)


class Head:
    """Counts of the most frequent words, found by their hash and compared byte by byte."""

    def __init__(self, words: list[bytes], counts: list[int], end: int):
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        self.data, self.end = b"".join(words), end
        hashes = crc32s(self.data, starts, lengths)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.lengths, self.counts = hashes[order], starts[order], lengths[order], np.array(counts, np.int64)[order]
        self.bits = max(1, len(words).bit_length())
        slots = np.arange((1 << self.bits) + 1, dtype=np.int64) << (32 - self.bits)
        self.slots = np.searchsorted(self.hashes.astype(np.int64), slots).astype(np.int32)

    def look_up(self, data: bytes, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Each word's count, -1 where the head doesn't hold it."""
        out = np.full(len(starts), -1, np.int64)
        slot = (hashes >> np.uint32(32 - self.bits)).astype(np.int64)
        at, stop = self.slots.take(slot), self.slots.take(slot + 1)
        open_ = np.flatnonzero(at < stop)
        at, stop = at[open_], stop[open_]
        while len(open_):
            maybe = np.flatnonzero((self.hashes.take(at) == hashes[open_]) & (self.lengths.take(at) == lengths[open_]))
            own = open_[maybe]
            maybe = maybe[same_words(self.data, self.starts[at[maybe]], data, starts[own], lengths[own])]
            out[open_[maybe]] = self.counts.take(at[maybe])
            at += 1
            left = at < stop
            left[maybe] = False
            open_, at, stop = open_[left], at[left], stop[left]
        return out


class Vocabulary:
    """Tokens of texts, and their counts in the head."""

    def __init__(self, head: Head | dict[bytes, int]):
        if isinstance(head, dict):
            words = [w for w in head if w]
            head = Head(words, [head[w] for w in words], head.get(END, 0))
        self.head = head

    def codes(self, texts: list[str | None]) -> tuple[Tokens, np.ndarray]:
        """The tokens, and how many each text has without its starts."""
        data, starts, lengths, firsts = spans(texts, _KINDS, _CUTS)
        words = np.diff(firsts)
        ends = np.cumsum(words + 3) - 1
        places = np.arange(len(starts)) + np.repeat(3 * np.arange(len(texts)) + 2, words)
        hashes = np.full(len(starts) + 3 * len(texts), zlib.crc32(b" "), np.uint32)  # a word that no text holds
        classes = np.zeros(len(hashes), np.int32)
        hashes[places], hashes[ends] = crc32s(data, starts, lengths), zlib.crc32(END)
        classes[places], classes[ends] = _classes(data, starts, lengths), class_of(END)
        return Tokens(data, starts, lengths, places, firsts, hashes, classes), words + 1

    def counts(self, tokens: Tokens) -> np.ndarray:
        """Count by token, -1 for words outside the head."""
        out = np.full(len(tokens.hashes), self.head.end, np.int64)
        out[tokens.places] = self.head.look_up(tokens.data, tokens.starts, tokens.lengths, tokens.hashes[tokens.places])
        return out


def _features(tokens: Tokens, sizes: np.ndarray):
    """Positions of real tokens and the hashes of the three features of each."""
    hashes = tokens.hashes
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    real = np.ones(len(hashes), bool)
    real[starts] = real[starts + 1] = False
    at = np.flatnonzero(real)
    one, two = hashes[at - 1], hashes[at - 2]
    return at, [
        one * np.uint32(_MIX[0]),
        ((two * np.uint32(_MIX[1])) ^ (one * np.uint32(_MIX[2])) * np.uint32(5)) * np.uint32(_MIX[0]),
        two * np.uint32(_MIX[2]),
    ]


def _rows(features: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of the class table."""
    return [h >> np.uint32(32 - ROWS.bit_length() + 1) for h in features]


def _history(vocabulary: Vocabulary, codes: Tokens, sizes: np.ndarray):
    """Positions of real tokens and the three feature rows of each."""
    at, features = _features(codes, sizes)
    return at, _rows(features)


def _softmax(model_weights: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    logits = model_weights.take(rows[0], 0)
    for r in rows[1:]:
        logits += model_weights.take(r, 0)
    logits += bias
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(CLASSES, np.float32))[:, None]
    return logits


def grow_trees(leaves: Iterable[tuple[int, int, int]], bits: int) -> Trees:
    """Untrained trees from (class, path, counts plus one) of every leaf that has words."""
    mass = np.full(CLASSES << bits, 0.5**bits)  # a class's unseen word, dealt over its leaves
    for class_, path, n in leaves:
        mass[(class_ << bits) + path] += n
    bias = np.zeros((CLASSES, 1 << bits), np.float32)
    below = mass.reshape(CLASSES, -1)
    for level in range(bits - 1, -1, -1):
        bias[:, 1 << level : 2 << level] = np.log(below[:, 1::2] / below[:, ::2])
        below = below[:, ::2] + below[:, 1::2]
    return Trees(bits, bias.ravel(), mass, np.zeros(bits * 3 * CELLS, np.float32))


def _choices(trees: Trees, classes: np.ndarray, hashes: np.ndarray, features: list[np.ndarray]):
    """Level by level of the words' paths: the side taken (0 or 1), the logit of side 1 and the features' cells."""
    bits = trees.bits
    path = (hashes >> np.uint32(32 - bits)).astype(np.int32)
    base = classes << bits
    for level in range(bits):
        node = base + (1 << level) + (path >> (bits - level))
        key = node.astype(np.uint32) * np.uint32(_MIX[1])
        cells = [(((h ^ key) * np.uint32(_MIX[0])) >> np.uint32(32 - CELLS.bit_length() + 1)).astype(np.intp) + (3 * level + f) * CELLS
                 for f, h in enumerate(features)]
        logit = trees.bias.take(node)
        for c in cells:
            logit += trees.cells.take(c)
        yield path >> (bits - level - 1) & 1, logit, cells


def _log_inside(trees: Trees, classes: np.ndarray, hashes: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """log10 of P(leaf | class, history) over the leaf's mass: what a word's count plus one is still to be multiplied by."""
    inverse = trees.leaf_mass[(classes << trees.bits) + (hashes >> np.uint32(32 - trees.bits)).astype(np.int32)]
    for side, logit, _ in _choices(trees, classes, hashes, features):
        inverse *= 1.0 + np.exp(np.minimum(np.where(side, -logit, logit), 40)).astype(np.float64)
    return -np.log10(inverse)


def count_words(train: DataFrame) -> DataFrame:
    """``word`` (binary, the end as an empty word), ``class`` and ``n`` over all training texts."""
    def run(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_pydict(
                {"word": list(counts), "class": [class_of(w) for w in counts], "n": list(counts.values())},
                schema=pa.schema([("word", pa.binary()), ("class", pa.int32()), ("n", pa.int64())]))
            counts.clear()
            return out

        for batch in batches:
            for text in batch["text"].to_pylist():
                counts.update(words_of(text))
                counts[END] += 1
                if len(counts) > TASK_WORDS:
                    yield flush()
        yield flush()

    parts = train.select("text").mapInArrow(run, "word binary, class int, n long")
    return parts.groupBy("word", "class").agg(F.sum("n").alias("n"))


def _gradient(docs: DataFrame, weights: np.ndarray, bias: np.ndarray, trees: Trees):
    """Summed over the texts: the class table's gradient and feature counts (rows x (classes + 1), the bias as a
    last row), and the gradient and curvature of the trees' cells (2 x cells)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((weights, bias, trees))
    width, cells = CLASSES + 1, len(trees.cells)
    items = (ROWS + 1) * width + 2 * cells

    def run(batches):
        w, b, t = sent.value
        # two sums lie side by side as one complex number: half as many to place; the classes are padded to even
        expected, places = np.zeros(ROWS * PAIRS, np.complex64), np.arange(PAIRS)
        expected_all, seen = np.zeros(CLASSES), np.zeros(ROWS * CLASSES, np.int64)
        seen_all = np.zeros(CLASSES, np.int64)
        inner = np.zeros(cells, np.complex64)  # gradient and curvature
        vocabulary = Vocabulary({END: 0})
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                codes, sizes = vocabulary.codes(part["text"].to_pylist())
                at, features = _features(codes, sizes)
                classes, hashes = codes.classes[at], codes.hashes[at]
                seen_all += np.bincount(classes, minlength=CLASSES)
                for r in _rows(features):
                    seen += np.bincount(r.astype(np.intp) * CLASSES + classes, minlength=ROWS * CLASSES)
                for a in range(0, len(at), CHUNK):
                    own = [h[a : a + CHUNK] for h in features]
                    rows = _rows(own)
                    p = _softmax(w, b, rows)
                    expected_all += p.sum(0)
                    # made here, not derived from what was sent: numpy adds fast only where types are the very same
                    padded = np.zeros((len(p), 2 * PAIRS), np.float32)
                    padded[:, :CLASSES] = p
                    for r in rows:
                        np.add.at(expected, (r.astype(np.intp)[:, None] * PAIRS + places).ravel(), padded.view(np.complex64).ravel())
                    for side, logit, at_cells in _choices(t, classes[a : a + CHUNK], hashes[a : a + CHUNK], own):
                        right = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
                        both = np.empty(len(right), np.complex64)
                        both.real, both.imag = side - right, right * (1 - right)
                        for c in at_cells:
                            np.add.at(inner, c, both)
        if seen_all.any():
            table = np.empty((ROWS + 1, width), np.float32)
            table[:ROWS, :CLASSES] = seen.reshape(ROWS, CLASSES) - expected.view(np.float32).reshape(ROWS, -1)[:, :CLASSES]
            table[:ROWS, CLASSES] = seen.reshape(ROWS, CLASSES).sum(1)
            table[ROWS, :CLASSES], table[ROWS, CLASSES] = seen_all - expected_all, seen_all.sum()
            flat = np.concatenate([table.ravel(), inner.real, inner.imag, np.zeros(-items % SUM_ITEMS, np.float32)])
            blocks = [flat[a : a + SUM_ITEMS].tobytes() for a in range(0, len(flat), SUM_ITEMS)]
            yield pa.RecordBatch.from_pydict(
                {"block": list(range(len(blocks))), "data": blocks},
                schema=pa.schema([("block", pa.int32()), ("data", pa.binary())]))

    # two partial sums a block reach the driver
    sums = summed_blocks(docs.select("text").mapInArrow(run, "block int, data binary"), "<f4", SUM_ITEMS, salts=2)
    sent.destroy()
    if not sums:
        return None
    whole = np.concatenate([sums[k] for k in sorted(sums)])[:items]
    return whole[: (ROWS + 1) * width].reshape(ROWS + 1, width), whole[(ROWS + 1) * width :].reshape(2, cells)


def _least_count(counts: DataFrame, head: int) -> int:
    """The smallest count such that at most ``head`` words have it or more, on a scale of eighths of a power of two."""
    scale = F.floor(8 * F.log2("n")).cast("int")
    by_scale = dict(counts.groupBy(scale.alias("s")).count().toArrow().to_pandas().itertuples(index=False))  # 500 rows at most
    total, least = 0, None
    for s in sorted(by_scale, reverse=True):
        total += by_scale[s]
        if total > head:
            break
        least = s
    return 2**62 if least is None else int(np.ceil(2 ** (least / 8) - 1e-9))


def _counted_trees(counts: DataFrame, bits: int) -> Trees:
    path = F.shiftrightunsigned(F.crc32("word"), 32 - bits).cast("int")
    leaves = counts.groupBy("class", path.alias("path")).agg(F.sum(F.col("n") + 1).alias("n")).toArrow()  # CLASSES * 2^MOST_BITS rows at most
    return grow_trees(zip(*(leaves[c].to_pylist() for c in ("class", "path", "n")), strict=True), bits)


def train_model(train: DataFrame, counts: DataFrame, rounds: int = 4, rate: float = 0.5, ridge: float = 50.0, head: int = 300_000,
                cell_ridge: float = 20.0) -> Model:
    """``train`` has ``doc_id`` and ``text``; ``counts`` is the written result of ``count_words``."""
    totals = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    by_class = np.ones(CLASSES)
    prior = np.full(CLASSES, 1.0)
    for row in totals:
        by_class[row["class"]] += row.n + row.kinds
        prior[row["class"]] += row.n
    prior /= prior.sum()
    top = counts.where((F.col("n") >= _least_count(counts, head)) & (F.octet_length("word") > 0)).select("word", "n").toArrow()  # ``head`` rows at most
    end = counts.where(F.octet_length("word") == 0).collect()
    known = Head(top["word"].to_pylist(), top["n"].to_pylist(), end[0].n if end else 0)
    weights, bias = np.zeros((ROWS, CLASSES), np.float32), np.log(prior).astype(np.float32)
    spread = (prior * (1 - prior)).astype(np.float32)
    kinds = int(sum(r.kinds for r in totals))
    trees = _counted_trees(counts, min(MOST_BITS, 2 + math.ceil(math.log2(max(4, kinds / CLASSES)))))
    tokens = int(sum(r.n for r in totals))
    for k in range(rounds):
        part = train.where(crc_mod(F.concat(F.lit("round"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), rounds) == k)
        # many small files would hand on as many gradients: their volume follows the tokens instead
        sums = _gradient(part.coalesce(max(1, tokens // (rounds * TASK_TOKENS))), weights, bias, trees)
        if sums is None:
            continue
        step, (wrong, curve) = sums
        change = rate * step[:, :CLASSES] / (step[:, CLASSES:] * spread + ridge)
        weights = weights + change[:ROWS]
        bias = bias + change[ROWS]
        trees.cells = trees.cells + rate * wrong / (curve + cell_ridge)
    return Model(weights, bias.astype(np.float32), trees, known, tokens, kinds, by_class)


def _log_model(m: Model, classes: np.ndarray, hashes: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """log10 of P(word | history) over the word's count plus one."""
    p = _softmax(m.weights, m.bias, _rows(features))[np.arange(len(classes)), classes]
    return np.log10(np.maximum(p, 1e-30).astype(np.float64)) + _log_inside(m.trees, classes, hashes, features)


def score_texts(docs: DataFrame, model: Model, counts: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # weights and head words: fixed sizes
    kept = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        m = sent.value
        vocabulary = Vocabulary(m.head)
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                codes, sizes = vocabulary.codes(part["text"].to_pylist())
                at, features = _features(codes, sizes)
                classes, hashes, by_token = codes.classes[at], codes.hashes[at], vocabulary.counts(codes)
                times = by_token[at]
                log_model = np.concatenate([
                    _log_model(m, classes[a : a + CHUNK], hashes[a : a + CHUNK], [h[a : a + CHUNK] for h in features])
                    for a in range(0, len(at), CHUNK)])
                firsts = np.cumsum(sizes) - sizes
                own = np.flatnonzero(by_token[codes.places] < 0)
                words = [codes.data[a : a + n] for a, n in zip(codes.starts[own].tolist(), codes.lengths[own].tolist(), strict=True)]
                bounds = np.searchsorted(own, codes.firsts).tolist()
                rare = [Counter(words[a:b]) for a, b in itertools.pairwise(bounds)]
                rare_words, rare_times = [list(c) for c in rare], [list(c.values()) for c in rare]
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in kept] + [
                        part["row_id"], pa.array(sizes, pa.int64()),
                        pa.array(np.add.reduceat((times > 0).astype(np.int64), firsts)),
                        pa.array(np.add.reduceat(np.log10(np.maximum(times, 0) + 1.0), firsts)),
                        pa.array(np.add.reduceat(log_model, firsts)),
                        pa.array(rare_words, pa.list_(pa.binary())), pa.array(rare_times, pa.list_(pa.int64()))],
                    [*kept, "row_id", "n_tokens", "known", "log_head", "log_model", "words", "times"])

    rows = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], F.monotonically_increasing_id().alias("row_id"),
        F.col(f"`{text_col}`").alias("text"))
    schema = rows.drop("text").schema
    for name, kind in (("n_tokens", "long"), ("known", "long"), ("log_head", "double"), ("log_model", "double"),
                       ("words", ArrayType(BinaryType())), ("times", ArrayType(LongType()))):
        schema = schema.add(name, kind)
    scored = written(rows.mapInArrow(run, schema), "scored")
    rare = (
        scored.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("x"))
        .select("row_id", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
        .join(counts.select("word", "n"), "word")
        .groupBy("row_id")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_rare"), F.sum("times").alias("rare_known"))
    )
    logs = F.col("log_head") + F.coalesce("log_rare", F.lit(0.0))
    base = F.log10(F.lit(float(model.tokens + model.kinds + 1)))
    return scored.drop("words", "times").join(rare, "row_id", "left").select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base).alias("base_score"), (logs + F.col("log_model")).alias("score"))


def fit(train: DataFrame, **parameters) -> tuple[Model, DataFrame]:
    """The model and the written word counts of ``train`` (``doc_id``, ``text``)."""
    counts = written(count_words(train), "word-counts")
    return train_model(train, counts, **parameters), counts
