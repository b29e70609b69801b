"""Runs: stretches of words that repeat with a period at least four times over, found by multi-scale minimizers.

A run is a stretch whose smallest period is q, of at least max(6, 4 q) words,
that no neighbouring word extends with period q.  The texts of a batch become
one array of word numbers, each followed by a number of its own, so that all
steps below are array operations over many texts and no run crosses a text's
end.

* Periods below ``SHORT`` are scanned directly: the array is compared with
  itself shifted by q, and long enough stretches of equality are runs of q.
* Scale B (``SHORT``, twice that, ...) covers periods from B to below 2 B.  Every
  gram of B / 4 words gets a hash; a position is a minimizer if its gram has the
  least hash of some window of B / 4 positions that holds it (all of them on
  ties), which depends on the words around it alone, so inside a run minimizers
  repeat at the distance of the period.  Pairs of equal minimizers B to 2 B apart
  seed an extension.  Equal minimizers that follow each other at one short
  distance lie in a stretch of a short period; only the ends of such a row of
  minimizers seed pairs, which the ends' copies one period on answer, so a
  position has a bounded number of partners whatever the text.
* A pair's extension to both sides is a binary search over hashes of word
  prefixes.  It is then checked word by word, and redone word by word if hashes
  met by chance: hashes decide where to look, never what is a run.
* Stretches found under several multiples of one period keep the smallest.

A run of period q needs 4 q words, so at scale B only texts of 4 B words are
looked at.  Work grows with words times scales.

Defined cases: a null or empty text has no words and no runs; rows that repeat
are handled each; a null id is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import slices

#: Periods below it are scanned directly; a power of two.
SHORT = 16
#: A run has at least this many words and repeats at least this many times.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Characters of text worked on at once.
STEP_CHARS = 2_000_000
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Scrambled hashes, so that their order has nothing to do with the words'."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return (h ^ (h >> np.uint64(29))) * _ODD


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` (a power of two) values in a row."""
    reach = 1
    while reach < width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return values


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions whose value is the least of some window of ``width`` positions."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = _sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, grams.dtype)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == grams)


def seed_pairs(positions: np.ndarray, values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of equal minimizers ``scale`` to below ``2 * scale`` apart; inner ones of evenly spaced rows are left out."""
    order = np.argsort(values, kind="stable")
    p, v = positions[order], values[order]
    gap = np.where(v[1:] == v[:-1], p[1:] - p[:-1], 0)
    inner = np.zeros(len(p), bool)
    if len(p) > 2:
        inner[1:-1] = (gap[1:] == gap[:-1]) & (gap[1:] > 0) & (gap[1:] <= scale // 8)
    p, v = p[~inner], v[~inner]
    starts, distances, step = [], [], 1
    while step < len(p):
        same = v[step:] == v[:-step]
        apart = p[step:] - p[:-step]
        near = same & (apart < 2 * scale)
        if not near.any():
            break
        far = near & (apart >= scale)
        starts.append(p[:-step][far])
        distances.append(apart[far])
        step += 1
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *starts]), np.concatenate([empty, *distances])


class _Prefixes:
    """Hashes of any stretch of words, from one pass over them."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        base = _ODD
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        ones = np.ones(n + 1, np.uint64)
        power = np.multiply.accumulate(np.concatenate([ones[:1], np.full(n, base)]))
        self.back = np.multiply.accumulate(np.concatenate([ones[:1], np.full(n, inverse)]))
        terms = _mixed(words.astype(np.uint64) + np.uint64(1)) * power[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.back[start]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` (> ``a``) on."""
        length = np.zeros(len(a), np.int64)
        for bit in reversed(range(self.n.bit_length())):
            more = length + (1 << bit)
            fits = np.flatnonzero(b + more <= self.n)
            x, y = a[fits], b[fits]
            done, upto = length[fits], more[fits]
            equal = self.hashes(x + done, x + upto) == self.hashes(y + done, y + upto)
            length[fits[equal]] = upto[equal]
        return length

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b`` (> ``a``)."""
        length = np.zeros(len(a), np.int64)
        for bit in reversed(range(self.n.bit_length())):
            more = length + (1 << bit)
            fits = np.flatnonzero(a - more >= 0)
            x, y = a[fits], b[fits]
            done, upto = length[fits], more[fits]
            equal = self.hashes(x - upto, x - done) == self.hashes(y - upto, y - done)
            length[fits[equal]] = upto[equal]
        return length


def _extended(words: np.ndarray, prefixes: _Prefixes, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The longest stretch of each period around ``at``, where words ``at`` and ``at + period`` are equal."""
    start = at - prefixes.backward(at, at + period)
    stop = at + period + prefixes.forward(at, at + period)
    keep = stop - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
    found = np.unique(np.stack([start[keep], stop[keep], period[keep]]), axis=1)
    for i, (s, e, q) in enumerate(found.T.tolist()):
        shifted = words[s : e - q] == words[s + q : e]
        if not shifted.all() or (s and words[s - 1] == words[s - 1 + q]) or (e < len(words) and words[e] == words[e - q]):
            equal = np.flatnonzero(words[:-q] != words[q:])  # hashes met by chance: look at the words themselves
            first = at[keep][(start[keep] == s) & (stop[keep] == e) & (period[keep] == q)]
            edges = np.concatenate([[-1], equal, [len(words) - q]])
            for seed in first.tolist():
                k = int(np.searchsorted(edges, seed, side="right"))
                found = np.concatenate([found, [[edges[k - 1] + 1], [edges[k] + q], [q]]], axis=1)
            found[2, i] = 0
    found = found[:, (found[2] > 0) & (found[1] - found[0] >= np.maximum(LEAST_WORDS, LEAST_TIMES * found[2]))]
    return found[0], np.stack([found[1], found[2]])


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs as rows (start, stop, period), by start.

    ``words`` holds texts one after another, longest first, of ``lengths`` words
    and one separator each; separators differ from all else.
    """
    found = [np.zeros((3, 0), np.int64)]
    for q in range(1, min(SHORT, len(words))):
        breaks = np.concatenate([[-1], np.flatnonzero(words[q:] != words[:-q]), [len(words) - q]])
        long = np.flatnonzero(np.diff(breaks) - 1 >= max(LEAST_WORDS, LEAST_TIMES * q) - q)
        found.append(np.stack([breaks[long] + 1, breaks[long + 1] + q, np.full(len(long), q)]))
    ends = np.cumsum(lengths + 1)
    scale, hashed, grams = SHORT, 1, _mixed(words.astype(np.uint64))
    prefixes = None
    while (texts := int(np.searchsorted(-lengths, -LEAST_TIMES * scale, side="right"))) > 0:
        part = words[: ends[texts - 1]]
        grams = grams[: len(part)]
        while hashed < scale // 4:  # a gram twice as long is a gram and the one behind it
            grams = _mixed(grams[:-hashed] * _MIX + (grams[hashed:] ^ (grams[hashed:] >> np.uint64(32))))
            hashed *= 2
        positions = minimizers(grams, scale // 4)
        at, distance = seed_pairs(positions, grams[positions], scale)
        if len(at):
            if prefixes is None:
                prefixes = _Prefixes(part)
            equal = words[at] == words[at + distance]
            start, rest = _extended(words[: prefixes.n], prefixes, at[equal], distance[equal])
            found.append(np.concatenate([start[None], rest]))
        scale *= 2
    runs = np.concatenate(found, axis=1)
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]  # of one stretch, the smallest period comes first
    again = np.zeros(runs.shape[1], bool)
    again[1:] = (runs[0, 1:] == runs[0, :-1]) & (runs[1, 1:] == runs[1, :-1])
    runs = runs[:, ~again]
    return runs[:, np.lexsort((runs[2], runs[0]))].T


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode().split() if text else []


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs (start, stop, period) of each list of words, by start, then period."""
    number: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    ends = np.cumsum(lengths + 1)
    words = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for k, (i, end, n) in enumerate(zip(order.tolist(), ends.tolist(), lengths.tolist(), strict=True)):
        words[end - 1 - n : end - 1] = [number.setdefault(w, len(number)) for w in texts[i]]
        words[end - 1] = -1 - k
    runs = find_runs(words, lengths)
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    if len(runs):
        owner = np.searchsorted(ends, runs[:, 0], side="right")
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for own, group in zip(owner[np.concatenate([[0], cuts])].tolist(), np.split(runs, cuts), strict=True):
            first = int(ends[own] - 1 - lengths[own])
            out[int(order[own])] = group - np.array([first, first, 0])
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def per_text(docs: DataFrame, make, schema: str, words=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``make(ids, texts' words, texts' runs)`` gives the columns of ``schema`` for a part of the documents."""
    split = words or (lambda _, text: words_of(text))
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<struct<start:long,length:long,period:long>>": pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))}
    arrow = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", STEP_CHARS):
                ids = part["doc_id"].to_pylist()
                texts = [split(i, t) for i, t in zip(ids, part["text"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pydict(make(ids, texts, runs_of_texts(texts)), schema=arrow)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period in words) and ``collapsed`` (the text with each run cut to its first period)."""

    def make(ids, texts, runs):
        rows = [[{"start": s, "length": e - s, "period": q} for s, e, q in r.tolist()] for r in runs]
        return {"doc_id": ids, "runs": rows, "collapsed": [b" ".join(collapsed(t, r)).decode() for t, r in zip(texts, runs, strict=True)]}

    return per_text(docs, make, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
                    id_col=id_col, text_col=text_col)


def digests(docs: DataFrame, words=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the number of runs, the longest (ties: smallest start, then period) and digests of all runs and of the collapsed text.

    ``words`` turns an id and a text into the words to look at; by default those of the text.
    """

    def make(ids, texts, runs):
        names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
        out: dict[str, list] = {"doc_id": ids} | {name: [] for name in names}
        for text, found in zip(texts, runs, strict=True):
            top = min(((s - e, s, q) for s, e, q in found.tolist()), default=None)
            row = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
            listed = "".join([f"{s},{e - s},{q}\n" for s, e, q in found.tolist()])
            values = (len(found), *row, hashlib.sha256(listed.encode()).hexdigest(),
                      hashlib.sha256(b" ".join(collapsed(text, found))).hexdigest())
            for name, value in zip(names, values, strict=True):
                out[name].append(value)
        return out

    return per_text(docs, make, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                    "runs_sha256 string, collapsed_sha256 string", words, id_col, text_col)
