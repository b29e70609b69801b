"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all documents.  Tokens that look
disguised (letters mixed with look-alike signs, a letter three times or more in
a row, single letters set apart by spaces or marks) become lattices: a sign may
stand for one of its letters, a run for one or two letters, an accent may be
dropped, separators vanish.  A Viterbi search takes the path that the character
model and the channel costs like best, and the restored word replaces the
token.  Restored texts are scored by a lexicon of words and word beginnings
that occur in toxic documents far beyond chance (likelihood-ratio test against
clean ones); the log-odds of the best one in each
word, summed over distinct ones, go through a logistic curve.

What is learned: the character model over every text (a fixed alphabet, so a
fixed number of counts); lexicon and curve from ``sample_rows`` labelled rows
at most, those with the smallest hash of their id, so that neither grows with
the corpus.  Both are broadcast.

Defined cases: a null or empty text has no hits and gets the curve's value at
zero; null labels teach nothing; without labelled rows of both kinds every
score is 0; repeated rows are scored each; texts of one id share its label.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType

from tillscope.llm.common import slices, summed_blocks

#: Signs and the letters that they may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "€": "e", "£": "l", "!": "i", "|": "li", "+": "t", "(": "c", "*": "aeiou",
}
INSIDE_ONLY = "!|+(*"  #: too common as punctuation to count at a word's edge
SEPARATORS = " .-_*"
PLAIN = {"à": "a", "á": "a", "â": "a", "ä": "a", "ã": "a", "å": "a", "è": "e", "é": "e", "ê": "e", "ë": "e", "ì": "i",
         "í": "i", "î": "i", "ï": "i", "ò": "o", "ó": "o", "ô": "o", "ö": "o", "õ": "o", "ù": "u", "ú": "u", "û": "u",
         "ü": "u", "ñ": "n", "ç": "c"}

#: The model's alphabet: 0 for everything but letters, a-z, the letters from U+00DF to U+00FF, one for all others.
SIZE = 1 + 26 + 33 + 1
_TOP = 0x3000
BLOCK_ITEMS = SIZE * SIZE
LETTER_COST, SIGN_COST, ACCENT_COST, DROP_COST, DOUBLE_COST = 0.0, 0.7, 4.0, 0.3, 2.0
PREFIXES = (3, 4, 5, 6, 7, 8)
MEMO = 200_000


def _letter_table() -> np.ndarray:
    table = np.zeros(_TOP + 1, np.uint8)
    for c in range(_TOP + 1):
        if chr(c).isalpha():
            table[c] = SIZE - 1
    table[_TOP] = SIZE - 1  # whatever lies beyond counts as a letter
    table[0x61:0x7B] = np.arange(1, 27)
    table[0xDF:0x100] = np.arange(27, 60)
    table[0xF7] = 0
    return table


def _kind_table() -> np.ndarray:
    """Bits: 1 letter, 2 look-alike, 4 look-alike inside words only, 8 separator, 16 white space."""
    table = np.zeros(_TOP + 1, np.uint8)
    table[_letter_table() > 0] |= 1
    for c in LOOK_ALIKES:
        table[ord(c)] |= 4 if c in INSIDE_ONLY else 2
    for c in SEPARATORS:
        table[ord(c)] |= 8
    for c in range(_TOP):
        if chr(c).isspace():
            table[c] |= 16
    return table


_LETTERS, _KINDS = _letter_table(), _kind_table()


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), _TOP)


def count_characters(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts (SIZE x SIZE x SIZE) over all texts, lower-cased."""
    def run(batches):
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 2_000_000):
                joined = "\n\n".join(["", *[x for x in part["text"].to_pylist() if x], ""]).lower()
                c = _LETTERS[_codes(joined)].astype(np.int32)
                if len(c) > 2:
                    total += np.bincount(c[:-2] * (SIZE * SIZE) + c[1:-1] * SIZE + c[2:], minlength=SIZE**3)
        if total.any():
            blocks = total.reshape(SIZE, BLOCK_ITEMS)
            yield pa.RecordBatch.from_pydict(
                {"block": list(range(SIZE)), "data": [b.tobytes() for b in blocks]},
                schema=pa.schema([("block", pa.int32()), ("data", pa.binary())]))

    sums = summed_blocks(
        docs.select(F.col(text_col).alias("text")).mapInArrow(run, "block int, data binary"), "<i8", BLOCK_ITEMS)
    if not sums:
        return np.zeros((SIZE, SIZE, SIZE), np.int64)
    return np.stack([sums[k] for k in range(SIZE)]).reshape(SIZE, SIZE, SIZE)


class Restorer:
    """Finds disguised tokens of a text and decodes them under the character model."""

    def __init__(self, trigrams: np.ndarray):
        smooth = trigrams + 0.05
        cost = -np.log(smooth / smooth.sum(2, keepdims=True))
        self.cost = cost.astype(np.float64).reshape(SIZE * SIZE, SIZE).tolist()
        self.memo: dict[str, str] = {}

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """The letters that each place may hold, with the channel's cost; an empty string: nothing."""
        steps: list[list[tuple[str, float]]] = []
        apart = re.fullmatch(r"(?:[^\s][ .\-_*]+){2,}[^\s]", token) is not None
        i = 0
        while i < len(token):
            c, run = token[i], 1
            while i + run < len(token) and token[i + run] == c:
                run += 1
            letters = [(c, LETTER_COST)] if c.isalpha() else [(x, SIGN_COST) for x in LOOK_ALIKES.get(c, "")]
            letters += [(PLAIN[c], ACCENT_COST)] if c in PLAIN else []
            if apart and c in SEPARATORS:
                letters = []
            if letters and c == "*":
                letters.append(("", DROP_COST))
            for k in range(min(run, 2) if letters else 0):  # a run of three or more is one or two letters
                steps.append(letters + ([("", DROP_COST if run > 2 else DOUBLE_COST)] if k else []))
            i += run
        return steps

    def decode(self, token: str) -> str:
        """The cheapest path's letters."""
        known = self.memo.get(token)
        if known is None:
            states = {(0, 0): (0.0, None)}  # the last two letters' codes; their cost and the letters so far, linked
            for step in self.lattice(token):
                after: dict[tuple[int, int], tuple] = {}
                for (a, b), (cost, text) in states.items():
                    row = self.cost[a * SIZE + b]
                    for letter, extra in step:
                        if letter:
                            c = int(_LETTERS[min(ord(letter), _TOP)])
                            key, new = (b, c), (cost + extra + row[c], (text, letter))
                        else:
                            key, new = (a, b), (cost + extra, text)
                        if key not in after or new[0] < after[key][0]:
                            after[key] = new
                states = after
            link = min(((cost + self.cost[a * SIZE + b][0], text) for (a, b), (cost, text) in states.items()), key=lambda x: x[0])[1]
            letters = []
            while link:
                link, letter = link
                letters.append(letter)
            known = "".join(reversed(letters))
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = known
        return known

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Places of disguised tokens in a lower-cased text, in order, not overlapping."""
        codes = _codes(text)
        kind = _KINDS[codes]
        n = len(kind)
        if n < 3:
            return []
        letter, space = (kind & 1) > 0, (kind & 16) > 0
        hot = np.zeros(n, bool)
        sign, inside = (kind & 2) > 0, (kind & 4) > 0
        hot[:-1] |= sign[:-1] & letter[1:]
        hot[1:] |= sign[1:] & letter[:-1]
        hot[1:-1] |= inside[1:-1] & letter[:-2] & letter[2:]
        hot[2:] |= letter[2:] & (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2])
        separator = ((kind & 8) > 0) | space
        edge = np.ones(n + 2, bool)
        edge[1:-1] = separator
        single = ~separator & edge[:-2] & edge[2:] & ((kind & 3) > 0)
        apart = np.flatnonzero(single[:-4] & single[2:-2] & single[4:]) if n > 4 else ()
        places = np.flatnonzero(hot)
        if not len(places) and not len(apart):
            return []
        out: list[tuple[int, int]] = []
        for i in apart:  # three single signs, each two places on; runs of them grow together
            if out and int(i) <= out[-1][1]:
                out[-1] = (out[-1][0], int(i) + 5)
            else:
                out.append((int(i), int(i) + 5))
        gaps = np.flatnonzero(space)
        begin, at = 0, np.searchsorted(gaps, places)
        taken, t = list(out), 0  # both in text order, so one walk along the taken spans serves all tokens
        for g in np.unique(at):
            begin = int(gaps[g - 1]) + 1 if g else 0
            end = int(gaps[g]) if g < len(gaps) else n
            token = text[begin:end]
            end -= len(token) - len(_tail.sub("", token))
            begin += len(token) - len(token.lstrip("\"'([{<"))
            while t < len(taken) and taken[t][1] <= begin:
                t += 1
            free = t == len(taken) or taken[t][0] >= end
            if begin < end and free and not _plain(text[begin:end]):
                out.append((begin, end))
        return sorted(out)

    def restore(self, text: str | None) -> str:
        """The lower-cased text with disguised tokens decoded."""
        if not text:
            return ""
        low = text.lower()
        spans = self.spans(low)
        if not spans:
            return low
        parts, at = [], 0
        for a, b in spans:
            parts += [low[at:a], self.decode(low[a:b])]
            at = b
        return "".join([*parts, low[at:]])


_tail = re.compile(r"(?:[.,;:?!#%&*\"')\]}>|]+|([$+@(])\1{2,})+$")
_run = re.compile(r"([^\W\d_])\1\1")


def _plain(token: str) -> bool:
    """Nothing is left to decode once the marks at the end are off."""
    return not any(c in LOOK_ALIKES for c in token) and not _run.search(token)


_word = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> set[str]:
    """Words, and beginnings of longer words (marked by a trailing hyphen)."""
    words = set(_word.findall(text))
    return words | {w[:k] + "-" for w in words for k in PREFIXES if len(w) > k}


class Lexicon:
    """Weights of features, found in one pass of an Aho-Corasick automaton."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick

        self.found = ahocorasick.Automaton() if weights else None
        by_text: dict[str, list] = {}
        for f, w in weights.items():
            by_text.setdefault(f.rstrip("-"), [None, None])[f.endswith("-")] = (f, w)
        for text, (whole, start) in by_text.items():
            self.found.add_word(text, (len(text), whole, start))
        if self.found:
            self.found.make_automaton()

    def weights(self, text: str) -> tuple[float, float, int]:
        """Of the best feature of each word hit: the largest weight and the sum over distinct ones; words hit."""
        if self.found is None or not text:
            return 0.0, 0.0, 0
        best, n = {}, len(text)
        for last, (size, whole, start) in self.found.iter(text):
            first = last - size + 1
            if first and text[first - 1].isalpha():
                continue
            feature = start if last + 1 < n and text[last + 1].isalpha() else whole
            if feature and (first not in best or feature[1] > best[first][1]):
                best[first] = feature
        distinct = dict(best.values())
        return max(distinct.values(), default=0.0), sum(distinct.values()), len(best)


@dataclass
class Model:
    trigrams: np.ndarray
    weights: dict[str, float]
    slopes: tuple[float, float]
    offset: float

    def curve(self, largest: float, total: float) -> float:
        z = self.slopes[0] * largest + self.slopes[1] * math.log1p(total) + self.offset
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, those with the smallest hash, one label each."""
    per_id = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return per_id.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, max_features: int = 5_000, least_ratio: float = 30.0) -> Model:
    """``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id`` and ``toxic`` (0 or 1): only rows to learn from."""
    spark = docs.sparkSession
    trigrams = count_characters(docs)
    chosen = _sample(labels, sample_rows).collect()  # sample_rows pairs of numbers
    kinds = Counter(r.toxic for r in chosen)
    if not kinds[0] or not kinds[1]:
        return Model(trigrams, {}, (0.0, 0.0), -40.0)
    sent = spark.sparkContext.broadcast(trigrams)
    ids = F.broadcast(spark.createDataFrame([(r.doc_id, int(r.toxic)) for r in chosen], "doc_id long, toxic int"))
    labelled = docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "toxic", "text")

    def count(batches):
        restorer, counts = Restorer(sent.value), (Counter(), Counter())

        def flush():
            names = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_pydict(
                {"feature": names, "clean": [counts[0][x] for x in names], "toxic": [counts[1][x] for x in names]},
                schema=pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist(), strict=True):
                counts[toxic].update(features_of(restorer.restore(text)))
                counts[toxic][""] += 1
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield flush()
        yield flush()

    counted = (
        labelled.select("toxic", "text").dropDuplicates(["text"]).mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    seen = counted.where(F.col("toxic") >= 5).collect()  # features of sample_rows texts, frequent ones only
    whole = next((r for r in seen if r.feature == ""), None)
    if whole is None or not whole.clean:
        return Model(trigrams, {}, (0.0, 0.0), -40.0)
    weights, share = {}, whole.toxic / (whole.toxic + whole.clean)
    ratios = []
    for r in seen:
        n = r.toxic + r.clean
        ratio = 2 * (r.toxic * math.log(r.toxic / (n * share)) + (r.clean * math.log(r.clean / (n * (1 - share))) if r.clean else 0))
        odds = math.log((r.toxic + 0.5) / (whole.toxic + 1)) - math.log((r.clean + 0.5) / (whole.clean + 1))
        if r.feature and ratio >= least_ratio and r.toxic > r.clean and odds > 2:
            ratios.append((ratio, r.feature, odds))
    for _, feature, odds in sorted(ratios, reverse=True)[:max_features]:
        weights[feature] = odds
    model = Model(trigrams, weights, (0.0, 0.0), 0.0)
    # of an id with several rows the most toxic one: sample_rows rows of numbers
    points = score(labelled, model, ["doc_id", "toxic"]).groupBy("doc_id", "toxic").agg(
        F.max("largest").alias("largest"), F.max("weight").alias("weight")).collect()
    *slopes, model.offset = _logistic(
        np.array([(r.largest, math.log1p(r.weight), 1.0) for r in points]), np.array([float(r.toxic) for r in points]))
    model.slopes = tuple(slopes)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, hold: float = 0.01) -> list[float]:
    """Coefficients by Newton steps, held down a little (the classes may be separable)."""
    beta, held = np.zeros(x.shape[1]), hold * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        curvature = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + held
        beta = beta + np.linalg.solve(curvature, x.T @ (y - p) - held @ beta)
    return beta.tolist()


def score(
    docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", threshold: float = 0.7, prefix: str = ""
) -> DataFrame:
    """``keep`` columns, then, their names led by ``prefix`` (set one if ``keep`` has such names), ``score``, ``rejected`` (score >= threshold), ``largest`` and summed ``weight``, and ``hits`` of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        m = sent.value
        restorer, lexicon = Restorer(m.trigrams), Lexicon(m.weights)
        for batch in batches:
            found = []
            for part in slices(batch, "text"):
                for text in part["text"].to_pylist():
                    found.append(lexicon.weights(restorer.restore(text)))
            scores = [m.curve(largest, total) for largest, total, _ in found]
            largest, total, hits = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in kept] + [
                    pa.array(scores, pa.float64()), pa.array([s >= threshold for s in scores]),
                    pa.array(largest, pa.float64()), pa.array(total, pa.float64()), pa.array(hits, pa.int64())],
                [*kept, "score", "rejected", "largest", "weight", "hits"])

    rows = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], F.col(f"`{text_col}`").alias("text"))
    schema = rows.select(*kept).schema
    for name, kind in (("score", DoubleType()), ("rejected", BooleanType()),
                       ("largest", DoubleType()), ("weight", DoubleType()), ("hits", LongType())):
        schema = schema.add(name, kind)
    out = rows.mapInArrow(run, schema)
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)],
        *[F.col(x).alias(prefix + x) for x in ("score", "rejected", "largest", "weight", "hits")])
