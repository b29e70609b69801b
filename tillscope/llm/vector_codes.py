"""Compression of vectors to codes: one codebook a part position, nearest entries found by Orchard search.

Components become integers (``floor(scale * x)``), vectors are cut into equal
consecutive parts, and each part position has a codebook that starts as that
part of the vectors with the smallest ids.  A round assigns every part to its
nearest entry and replaces each entry by the componentwise floor of its parts'
mean.  Sums and counts of a round have one fixed size (parts x entries x part
length), are added up in streams by several tasks and reach the driver as a few
partial sums; vectors never do.

Orchard search: for every entry the others are listed by distance from it.  A
search stands at one entry and walks its list; an entry nearer to the part than
the current one becomes the current one and its list is walked from the start,
entries already looked at are marked and skipped, and the search ends at the
first listed entry that lies beyond twice the current distance: by the triangle
inequality no later one can be nearer.  All parts of a batch search in step.
Distances are exact integers, so ties go to the lower index exactly.

Defined cases: a vector that is null or holds a null, a NaN or an infinity is
dropped; an empty table gives no rows; with fewer kept vectors than entries the
codebooks have that many entries; a null id sorts after all others, rows of one
id are ordered by their vectors, and rows repeated whole are coded each; entries
that no part chose stay as they are; a null label is a label of its own.  Kept
vectors must have one length that the number of parts divides and components
below 2^20 after scaling (``ValueError`` otherwise, since sums would not be exact).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import summed_blocks, written

#: Scaled components stay below this in size: a part's squared distance and the sums of 2^42 rows then fit in 64 bits.
LARGEST = 1 << 20
#: Parts that search in step at once; bounds a task's working memory.
STEP_ROWS = 1 << 14


@dataclass(frozen=True)
class Codebooks:
    """``entries``: integers by part, entry and position within the part."""

    entries: np.ndarray
    scale: int

    def sha256(self) -> str:
        """Digest of all entries' decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False)))


def _scaled(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(scale * values.astype(np.float64))
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"vector components must stay below {LARGEST} after scaling")
    return scaled.astype(np.int64)


def _matrix(column: pa.Array, scale: int, length: int) -> np.ndarray:
    """The batch's vectors as rows of scaled integers."""
    if len(column) and (pa.compute.min_max(pa.compute.list_value_length(column)) != pa.scalar({"min": length, "max": length}, pa.struct([("min", pa.int32()), ("max", pa.int32())]))):
        raise ValueError(f"vectors must all have {length} components")
    return _scaled(column.flatten().to_numpy(zero_copy_only=False), scale).reshape(len(column), length)


def neighbour_lists(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every entry the others by squared distance (ties: lower index), and those distances."""
    gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(gaps, -1)  # an entry heads its own list and is cut off
    order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(gaps, order, axis=1)


def orchard_nearest(points: np.ndarray, entries: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of the entry nearest to each point (ties: lower index), and the distances computed."""
    order, gaps = lists
    n, k = len(points), len(entries)
    found, best = np.zeros(n, np.int64), ((points - entries[0]) ** 2).sum(1)
    marked = np.zeros((n, k), bool)
    marked[:, 0] = True
    at = np.arange(n)  # points whose search goes on, with the place in the current entry's list
    place = np.zeros(n, np.int64)
    computed = n
    while len(at) and k > 1:
        current = found[at]
        onward = gaps[current, place] <= 4 * best[at]  # squared: not beyond twice the distance
        at, place, current = at[onward], place[onward], current[onward]
        entry = order[current, place]
        fresh = ~marked[at, entry]
        rows, tried = at[fresh], entry[fresh]
        marked[rows, tried] = True
        distance = ((points[rows] - entries[tried]) ** 2).sum(1)
        computed += len(rows)
        nearer = (distance < best[rows]) | ((distance == best[rows]) & (tried < found[rows]))
        place += 1
        jump = np.flatnonzero(fresh)[nearer]
        found[rows[nearer]], best[rows[nearer]] = tried[nearer], distance[nearer]
        place[jump] = 0
        going = place < k - 1
        at, place = at[going], place[going]
    return found, best, computed


def _assigned(matrix: np.ndarray, books: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every part: rows x parts."""
    parts, _, width = books.shape
    codes, errors = np.empty((len(matrix), parts), np.int64), np.empty((len(matrix), parts), np.int64)
    narrow = np.int32 if width and 4 * width * max(np.abs(matrix).max(initial=0), np.abs(books).max(initial=0)) ** 2 < 2**31 else np.int64
    for start in range(0, len(matrix), STEP_ROWS):
        rows = slice(start, start + STEP_ROWS)
        for p in range(parts):
            points = np.ascontiguousarray(matrix[rows, p * width : (p + 1) * width], narrow)
            codes[rows, p], errors[rows, p], _ = orchard_nearest(points, books[p].astype(narrow), lists[p])
    return codes, errors


def first_codebooks(vectors: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """Codebooks of the ``entries`` vectors with the smallest ids, which are all that reaches the driver; None without vectors."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not rows:
        return None
    if len({len(r.vector) for r in rows}) > 1 or len(rows[0].vector) % parts:
        raise ValueError(f"vectors must have one length that {parts} parts divide")
    length = len(rows[0].vector)
    firsts = _scaled(np.asarray([r.vector for r in rows], np.float64).reshape(len(rows), length), scale)
    return Codebooks(firsts.reshape(len(rows), parts, length // parts).transpose(1, 0, 2).copy(), scale)


def trained_round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Assign every part and replace each entry by its parts' mean, rounded down; unused entries stay."""
    parts, entries, width = books.entries.shape
    start, scale = books.entries, books.scale

    def sums(batches):
        lists = [neighbour_lists(b) for b in start]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            matrix = _matrix(batch["vector"], scale, parts * width)
            codes, _ = _assigned(matrix, start, lists)
            for p in range(parts):
                total[p, :, width] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p, :, :width], codes[:, p], matrix[:, p * width : (p + 1) * width])
        yield pa.RecordBatch.from_pydict(
            {"block": [0], "data": [total.tobytes()]}, schema=pa.schema([("block", pa.int32()), ("data", pa.binary())]))

    partial = vectors.select("vector").mapInArrow(sums, "block int, data binary")
    summed = summed_blocks(partial, "<i8", start.size + parts * entries)[0].reshape(parts, entries, width + 1)
    count = summed[:, :, width:]
    return Codebooks(np.where(count > 0, summed[:, :, :width] // np.maximum(count, 1), start), scale)


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all of ``vectors`` (``id``, ``vector``)."""
    books = first_codebooks(vectors, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = trained_round(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """``id``, ``codes`` (one byte a part), ``error`` (squared distances summed over parts) and ``label`` of each vector."""
    start, scale = (books.entries, books.scale) if books else (np.zeros((1, 1, 0), np.int64), 1)
    if start.shape[1] > 256:
        raise ValueError("codes hold one byte a part: 256 entries at most")
    parts, _, width = start.shape
    label = vectors.schema["label"].dataType.simpleString()

    def coded(batches):
        lists = [neighbour_lists(b) for b in start]
        for batch in batches:
            codes, errors = _assigned(_matrix(batch["vector"], scale, parts * width), start, lists)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary()),
                 pa.array(errors.sum(1), pa.int64()), batch["label"]], ["id", "codes", "error", "label"])

    return vectors.select("id", "vector", "label").mapInArrow(coded, f"id long, codes binary, error long, label {label}")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``id`` and ``vector`` (array of doubles): the coded entries, at the middle of each scaled step."""
    start, scale = books.entries, books.scale
    parts = np.arange(len(start))

    def decoded(batches):
        for batch in batches:
            rows = [start[parts, np.frombuffer(c, np.uint8)].ravel() for c in batch["codes"].to_pylist()]
            vectors = [((row + 0.5) / scale).tolist() for row in rows]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(vectors, pa.list_(pa.float64()))], ["id", "vector"])

    return codes.select("id", "codes").mapInArrow(decoded, "id long, vector array<double>")


def compress(
    table: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Train on all kept vectors and code them: ``id``, ``codes``, ``error``, ``label``, ``label_error``, ``codebooks_sha256``.

    Coded rows are written once; the errors of a label are summed before they are
    joined back, so a label of very many rows is one row of the joined side.
    """
    vectors = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")).where(whole(F.col("vector")))
    books = train(vectors, parts, entries, rounds, scale)
    coded = written(encode(vectors, books), "codes")
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(of_label, coded["label"].eqNullSafe(of_label["of"])).drop("of").withColumn(
        "codebooks_sha256", F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()))
