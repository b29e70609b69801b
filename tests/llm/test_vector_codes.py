import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillscope.llm import vector_codes as vc

INF, NAN = float("inf"), float("nan")


def plain_nearest(points, entries):
    gaps = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(-1)
    return gaps.argmin(1), gaps.min(1)


def plain(rows, parts, entries, rounds, scale):
    """The whole operator by plain loops over exact integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return [], hashlib.sha256(b"").hexdigest()
    q = np.array([[int(np.floor(scale * float(np.float32(x)))) for x in r[1]] for r in rows]).reshape(len(rows), parts, -1)
    books = [q[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            near, _ = plain_nearest(q[:, p], books[p])
            for e in range(len(books[p])):
                mine = q[:, p][near == e]
                if len(mine):
                    books[p][e] = [int(s) // len(mine) for s in mine.sum(0)]
    near = [plain_nearest(q[:, p], books[p]) for p in range(parts)]
    errors = sum(d for _, d in near)
    labels = {}
    for r, e in zip(rows, errors.tolist(), strict=True):
        labels[r[2]] = labels.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{near[p][0][i]:02x}" for p in range(parts)), int(errors[i]), labels[r[2]]) for i, r in enumerate(rows)], digest


def table(spark, rows):
    return spark.createDataFrame([(*r, 1.5, "x") for r in rows],
                                 "vec_id long, embedding array<float>, label int, error double, vector string")


def of(frame):
    return sorted(((r.id, bytes(r.codes).hex(), r.error, r.label_error) for r in frame.collect()), key=str)


@pytest.mark.parametrize("entries,width", [(1, 3), (2, 1), (33, 2), (64, 8), (200, 4)])
def test_orchard_search_is_exact_with_ties(entries, width):
    rng = np.random.default_rng(entries)
    for spread in (2, 30):  # two values a component: many equal entries and equal distances
        books = rng.integers(-spread, spread + 1, (entries, width))
        points = rng.integers(-spread, spread + 1, (700, width))
        found, best, computed = vc.orchard_nearest(points, books, vc.neighbour_lists(books))
        index, gap = plain_nearest(points, books)
        assert (found == index).all() and (best == gap).all()
        assert computed <= 700 * entries


def test_search_stops_beyond_twice_the_distance():
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]])
    books = np.concatenate([c + rng.integers(-50, 50, (16, 2)) for c in centres])
    points = np.concatenate([c + rng.integers(-50, 50, (500, 2)) for c in centres])
    found, best, computed = vc.orchard_nearest(points, books, vc.neighbour_lists(books))
    index, gap = plain_nearest(points, books)
    assert (found == index).all() and (best == gap).all()
    assert computed < 0.6 * len(points) * len(books)


def test_compress_equals_plain_loops(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(300, 8)).astype(np.float32).round(1).tolist()
    rows = [(i * 3, v, i % 4 if i % 5 else None) for i, v in enumerate(vectors)]
    rows += [(4, vectors[0], 1)] * 120  # one vector holds a third of the rows
    rows += [(None, vectors[1], 2), (0, vectors[2], 2), (7, None, 1), (8, [None] + vectors[3][1:], 1),
             (9, [NAN] + vectors[3][1:], 1), (10, [INF] + vectors[3][1:], 1), (11, [-INF] + vectors[3][1:], 1)]
    expected, digest = plain(rows, 4, 16, 2, 256)
    out = vc.compress(table(spark, rows).repartition(5), parts=4, entries=16)
    assert of(out) == sorted(expected, key=str)
    assert {r.codebooks_sha256 for r in out.collect()} == {digest}


def test_few_rows_and_no_rows(spark):
    rows = [(2, [0.5, -0.5], 1), (1, [0.5, 0.25], None)]
    expected, digest = plain(rows, 2, 64, 2, 256)
    out = vc.compress(table(spark, rows), parts=2)
    assert of(out) == sorted(expected, key=str) and out.first().codebooks_sha256 == digest
    none = vc.compress(table(spark, [(1, None, 1)]), parts=2)
    assert none.collect() == [] and none.columns == out.columns


def test_uneven_vectors_are_refused(spark):
    with pytest.raises(ValueError):
        vc.compress(table(spark, [(1, [0.5, 0.5, 0.5], 1)]), parts=2)


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 8))
    vectors = (centres[rng.integers(0, 20, 200)] + 0.01 * rng.normal(size=(200, 8))).astype(np.float32)
    frame = table(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)]).select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    books = vc.train(frame, parts=4, entries=64)
    decoded = {r.id: r.vector for r in vc.decode(vc.encode(frame, books), books).collect()}
    off = np.array([np.abs(np.array(decoded[i]) - vectors[i]).max() for i in range(200)])
    assert off.mean() < 0.1


def test_registered_query_equals_plain_loops(spark, tmp_path):
    from tillscope.llm.queries import queries

    rng = np.random.default_rng(9)
    rows = [(i, v, i % 3) for i, v in enumerate(rng.normal(scale=0.1, size=(150, 32)).astype(np.float32).tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    expected, digest = plain(rows, 16, 64, 2, 256)
    out = queries()["op11_vector_codes"](spark, str(tmp_path)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in out) == sorted(expected)
    assert {r.codebooks_sha256 for r in out} == {digest}
