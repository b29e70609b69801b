"""The batched k-means against a plain loop over the same rounds."""

import datetime as dt
import hashlib
import random

import pytest

from star_tables import customer, make_star, order, product
from tillscope.operators import kmeans
from tillscope.plans import segments


def plain(points, k, restarts, tolerance, max_rounds=300):
    """(inertia, restart, centres, sizes) of every restart; ``points``: id, coordinates, amount."""
    hashed = sorted(points, key=lambda p: (hashlib.md5(str(p[0]).encode()).hexdigest(), p[0]))[: restarts * k]
    out = []
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(restarts):
        centres = [hashed[(r * k + c) % len(hashed)][1] for c in range(k)]
        nearest = lambda p: min((gap(p, at), c) for c, at in enumerate(centres))  # noqa: E731, B023
        for _ in range(max_rounds):
            groups = [[] for _ in range(k)]
            for _, p, _ in points:
                groups[nearest(p)[1]].append(p)
            moved = [tuple((2 * sum(x) + len(g)) // (2 * len(g)) for x in zip(*g, strict=True)) if g else old
                     for g, old in zip(groups, centres, strict=True)]
            shift = sum(map(gap, moved, centres))
            centres = moved
            if shift <= tolerance:
                break
        sizes, inertia = [0] * k, 0
        for _, p, _ in points:
            d, c = nearest(p)
            sizes[c] += 1
            inertia += d
        out.append((inertia, r, centres, sizes))
    return sorted(out, key=lambda x: x[:2])


@pytest.mark.parametrize("n,k,restarts,tolerance", [(200, 4, 5, 0), (60, 3, 2, 50), (3, 4, 3, 0), (1, 2, 2, 0), (0, 4, 3, 0)])
def test_fit_equals_plain_rounds(spark, n, k, restarts, tolerance):
    rnd = random.Random(n)
    rows = [(i, (rnd.randint(-40, 40), rnd.choice([0, 7]), rnd.randint(-5, 5) * 100), rnd.randint(1, 9)) for i in range(n)]
    rows = [rows[0] if i % 3 == 0 else r for i, r in enumerate(rows)]  # a third of the rows is one point
    rows = [(i, p, a) for i, (_, p, a) in enumerate(rows)]
    points = spark.createDataFrame([(i, *p, a) for i, p, a in rows], "id long, x long, y long, z long, a long").repartition(3)
    got = kmeans.fit(points, "id", ["x", "y", "z"], "a", k, restarts, 300, tolerance)
    if not n:
        assert got == []
        return
    assert [(f.inertia, f.restart, f.centres, f.sizes) for f in got] == plain(rows, k, restarts, tolerance)
    assert all(sum(f.sizes) == n and sum(a or 0 for a in f.amounts) == sum(a for *_, a in rows) for f in got)


def test_a_round_is_one_pass_over_the_points(spark):
    points = spark.range(500).selectExpr("id", "id * 37 % 101 as x", "id * 17 % 53 as y", "1L as a")
    passes = []
    true = kmeans._sums
    kmeans._sums = lambda *a: passes.append(len(a[3])) or true(*a)
    try:
        fits = kmeans.fit(points, "id", ["x", "y"], "a", 4, 10)
    finally:
        kmeans._sums = true
    assert len(passes) == max(f.rounds for f in fits) + 1  # all restarts in each, and one for the outcome
    assert passes[0] == passes[-1] == 10 and sum(passes[:-1]) == sum(f.rounds for f in fits)


def test_segments_of_few_and_no_customers(spark):
    day = dt.date(2020, 5, 1)
    for n in (0, 1, 3):
        s = make_star(spark, [customer(i) for i in range(1, 6)], [product(1)],
                      [order(i, i, day, 10 * i) for i in range(1, n + 1)], [])
        rows = segments.kmeans_segments(s).collect()
        assert len(rows) == n
        by_cluster = {r.cluster: r.monetary_value for r in sorted(rows, key=lambda r: r.monetary_value)}
        assert sorted(by_cluster) == list(range(len(by_cluster)))
        assert sorted(by_cluster.values(), reverse=True) == [by_cluster[c] for c in sorted(by_cluster)]
        assert segments.cluster_summary(s).count() == len(by_cluster)


def test_a_pass_hands_on_sums_and_no_row_a_restart(spark):
    points = spark.range(5000).selectExpr("id % 97 as x", "IF(id = 7, NULL, id % 31) as y", "IF(id % 2 = 0, NULL, id) as a").coalesce(1)
    active = {r: [(r, 0), (50, 20), (90, 30)] for r in range(10)}
    assert kmeans._partial_sums(points, ["x", "y"], "a", active).count() <= 30
    sums = kmeans._sums(points, ["x", "y"], "a", active)
    rows = points.collect()
    for r, centres in active.items():
        want = {}
        for x, y, a in rows:
            d, c = min(((x - u) ** 2 + (y - v) ** 2, c) for c, (u, v) in enumerate(centres)) if y is not None else (0, 0)
            n, at, far, money = want.get(c, (0, [0, 0], 0, 0))
            want[c] = n + 1, [at[0] + x, at[1] + (y or 0)], far + d, money + (a or 0)
        assert sums[r] == want


def test_sums_beyond_64_bits_are_exact_and_distances_beyond_them_fail(spark):
    far = 1_400_000_000
    points = spark.range(10).selectExpr("id", f"IF(id < 5, -{far}L, {far}L) as x", "1L as a")
    assert kmeans.fit(points, "id", ["x"], "a", k=1, restarts=1)[0].inertia == 10 * far**2
    with pytest.raises(Exception, match="beyond 64 bits"):
        kmeans.fit(points.selectExpr("id", "3 * x as x", "a"), "id", ["x"], "a", k=1, restarts=1)
