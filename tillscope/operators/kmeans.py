"""Multi-restart Lloyd k-means in whole numbers (M2).

All restarts advance together: one aggregation per round assigns every row to
its nearest centre in each restart and adds the rows up by (restart, cluster),
so a round is one pass over the points however many restarts there are, and
only ``restarts x k`` sums reach the driver.  A restart that has settled drops
out of the next round's expressions.

Coordinates and centres are integers (the caller scales them), sums are exact
and ties go to the lower cluster, so a fit does not depend on how rows are
spread over tasks, and SQL can state the same rounds.  Start centres are taken
in the order of a hash of the row's id: the first k rows for the first restart,
the next k for the second, and so on, starting over when rows run out.

A restart has settled when its centres' squared moves add up to at most
``tolerance``; a cluster without rows keeps its centre.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Centres = list[tuple[int, ...]]


@dataclass(frozen=True)
class Fit:
    """One restart's outcome: centres, rows and summed amount per cluster, and the sum of squared distances."""

    restart: int
    centres: Centres
    sizes: list[int]
    amounts: list
    inertia: int
    rounds: int


def _nearest_sql(dims: list[str], centres: Centres) -> str:
    """(d, c): squared distance and number of the nearest centre, lower numbers first."""
    far = lambda centre: " + ".join(f"({x} - ({at}L)) * ({x} - ({at}L))" for x, at in zip(dims, centre, strict=True))
    options = [f"named_struct('d', {far(centre)}, 'c', {c})" for c, centre in enumerate(centres)]
    return f"least({', '.join(options)})" if len(options) > 1 else options[0]


def nearest(dims: list[str], centres: Centres) -> Column:
    """Number of the centre nearest to the row's whole-number coordinates."""
    return F.expr(_nearest_sql(dims, centres)).getField("c")


def start_centres(points: DataFrame, id_col: str, dims: list[str], k: int, restarts: int) -> list[Centres]:
    """Start centres of every restart, in hash order of the ids (a top-n of ``restarts * k`` rows)."""
    order = F.md5(F.col(id_col).cast("string"))
    rows = points.orderBy(order, id_col).select(*dims).limit(restarts * k).collect()
    return [[tuple(rows[(r * k + c) % len(rows)]) for c in range(k)] for r in range(restarts)] if rows else []


def _total(x: np.ndarray) -> int:
    """The exact sum; one beyond 64 bits then fails where it becomes a column."""
    return int(x.sum()) if len(x) * max(-int(x.min()), int(x.max()), 0) < 1 << 63 else sum(x.tolist())


def _partial_sums(points: DataFrame, dims: list[str], amount: str, active: dict[int, Centres]) -> DataFrame:
    """A row per batch, restart and cluster (``r``, ``c``), with what the batch's rows add up to.

    A task adds up its batches in numpy, a few array operations a centre, and no
    row is copied per restart.  Squared distances are added in two halves, so that
    their sums stay exact.  A row with an unknown coordinate counts for the first
    cluster, at no distance.
    """
    names = ["r", "c", "n", "d_high", "d_low", "amount", "amounts", *[f"s{i}" for i in range(len(dims))]]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unknown = np.zeros(batch.num_rows, bool)
            at = []
            for i in range(len(dims)):
                unknown |= batch.column(i).is_null().to_numpy(zero_copy_only=False)
                at.append(batch.column(i).fill_null(0).to_numpy())
            money = batch.column(len(dims))
            has_money = money.is_valid().to_numpy(zero_copy_only=False)
            money = money.fill_null(0).to_numpy()
            out: dict[str, list] = {name: [] for name in names}
            for r, centres in active.items():
                widest = sum(max(abs(int(e) - v) for e in (x.min(), x.max()) for v in vs) ** 2 for x, vs in zip(at, zip(*centres), strict=True))
                if widest >= 1 << 63:
                    raise OverflowError("a squared distance goes beyond 64 bits")
                far = np.stack([sum((x - v) ** 2 for x, v in zip(at, centre, strict=True)) for centre in centres])
                far[:, unknown] = 0
                own = far.argmin(0)  # ties to the lower cluster
                near = far.min(0)
                for c in np.unique(own).tolist():
                    mine = own == c
                    sums = [int(mine.sum()), int((near[mine] >> 32).sum()), int((near[mine] & 0xFFFFFFFF).sum()), _total(money[mine]),
                            int(has_money[mine].sum()), *[_total(x[mine]) for x in at]]
                    for name, value in zip(names, [r, c, *sums], strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(name, pa.int64()) for name in names]))

    return points.select(*[F.col(x).cast("long") for x in dims], F.col(amount).cast("long")).mapInArrow(
        run, ", ".join(f"{name} long" for name in names))


def _sums(points: DataFrame, dims: list[str], amount: str, active: dict[int, Centres]) -> dict[int, dict[int, tuple]]:
    """By restart and cluster: rows, coordinate sums, squared distances, amounts (one pass)."""
    parts = _partial_sums(points, dims, amount, active)
    rows = parts.groupBy("r", "c").agg(*[F.sum(name).alias(name) for name in parts.columns[2:]]).collect()  # restarts x k rows
    out: dict[int, dict[int, tuple]] = {r: {} for r in active}
    for row in rows:
        out[row.r][row.c] = (row.n, [row[f"s{i}"] for i in range(len(dims))], (row.d_high << 32) + row.d_low,
                             row.amount if row.amounts else None)
    return out


def _rounded(total: int, n: int) -> int:
    """total / n to the nearest whole number, halves up."""
    return (2 * total + n) // (2 * n)


def fit(points: DataFrame, id_col: str, dims: list[str], amount: str, k: int = 4, restarts: int = 10,
        max_rounds: int = 300, tolerance: int = 0) -> list[Fit]:
    """All restarts, best first (least sum of squared distances, then lower restart); empty without rows.

    ``points`` is read once a round: hand in a table that is cheap to read again.
    """
    centres = dict(enumerate(start_centres(points, id_col, dims, k, restarts)))
    active, rounds = dict(centres), dict.fromkeys(centres, 0)
    for _ in range(max_rounds):
        if not active:
            break
        settled = []
        for r, clusters in _sums(points, dims, amount, active).items():
            moved = [tuple(_rounded(s, clusters[c][0]) for s in clusters[c][1]) if c in clusters else old
                     for c, old in enumerate(active[r])]
            shift = sum((a - b) ** 2 for new, old in zip(moved, active[r], strict=True) for a, b in zip(new, old, strict=True))
            centres[r] = active[r] = moved
            rounds[r] += 1
            if shift <= tolerance:
                settled.append(r)
        for r in settled:
            del active[r]
    if not centres:
        return []
    fits = []
    for r, clusters in _sums(points, dims, amount, centres).items():
        own = [clusters.get(c, (0, None, 0, None)) for c in range(k)]
        fits.append(Fit(r, centres[r], [x[0] for x in own], [x[3] for x in own], sum(x[2] for x in own), rounds[r]))
    return sorted(fits, key=lambda f: (f.inertia, f.restart))
