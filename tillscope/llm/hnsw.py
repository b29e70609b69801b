"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Vectors that are equal are one node.  Nodes are dealt by a hash of the vector
into shards of about ``shard_nodes``; each shard gets its own hierarchical
graph, kept as flat arrays (one row of neighbour numbers a node and layer).  A
node's height is drawn from a hash, so building is repeatable.  Largest inner
product is turned into nearness on a sphere by one extra coordinate that fills
every vector up to the largest norm; queries have zero there.

Graphs are built, and searched, in lockstep: numpy moves a whole batch of
points through a layer at once, each with its own beam.  Queries are cut into
blocks; every block meets every shard of its dimension, and the shards' best
are merged.  Scores of what is found are inner products of the original
vectors in double precision.

Defined cases: vectors that are null, zero or hold null or non-finite
components take no part; vectors of different lengths never meet; ties go to
the smaller id; of a vector's copies as many ids are kept as a result can hold,
the smallest; a shard no larger than the beam is scanned whole; with fewer
candidates than ``k`` all are returned; rows of one id and one vector count
once, and an id with several vectors is judged by each of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import written

LINKS, BASE_LINKS, BUILD_BEAM, BATCH = 16, 32, 96, 256
_EMPTY = np.float32(-np.inf)


def search_layer(near: np.ndarray, vectors: np.ndarray, points: np.ndarray, entry: np.ndarray, beam: int):
    """Best nodes of one layer for each point: (numbers, nearness), best first, -1 where there are fewer.

    ``near`` has the neighbour numbers of each node (-1: none), ``entry`` the
    nodes that each point starts from.
    """
    many, nodes = len(points), len(vectors)
    seen = np.zeros((many, nodes + 1), bool)  # the last column stands for -1
    seen[:, nodes] = True
    row = np.arange(many)[:, None]
    numbers = np.full((many, beam), -1, np.int64)
    nearness = np.full((many, beam), _EMPTY, np.float32)
    width = min(entry.shape[1], beam)
    numbers[:, :width] = entry[:, :width]
    seen[row, entry] = True
    nearness[:, :width] = np.where(entry[:, :width] >= 0, np.einsum("qkd,qd->qk", vectors[entry[:, :width]], points), _EMPTY)
    opened = numbers < 0
    active = np.arange(many)
    step = 4  # nodes opened a turn
    while len(active):
        waiting = np.where(opened[active], _EMPTY, nearness[active])
        take = min(step, beam)
        best = np.argpartition(-waiting, take - 1, axis=1)[:, :take]
        worth = np.take_along_axis(waiting, best, 1) > _EMPTY
        still = worth.any(1)
        active, best, worth = active[still], best[still], worth[still]
        if not len(active):
            break
        at = np.arange(len(active))[:, None]
        mine = opened[active]
        mine[at, best] = True
        opened[active] = mine
        centre = np.where(worth, numbers[active[:, None], best], -1)
        met = np.where(centre[:, :, None] >= 0, near[centre], -1).reshape(len(active), -1)
        met = np.sort(met, axis=1)
        met[:, 1:][met[:, 1:] == met[:, :-1]] = -1
        met = np.where(seen[active[:, None], met], -1, met)
        seen[active[:, None], met] = True
        found = np.einsum("qkd,qd->qk", vectors[met], points[active])
        found[met < 0] = _EMPTY
        all_near = np.concatenate([nearness[active], found], 1)
        all_numbers = np.concatenate([numbers[active], met], 1)
        all_opened = np.concatenate([opened[active], met < 0], 1)
        keep = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        nearness[active] = np.take_along_axis(all_near, keep, 1)
        numbers[active] = np.take_along_axis(all_numbers, keep, 1)
        opened[active] = np.take_along_axis(all_opened, keep, 1)
    order = np.argsort(-nearness, axis=1, kind="stable")
    return np.take_along_axis(numbers, order, 1), np.take_along_axis(nearness, order, 1)


def choose_links(vectors: np.ndarray, numbers: np.ndarray, nearness: np.ndarray, links: int) -> np.ndarray:
    """For each row of candidates (best first) the nodes to link: each closer to the point than to those before it;
    what room is left goes to the nearest others."""
    many, width = numbers.shape
    there = vectors[numbers]
    between = np.matmul(there, there.transpose(0, 2, 1))
    valid = numbers >= 0
    chosen = np.zeros((many, width), bool)
    count = np.zeros(many, int)
    closest = np.full((many, width), _EMPTY, np.float32)  # nearness to the nearest chosen one
    for j in range(width):
        good = valid[:, j] & (count < links) & (closest[:, j] < nearness[:, j])
        chosen[good, j] = True
        count += good
        np.maximum(closest, between[:, j], out=closest, where=good[:, None])
    rest = valid & ~chosen
    place = np.cumsum(rest, 1)
    chosen |= rest & (place <= (links - count)[:, None])
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :links]
    out = np.where(np.take_along_axis(chosen, order, 1), np.take_along_axis(numbers, order, 1), -1)
    return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)


class Graph:
    """Layers of neighbour arrays over ``vectors`` (on a sphere); the highest nodes come first."""

    def __init__(self, vectors: np.ndarray, heights: np.ndarray):
        self.vectors = vectors
        self.sizes = [int((heights >= h).sum()) for h in range(int(heights.max(initial=0)) + 1)]
        self.layers: list[np.ndarray] = [None] * len(self.sizes)
        for h in reversed(range(len(self.sizes))):
            self._build(h)

    def _entry(self, points: np.ndarray, above: int) -> np.ndarray:
        entry = np.zeros((len(points), 1), np.int64)
        for h in range(len(self.sizes) - 1, above - 1, -1):
            entry, _ = search_layer(self.layers[h], self.vectors[: self.sizes[h]], points, entry, 4)
        return entry

    def _build(self, h: int) -> None:
        size, room = self.sizes[h], LINKS if h else BASE_LINKS
        vectors = self.vectors[:size]
        near = np.full((size, room), -1, np.int64)
        self.layers[h] = near
        done = 1
        while done < size:
            batch = np.arange(done, min(size, done + min(BATCH, max(8, done // 2))))
            points = vectors[batch]
            entry = self._entry(points, h + 1)[:, :1]
            entry = np.where(entry < done, entry, 0)  # the layer above holds nodes that this one has yet to take
            numbers, nearness = search_layer(near[:done], vectors[:done], points, entry, min(BUILD_BEAM, done))
            among = points @ points.T  # the batch's own points know each other directly
            among[np.triu_indices(len(batch))] = _EMPTY
            width = min(LINKS, len(batch))
            inner = np.argpartition(-among, width - 1, axis=1)[:, :width]
            inner_near = np.take_along_axis(among, inner, 1)
            numbers = np.concatenate([numbers, np.where(inner_near > _EMPTY, batch[inner], -1)], 1)
            nearness = np.concatenate([nearness, inner_near], 1)
            order = np.argsort(-nearness, axis=1, kind="stable")
            links = choose_links(vectors, np.take_along_axis(numbers, order, 1), np.take_along_axis(nearness, order, 1), LINKS)
            near[batch, :LINKS] = links
            self._link_back(near, vectors, batch, links, room)
            done += len(batch)

    @staticmethod
    def _link_back(near: np.ndarray, vectors: np.ndarray, batch: np.ndarray, links: np.ndarray, room: int) -> None:
        to, source = links.ravel(), np.repeat(batch, links.shape[1])
        source, to = source[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        widest = int(count.max(initial=0))
        more = np.full((len(nodes), widest), -1, np.int64)
        more[np.repeat(np.arange(len(nodes)), count), np.arange(len(to)) - np.repeat(first, count)] = source
        both = np.sort(np.concatenate([near[nodes], more], 1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        nearness = np.einsum("qkd,qd->qk", vectors[both], vectors[nodes])
        nearness[both < 0] = _EMPTY
        order = np.argsort(-nearness, axis=1, kind="stable")
        both, nearness = np.take_along_axis(both, order, 1), np.take_along_axis(nearness, order, 1)
        full = (both >= 0).sum(1) > room
        near[nodes[~full]] = both[~full, :room]
        if full.any():
            near[nodes[full]] = choose_links(vectors, both[full], nearness[full], room)

    def search(self, points: np.ndarray, beam: int) -> np.ndarray:
        """Numbers of the nodes found for each point, best first."""
        return search_layer(self.layers[0], self.vectors, points, self._entry(points, 1), min(beam, len(self.vectors)))[0]


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id`` and ``vector`` (array<float>) of rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        table.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("vector"))
        .where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    )


def build_index(vectors: DataFrame, copies: int, shard_nodes: int = 8192) -> DataFrame:
    """One row a shard: ``dim``, ``shard``, vectors, the ids of each node, and the layers; written to the shared folder."""
    keyed = vectors.distinct().select(
        "id", "vector", F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), F.reverse("vector")).alias("k2"))
    few = Window.partitionBy("k1", "k2").orderBy("id")
    nodes = written(
        keyed.withColumn("place", F.row_number().over(few)).where(F.col("place") <= copies)
        .groupBy("k1", "k2").agg(F.min_by("vector", "id").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("dim", F.size("vector")), "nodes")
    total, reach = nodes.agg(
        F.count(F.lit(1)), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()
    shards = max(1, -(-total // shard_nodes))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("k1", "k2"), F.lit(shards)).cast("int"))

    def build(key, table):
        table = table.sort_by([("k1", "ascending"), ("k2", "ascending")])
        raw = np.array(table["vector"].to_pylist(), np.float32).reshape(len(table), -1)
        draw = (np.array(table["k1"].to_pylist(), np.int64).view(np.uint64) >> np.uint64(11)).astype(np.float64) / 2**53
        heights = np.floor(-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int)
        order = np.argsort(-heights, kind="stable")
        raw, heights = raw[order], heights[order]
        lift = np.sqrt(np.maximum(0, reach - (raw.astype(np.float64) ** 2).sum(1))).astype(np.float32)
        graph = Graph(np.concatenate([raw, lift[:, None]], 1), heights)
        ids = table["ids"].to_pylist()
        return pa.table({
            "dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
            "vectors": pa.array([raw.tobytes()], pa.binary()),
            "ids": pa.array([[ids[i] for i in order]], pa.list_(pa.list_(pa.int64()))),
            "layers": pa.array([[x.astype(np.int32).tobytes() for x in graph.layers]], pa.list_(pa.binary())),
        })

    graphs = dealt.select("dim", "shard", "k1", "k2", "vector", "ids").groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, vectors binary, ids array<array<long>>, layers array<binary>")
    return written(graphs, "graphs")


def _opened(row: dict, dim: int) -> Graph:
    """A stored shard as a graph."""
    graph = Graph.__new__(Graph)
    raw = np.frombuffer(row["vectors"], np.float32).reshape(-1, dim)
    graph.vectors = np.concatenate([raw, np.zeros((len(raw), 1), np.float32)], 1)
    graph.layers = [np.frombuffer(x, np.int32).reshape(-1, BASE_LINKS if not h else LINKS).astype(np.int64) for h, x in enumerate(row["layers"])]
    graph.sizes = [len(x) for x in graph.layers]
    return graph


def nearest(
    queries: DataFrame, index: DataFrame, k: int = 20, beam: int = 160, block_queries: int = 512,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of the index for each query (``id``, ``vector``), itself left out."""
    queries = queries.distinct()
    blocks = max(1, -(-queries.count() // block_queries))
    shards = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("in_shard"))
    asked = queries.select(
        F.col("id").alias("query_id"), "vector", F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("in_block"),
    ).join(shards, F.col("dim") == F.col("of_dim")).drop("dim")
    stored = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(key, own, shard):
        if not len(own) or not len(shard):
            return out.empty_table()
        dim, row = key[0].as_py(), shard.to_pylist()[0]
        graph, ids = _opened(row, dim), row["ids"]
        raw = graph.vectors[:, :dim].astype(np.float64)
        points = np.array(own["vector"].to_pylist(), np.float32).reshape(len(own), dim)
        if len(raw) <= beam:
            found = np.tile(np.arange(len(raw)), (len(points), 1))
        else:
            lifted = np.concatenate([points, np.zeros((len(points), 1), np.float32)], 1)
            found = np.concatenate([graph.search(lifted[i : i + BATCH], beam) for i in range(0, len(points), BATCH)])
        rows = []
        for query, point, numbers in zip(own["query_id"].to_pylist(), points.astype(np.float64), found, strict=True):
            numbers = numbers[numbers >= 0]
            scores = raw[numbers] @ point
            best = sorted(zip((-scores).tolist(), numbers.tolist(), strict=True))[: k + 1]
            hits = sorted((s, i) for s, n in best for i in ids[n] if i != query)[:k]
            rows += [(query, i, -s) for s, i in hits]
        return pa.Table.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], schema=out) if rows else out.empty_table()

    hits = asked.groupBy("of_dim", "in_shard", "in_block").cogroup(stored.groupBy("dim", "shard", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
