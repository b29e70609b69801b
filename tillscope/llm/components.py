"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (``a``, ``b``); a label is the smallest node of its component.

    In each round every node of the remaining graph points to its smallest
    neighbour or itself, pointers are followed to their ends by doubling, links
    are rewritten to where their ends lead, and those within one node vanish.  Tables stay in Spark; only a count of the
    remaining links reaches the driver.  The pointer table of a round is
    written before it is joined, so that a node with very many links can be
    split by the engine's skew handling.  Tables of a finished round are deleted.

    Defined cases: a link with a null end is left out; a link of a node with
    itself adds nothing; links that repeat count once; no links give no rows.
    """
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = written(nodes.withColumn("label", F.col("node")), "labels")
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        pointers = written(
            both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to")), "pointers")
        moved = 1
        while moved:  # pointers of pointers, until all lead to nodes that point to themselves
            pointer = pointers.select("node", "to")
            onward = pointer.select(F.col("node").alias("to"), F.col("to").alias("on"))
            jumped = written(
                pointer.join(onward, "to").select("node", F.col("on").alias("to"), (F.col("on") != F.col("to")).alias("moved")), "pointers")
            moved = jumped.where("moved").limit(1).count()
            discard(pointers)
            pointers = jumped
        pointer = pointers.select("node", "to")
        relabelled = written(
            labels.join(pointer, labels["label"] == pointer["node"], "left")
            .select(labels["node"], F.coalesce("to", "label").alias("label")), "labels")
        a = pointer.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        b = pointer.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        rest = edges.join(a, "a").join(b, "b").where("new_a <> new_b")
        fewer = written(
            rest.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), "edges")
        discard(labels, edges, pointers)
        labels, edges = relabelled, fewer
    discard(edges)
    return labels
