"""Connected components of an edge table, by alternating star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stage


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same nodes as the pairs (a, b): each node with the least
    of its component. At most one edge a node, whatever the number of pairs."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        least = np.minimum(label[x], label[y])
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        np.minimum.at(label, before, label)  # a node's old label learns its new one
        label = label[label]
        if (label == before).all():
            break
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the least node of the component, for every node of
    `edges` (u long, v long) but the roots. Each round links a node's neighbours
    to the least of them, first the larger neighbours, then the smaller ones; the
    least is found by a partial and a final aggregation, so a node with many
    neighbours is not gathered anywhere. Rounds are staged tables and stop when
    the edges no longer change."""
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        return tuple(r)

    seen = mark(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")) \
            .select("e.u", "e.v").where("u <> v").distinct()
        now = stage(small, "edges")
        last, seen = seen, mark(now)
        if seen == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("connected components did not settle")
