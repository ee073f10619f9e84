"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_class, checkpointed


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, n): every node with the least of itself and its neighbours and their number, for edges (u, v)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every larger (large) or smaller (small) neighbour of a node, and the node, on the least of them."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = by_class(both, _least(both), ["u"], "n").where("v > u").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))
    else:
        least = _least(both)  # edges run from the larger to the smaller end
        hung = by_class(both, least, ["u"], "n").select(F.col("v").alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); the component is its smallest node.

    Each round is a few aggregations and joins over the edges left, which never grow; a checkpoint in the shared folder
    ends it, and the rounds end when nothing changes.  Edges of hubs meet a broadcast minimum.  No edges give an empty
    result.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct()
    )
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40)), F.sum(F.xxhash64("b", "a") % (1 << 40))).first()
    before, after = None, mark(now)
    while after[0] and after != before:
        now = checkpointed(_star(checkpointed(_star(now, large=True)), large=False))
        before, after = after, mark(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def local_forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links (i, j) among n nodes connect: each node with its component's least node."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[label]
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]
