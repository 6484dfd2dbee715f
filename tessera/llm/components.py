"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, scratch


def local_roots(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest index of each of ``n`` local nodes' component under the edges (i, j), on top of ``root``."""
    root = np.arange(n) if root is None else root
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        for end in (i, j):
            np.minimum.at(root, root[end], low)
            np.minimum.at(root, end, low)
        root = np.minimum(root, root[root])
        if (root == before).all():
            break
    return root


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its smallest node.

    Each round points every node's current root at the smallest root next to it, then jumps
    pointers. Roots only fall, and a path of n nodes needs about log n rounds. Edges inside one
    component leave after each round. Rounds are written to shared storage; minima are
    aggregated before they are shuffled, so a node with very many edges is no hot spot. What is superseded is deleted at once.
    """
    edges = scratch(edges.select("a", "b").where("a <> b"), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    labels = scratch(nodes.select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        # a root hooks onto its smallest neighbour, if that is smaller
        parent = scratch(least.select(F.col("a").alias("root"), F.least("a", "b").alias("up"), F.lit(True).alias("moved")), "parents")
        while True:
            above = parent.select(F.col("root").alias("up"), F.col("up").alias("top"))
            jumped = scratch(
                parent.join(above, "up", "left").select("root", F.coalesce("top", "up").alias("up"), (F.col("top") < F.col("up")).alias("moved")),
                "jumps",
            )
            discard(parent)
            parent = jumped
            if jumped.where("moved").isEmpty():
                break
        before, known = labels, edges
        labels = scratch(
            labels.join(parent.select(F.col("root").alias("component"), "up"), "component", "left")
            .select("node", F.coalesce("up", "component").alias("component")),
            "labels",
        )
        up_a = parent.select(F.col("root").alias("a"), F.col("up").alias("ua"))
        up_b = parent.select(F.col("root").alias("b"), F.col("up").alias("ub"))
        moved = edges.join(up_a, "a").join(up_b, "b").where("ua <> ub")
        edges = scratch(moved.select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct(), "edges")
        discard(before, known, parent)
    discard(edges)
    return labels
