"""Connected components of a graph given as edges: local forests and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import staged

#: Edges that one task joins into trees at once.
LOT_EDGES = 1_000_000


def local_roots(i, j, size: int):
    """Per place 0 to ``size`` - 1 the smallest place that the pairs (i, j) reach."""
    label = np.arange(size)
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        # Hang the roots, not only the ends, on the smaller one; then point everything at its root.
        np.minimum.at(label, before[i], least)
        np.minimum.at(label, before[j], least)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            return label


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a task as stars: each node with the smallest node that the task's edges reach."""
    held = [part for part in parts if len(part)]
    if not held:
        return
    edges = pd.concat(held)
    nodes, places = np.unique(np.concatenate([edges["a"].to_numpy(), edges["b"].to_numpy()]), return_inverse=True)
    root = local_roots(places[:len(edges)], places[len(edges):], len(nodes))
    mine = np.flatnonzero(root != np.arange(len(nodes)))
    yield pd.DataFrame({"a": nodes[mine], "b": nodes[root[mine]]})


def components(edges: DataFrame, lot_edges: int = LOT_EDGES) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that has a link: root is the smallest node that links reach.

    The edges are dealt into tasks of about ``lot_edges``, and each task turns its own into stars. While there are
    several tasks, a round then hangs all larger neighbours of a node on its smallest one and all smaller ones, by
    joins that a skewed hub can't hold up. Nothing but a count and a checksum reaches the driver; each round is written
    to the shared folder.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        lots = -(-now.count() // lot_edges) or 1
        trees = now.coalesce(lots).mapInPandas(_forest, "a long, b long")
        now = staged(trees if lots == 1 else trees.distinct(), "forest")
        if lots == 1:
            break
        pairs = now.union(now.select("b", "a")).toDF("a", "b")
        least = pairs.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = pairs.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(small.union(least).distinct(), "small-star")
        found = now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
