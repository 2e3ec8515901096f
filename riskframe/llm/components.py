"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its component.

    ``edges`` has bigint columns u, v in any direction; loops and repeats do no harm.  Every round is
    a few joins on node ids and is checkpointed; the number of rounds grows with the logarithm of
    the component's size.
    """
    e = cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = cut(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 32)))).head())
        if now == state:
            roots = e.select(F.col("v").alias("node")).distinct()
            return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .unionByName(roots.select("node", F.col("node").alias("root"))))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of n items, linked by the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    return root
