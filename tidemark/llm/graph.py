"""Connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored


def local_roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a[i]`` and ``b[i]``; ``parent`` points every node straight at the smallest of its set."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        parent = parent.copy()
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = parent[parent]
            if np.array_equal(shorter, parent):
                break
            parent = shorter


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, component`` for every node of ``links`` (``u, v``), the component being its smallest node.

    Alternates large and small stars until nothing changes: every round joins each node's neighbours to its smallest
    neighbour. Links are held as rows only, each round is written to the shared folder, and rounds grow with the
    logarithm of the longest chain. Hot nodes are split by the adaptive skew join.
    """
    edges = stored(
        links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "components",
    )

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    before = state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # every larger neighbour of u is tied to the smallest node around u
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # u and its smaller neighbours are tied to the smallest of them
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "components")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(edges.select("v", "v").toDF("node", "component")).distinct()
