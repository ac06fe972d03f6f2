"""Connected components of a link table, by contraction.

In each round every node points to the neighbour (or itself) with the smallest pseudo-random rank of that round, and
the links are rewritten between the nodes pointed to. Ranks change every round, so chains in the order of ids shrink
by a constant factor too. Nodes, links and maps stay tables; only the question whether links are left is asked by
the driver. A hub with very many links is pre-aggregated for the minimum and split by adaptive execution in joins.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from skyloom.llm.work import stored


def _simple(links: DataFrame, a: Column | str, b: Column | str) -> DataFrame:
    """Links between different nodes, each once, smaller node first."""
    pair = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return stored(pair.where("a < b").distinct(), "links")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link to another, from links (a, b) of longs. Roots are arbitrary members."""
    left, maps = _simple(links, "a", "b"), []
    while not left.isEmpty():
        rank = lambda node, seed=len(maps): F.struct(F.xxhash64(node, F.lit(seed)), node)
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        best = ends.groupBy("node").agg(F.min(rank(F.col("other"))).alias("best"))
        to = F.when(rank(F.col("node")) < F.col("best"), F.col("node")).otherwise(F.col("best.other"))
        maps.append(stored(best.select("node", to.alias("to")), "link-map"))
        on_a = maps[-1].select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        on_b = maps[-1].select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        left = _simple(left.join(on_a, "a").join(on_b, "b"), "to_a", "to_b")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = maps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(maps[:-1]):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = step.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return stored(roots, "roots")


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same components as (a, b), at most one per node: what a task hands on of its pairs."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
