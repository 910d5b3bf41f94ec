"""Connected components of an edge table, without moving edges to the driver.

Alternates large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014) until the edges stop changing. A
step is a grouped minimum joined back to the edges, so a hub with many
neighbours is pre-aggregated and its join side may be split by AQE.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Edges (a, b) of any orientable id -> rows (node, component).

    ``component`` is the smallest node reachable, itself included. Nodes
    without an edge are absent; self-loops, nulls and repeated edges are
    ignored; an empty table gives an empty table. Raises if ``max_rounds``
    rounds do not settle the edges, rather than return a wrong result.
    """
    now = edges.filter("a is not null and b is not null and a <> b")
    now = materialize(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        old, now = now, materialize(_small_star(_large_star(now).distinct()), "edges")
        discard(old)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between two id arrays -> (node, smallest node of its group).

    Used inside a task on one block of links: at most one edge per node
    leaves the block, however dense the block is.
    """
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
