"""Connected components of a link table, by alternating large and small stars (Kiveris et al., 2014).

Each round is a map-side combined minimum and a join; no neighbour list is ever collected, so a node with a third of
all links is only a skewed join key.  Rounds are written to the shared folder, which ends the lineage.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from changeloom.session import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link (columns ``a``, ``b``; loops and nulls are ignored): root is the smallest node
    reachable."""
    a, b = F.col("a"), F.col("b")
    edges = written(
        edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    before = None
    while (now := _mark(edges)) != before:
        before = now
        both = edges.union(edges.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter(b > a).select(b.alias("a"), F.col("m").alias("b")).filter(a != b).distinct()
        large = written(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(b.alias("a"), F.col("m").alias("b")), F.struct(a.alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*").filter(a != b).distinct()
        edges = written(small, "small-star")
    roots = edges.select(a.alias("node"), b.alias("root"))
    return roots.union(roots.select("root", "root").distinct())


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest item reachable from each of n items by links a-b: a task's own links shrink to n at most."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (jumped := label[label]).tobytes() != label.tobytes():
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label
