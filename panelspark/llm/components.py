"""Connected components of an edge table, and a spanning forest inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import reliable_checkpoint


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is the smallest node reachable.

    Alternates large-star and small-star rounds: every node hands its larger (then its smaller)
    neighbours to its smallest one, until the edges form stars. The number of rounds grows with
    the logarithm of the longest path. Each round writes a reliable checkpoint; minima are
    aggregated before the shuffle and the joins may be split by AQE, so a hub is no hot task.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = reliable_checkpoint(e)
    before = _signature(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = reliable_checkpoint(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(e)
        if after == before:
            break
        before = after
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


class Forest:
    """Labels of n nodes; ``link`` joins the ends of edges, nodes of one tree share a label."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        label = self.label
        while True:
            p, q = label[x], label[y]
            apart = p != q
            if not apart.any():
                return
            x, y, p, q = x[apart], y[apart], p[apart], q[apart]
            np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
            while True:  # point every node at its root
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
