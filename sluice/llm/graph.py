"""Connected components over an edge table, by contraction.

Every round each vertex points to its smallest neighbour (a partial aggregate, so a hub
costs a row a task), pointers are followed to their roots by doubling, and the edges are
rewritten to the roots; every vertex that is left was a smallest one among its neighbours, so
the vertices with edges at least halve. Rounds are spooled to
the shared folder. Nothing is collected: neither edges nor components.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spool


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every vertex with an edge to another; component: the smallest id
    reachable. Loops, repeated and reversed edges are harmless; no edges, no rows."""
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    e, found = spool(e, "edges"), None
    while found is None or not e.isEmpty():
        ends = e.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(e.select(F.col("b").alias("id"), F.col("a").alias("to")))
        up = ends.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to"))
        up = spool(up, "up")
        while True:  # to the roots: the depth halves each time, and mostly is one or two
            over = up.select(F.col("id").alias("_m"), F.col("to").alias("_t"))
            jumped = spool(up.join(over, F.col("to") == F.col("_m")).select("id", F.col("_t").alias("to"), (F.col("_t") != F.col("to")).alias("moved")), "up")
            up = jumped.select("id", "to")
            if jumped.filter("moved").isEmpty():
                break
        left, right = up.select(F.col("id").alias("a"), F.col("to").alias("x")), up.select(F.col("id").alias("b"), F.col("to").alias("y"))
        e = spool(e.join(left, "a").join(right, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if found is None:
            found = up.select("id", F.col("to").alias("component"))
        else:
            found = found.join(up.select(F.col("id").alias("_m"), "to"), F.col("component") == F.col("_m"), "left").select("id", F.coalesce("to", "component").alias("component"))
        found = spool(found, "found")
    return found


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n vertices over the pairs (a, b)."""
    parent = np.arange(n)
    while len(a):
        x, y = parent[a], parent[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        keep = low < high
        if not keep.any():
            break
        a, b, low, high = a[keep], b[keep], low[keep], high[keep]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent
