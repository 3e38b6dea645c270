"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Table


def min_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each node's component, for nodes 0..n-1 and edges a-b (array union by minimum).

    Every node points at its root before roots are hooked, so a hook never overwrites a link that no open edge repeats."""
    root = np.arange(n)
    while a.size:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(nxt := root[root], root):
            root = nxt
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _contract(edges: DataFrame, key: str) -> DataFrame:
    """One large-star and one small-star step on ``(key, a, b)`` with a > b.

    Both steps only need the smallest neighbour per node, which aggregates map-side, and a join back; a
    node that touches a third of all edges is never collected. Merge hints keep a round's table, which is
    sized by its compressed files, from being broadcast.
    """
    both = edges.union(edges.select(key, F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(key, "a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = (both.where("b > a").join(low.hint("merge"), [key, "a"]).select(key, F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a > b").distinct())
    low2 = large.groupBy(key, "a").agg(F.min("b").alias("m"))
    linked = large.join(low2.hint("merge"), [key, "a"])
    return (linked.select(key, F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
            .union(low2.select(key, "a", F.col("m").alias("b"))).distinct())


def connected_roots(edges: DataFrame, key: str = "slide_id") -> DataFrame:
    """``(key, node, root)`` for every node of an edge table ``(key, a, b)``; root is the smallest node of
    the component.

    Contraction rounds over the whole cluster, whatever the size, each written to the shared folder with a
    fingerprint that tells when nothing changes. A replaced round is dropped.
    """
    norm = (edges.where("a != b")
            .select(key, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    stamp = {"n": F.count(F.lit(1)), "h": F.bit_xor(F.xxhash64(key, "a", "b"))}
    cur = Table(norm, **stamp)
    done = not cur.metrics["n"]
    while not done:
        nxt = Table(_contract(cur.df, key), **stamp)
        done = nxt.metrics == cur.metrics
        cur.drop()
        cur = nxt
    stars = cur.df.select(key, F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(key, F.col("root").alias("node"), "root").distinct())
