"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterflow.llm.tables import discard, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges(a, b)``.

    Alternates two steps until nothing changes: every node's larger neighbours are
    tied to its least neighbour, then its smaller ones are. Edges never grow in number,
    and a node with any number of neighbours is one row of an aggregate and a
    joined key, which Spark splits.
    """
    e = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(larger.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = stored(tied.distinct(), "small-star")
        now = _state(small)
        discard(e, large)
        e = small
        if now == state:
            break
        state = now
    members = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = e.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return members.unionByName(heads.distinct())


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining places ``a`` with places ``b``; a root is the least place of its set."""
    while True:
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            return root
        a, b = a[live], b[live]
        np.minimum.at(root, np.maximum(ra[live], rb[live]), np.minimum(ra[live], rb[live]))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
