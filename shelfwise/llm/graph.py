"""Connected components of an edge list, on Spark.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each round re-points every node
to the smallest neighbour it sees, until the edges are stars around the
smallest node of each component. Every step is a partially aggregated
``min`` per node and a join with it. Both sides of the join are tables in the
shared folder, so adaptive execution can split the edges of a node that has
very many: it cannot where a table meets its own aggregate in one plan.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def local_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace edges by (node, smallest node of its component) of this edge
    set alone: the same reachability with fewer rows than nodes."""
    if not len(u):
        return u, v
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        np.minimum.at(root, high, low)
        while not (root[root] == root).all():
            root = root[root]
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _is_star_forest(edges: DataFrame) -> bool:
    """Every child has one parent and no node is both."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("hi").alias("node"), F.lit(1).alias("c"), F.lit(0).alias("p")),
        F.struct(F.col("lo").alias("node"), F.lit(0).alias("c"), F.lit(1).alias("p")))).alias("e")).select("e.*")
    bad = ends.groupBy("node").agg(F.sum("c").alias("c"), F.max("p").alias("p")).where("c > 1 or (c = 1 and p = 1)")
    return bad.agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one orderable type -> ``(node, component)`` for
    every node with an edge, component being the smallest reachable node.
    Self links and repeated edges are allowed; an empty input gives no rows.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
                    .distinct(), "edges")
    while not _is_star_forest(e):
        both = e.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
                                          F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e")) \
            .select("e.*")
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                          .select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("hi"),
                                                                              F.col("m").alias("lo")).distinct()
        large = materialize(large, "edges")
        low = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("k"), "m"), "low")
        small = large.join(low, F.col("hi") == F.col("k")).select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        e = materialize(small.where("hi <> lo").distinct(), "edges")
    parents = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(parents)
