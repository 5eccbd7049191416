"""Embedding near-duplicates: spherical k-means cells and blocked cosines.

1. Equal vectors are one vector with a weight.
2. Spherical k-means, fitted on a sample of at most ``SAMPLE_NUMBERS``
   numbers, gives about sqrt(n) cells (at most ``MAX_CELLS``). Every vector
   is a resident of the cell of its nearest centroid. It also visits each
   cell of a smaller number whose border is so near that a vector within the
   wanted angle may live behind it: the sine of the angle to the border is
   at most ``tan(angle) * reach * spread`` and never more than ``tan(angle)``.
   The spread is the share of a step that goes towards the border (root mean
   square), measured along each border normal on the sample and on its
   vectors in the cell, and at least that of a random direction, ``1 /
   sqrt(dim - 1)``. So a pair in two cells is compared in one of them, and in
   one only. (``reach >= sqrt(dim - 1)`` visits every cell where a link can
   be. Less can miss a pair whose step towards the border is more than
   ``reach`` spreads; vectors of few effective dimensions get the exact reach.)
3. In each cell products of blocks of unit vectors in double precision give
   the links. Only degrees and stars of the links leave the task, never the
   pairs. A cell of more than ``CHUNK`` residents is split; each part meets
   the later residents and all visitors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .graph import components, local_stars

THRESHOLD = 0.9
REACH = 3.5
MAX_CELLS = 8192
SAMPLE_NUMBERS = 1 << 22        # vectors times dimensions that k-means is fitted on
ITERATIONS = 8
FEW = 16                        # sampled vectors of a cell whose spread is measured
CHUNK = 2048
BLOCK = 1024                    # probes multiplied at once


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column, dim: int) -> np.ndarray:
    return unit(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))


def spherical_kmeans(x: np.ndarray, k: int, iterations: int = ITERATIONS) -> np.ndarray:
    """k unit centroids of unit vectors. Starts from the first k rows; an
    empty cell keeps its centroid."""
    c = x[:k].copy()
    for _ in range(iterations):
        home = np.concatenate([(x[i:i + 8192] @ c.T).argmax(1) for i in range(0, len(x), 8192)])
        by = np.argsort(home, kind="stable")
        cells, at = np.unique(home[by], return_index=True)
        sums = np.add.reduceat(x[by], at, axis=0)
        size = np.sqrt((sums * sums).sum(1))
        ok = size > 1e-9
        c[cells[ok]] = sums[ok] / size[ok, None]
    return c


def _valid(v, dim: int):
    """A vector of this length, finite throughout, that is not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) == dim) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def border_margins(x: np.ndarray, centroids: np.ndarray, threshold: float, reach: float) -> np.ndarray:
    """For a home cell (row) and another cell: by how much the products with
    the two centroids may differ for a vector at home to visit the other."""
    dim, angle = x.shape[1], np.tan(np.arccos(threshold))
    home = np.concatenate([(x[i:i + 8192] @ centroids.T).argmax(1) for i in range(0, len(x), 8192)])
    by = np.argsort(home, kind="stable")
    start = np.searchsorted(home[by], np.arange(len(centroids) + 1))
    all_x = x - x.mean(0)
    cov = all_x.T @ all_x
    along, total = centroids @ cov, max(np.trace(cov), 1e-12)
    own = (along * centroids).sum(1)
    out = np.empty((len(centroids), len(centroids)))
    for i, c in enumerate(centroids):
        gap2 = np.maximum(2 - 2 * centroids @ c, 1e-12)
        spread = (own[i] + own - 2 * centroids @ along[i]) / total
        here = x[by[start[i]:start[i + 1]]]
        if len(here) >= FEW:
            here = here - here.mean(0)
            step = here @ (c - centroids).T
            spread = np.maximum(spread, (step * step).sum(0) / max((here * here).sum(), 1e-12))
        spread = np.maximum(spread / gap2, 1 / max(dim - 1, 1))
        out[i] = angle * np.minimum(reach * np.sqrt(spread), 1.0) * np.sqrt(gap2)
    return out


def _cells(centroids: np.ndarray, margins: np.ndarray, dim: int):
    """Rows (cell, role, node, weight, vector): role 0 at home, 1 visiting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                own = b.slice(at, 4096)
                near = _matrix(own.column(2), dim) @ centroids.T
                home = near.argmax(1)
                rows = np.arange(len(home))
                visit = (near[rows, home][:, None] - near <= margins[home]) & (np.arange(len(centroids))[None, :] < home[:, None])
                v_row, v_cell = np.nonzero(visit)
                take = np.concatenate([rows, v_row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([home, v_cell]).astype(np.int32)),
                     pa.array(np.concatenate([np.zeros(len(rows), np.int8), np.ones(len(v_row), np.int8)])),
                     *[own.column(i).take(pa.array(take)) for i in (0, 1, 2)]],
                    names=["cell", "role", "node", "weight", "v"])

    return run


def _compare(dim: int, threshold: float):
    """Over rows sorted by (cell, part, role), residents of the part (role 0)
    first: degrees and stars of the links with it."""

    def meet(index: np.ndarray, node: np.ndarray, weight: np.ndarray, x: np.ndarray, x_node: np.ndarray,
             x_weight: np.ndarray, inside: bool) -> Iterator[pa.RecordBatch]:
        """Probes x against the residents; inside: x are residents themselves."""
        for i in range(0, len(x), BLOCK):
            hit = x[i:i + BLOCK] @ index.T >= threshold
            if inside:      # each pair once
                hit &= np.arange(len(index))[None, :] > np.arange(i, i + len(hit))[:, None]
            p, q = np.nonzero(hit)
            if not len(p):
                continue
            p = p + i
            a = np.bincount(p, weight[q], len(x)).astype(np.int64)
            b = np.bincount(q, x_weight[p], len(index)).astype(np.int64)
            u, v = local_stars(x_node[p], node[q])
            nodes = np.concatenate([x_node[a > 0], node[b > 0], u])
            other = np.concatenate([np.full(int((a > 0).sum() + (b > 0).sum()), -1), v])
            yield pa.RecordBatch.from_pydict({"node": nodes, "other": other,
                                              "n": np.concatenate([a[a > 0], b[b > 0], np.zeros(len(u), np.int64)])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done = None, [], False       # residents of the part at hand; whether they have met each other

        def residents():
            return tuple(np.concatenate(x) for x in zip(*held))

        def close() -> Iterator[pa.RecordBatch]:
            if held and not done:
                own = residents()
                yield from meet(*own, *own, True)

        for b in batches:
            cell, part = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            role, node, weight = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            edge = np.nonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (role[1:] != role[:-1]))[0] + 1
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(cell)]):
                if i == j:
                    continue
                now = int(cell[i]), int(part[i])
                if now != key:
                    yield from close()
                    key, held, done = now, [], False
                own = _matrix(b.column(5).slice(i, j - i), dim), node[i:j], weight[i:j]
                if role[i] == 0:
                    held.append(own)
                elif held:
                    if not done:
                        yield from close()
                        held, done = [residents()], True
                    yield from meet(*held[0], *own, False)
        yield from close()

    return run


def link_vectors(vectors: DataFrame, dim: int, threshold: float, reach: float, iterations: int) -> DataFrame:
    """``vectors(node, weight, v)``, distinct vectors -> ``(node, other,
    n)``: a part of node's number of links where other is -1, an edge of a
    star elsewhere."""
    total = vectors.count()
    sample = max(1, SAMPLE_NUMBERS // dim)
    chosen = vectors.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) <= int((1 << 20) * min(1.0, sample / max(total, 1))))
    got = chosen.orderBy(F.xxhash64("node")).select("v").toArrow()      # about ``sample`` vectors at most
    x = _matrix(got.column("v").combine_chunks(), dim) if got.num_rows else np.eye(1, dim)
    k = max(1, min(int(total ** 0.5), MAX_CELLS, len(x)))
    centroids = spherical_kmeans(x, k, iterations)
    margins = border_margins(x, centroids, threshold, reach)
    kind = vectors.schema["v"].dataType.simpleString()
    rows = vectors.select("node", "weight", "v").mapInArrow(
        _cells(centroids, margins, dim), f"cell int, role tinyint, node bigint, weight bigint, v {kind}")
    sizes = materialize(rows.where("role = 0").groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int")
                                                                   .alias("parts"))
                        .select(F.col("cell").alias("s_cell"), "parts"), "cells")     # a row for each cell
    rows = rows.join(F.broadcast(sizes), F.col("cell") == F.col("s_cell")) \
        .withColumn("own", F.when(F.col("role") == 0, F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
                    .otherwise(F.col("parts") - 1)) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("own")))) \
        .withColumn("role", F.when((F.col("role") == 0) & (F.col("part") == F.col("own")), 0).otherwise(1)
                    .cast("tinyint"))
    return rows.select("cell", "part", "role", "node", "weight", "v").repartition("cell", "part") \
        .sortWithinPartitions("cell", "part", "role") \
        .mapInArrow(_compare(dim, threshold), "node bigint, other bigint, n bigint")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, reach: float = REACH,
                    iterations: int = ITERATIONS, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    n_links is the number of other rows at cosine ``threshold`` or more that
    were compared, component_id the smallest id reachable by links, kept
    whether it is the row's own. Rows whose vector is null, zero, holds null
    or non-finite numbers, or has not the table's most frequent length link
    with nothing and keep their own id. Rows that repeat an id or a vector
    are rows of their own. A null id is no candidate for the smallest id; a
    row with a null id is not kept. An empty table gives no rows; other
    columns are ignored.
    """
    v = F.col(f"`{vector}`")
    common = embeddings.where(v.isNotNull()).groupBy(F.size(v).alias("dim")).count() \
        .orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = common[0]["dim"] if common else 0
    rows = embeddings.select(F.col(f"`{id}`").alias("vec_id"), v.alias("v"))
    rows = rows.withColumn("ok", _valid(F.col("v"), dim) if dim else F.lit(False)) \
        .withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))
    classes = rows.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"),
                                                       F.count(F.lit(1)).alias("weight"), F.first("v").alias("v"))
    vectors = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = materialize(link_vectors(vectors, max(dim, 1), threshold, reach, iterations), "links")
    degree = found.where("other = -1").groupBy(F.col("node").alias("d_node")).agg(F.sum("n").alias("links"))
    comp = components(found.where("other >= 0").select(F.col("node").alias("u"), F.col("other").alias("v"))) \
        .select(F.col("node").alias("c_node"), "component")
    named = vectors.drop("v").join(degree, F.col("node") == F.col("d_node"), "left") \
        .join(comp, F.col("node") == F.col("c_node"), "left") \
        .select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "rep",
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
                F.coalesce("component", "node").alias("component"))
    named = materialize(named, "classes")
    smallest = named.groupBy(F.col("component").alias("s_component")).agg(F.min("rep").alias("smallest"))
    named = named.join(smallest, F.col("component") == F.col("s_component")).select("k1", "k2", "links", "smallest")
    out = rows.select("vec_id", "ok", "h1", "h2") \
        .join(named, F.col("ok") & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    own = F.when(F.col("ok"), F.col("smallest")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
