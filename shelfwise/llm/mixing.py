"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Native DataFrame operations only. Each source gets a word budget: a share of
the whole budget by its weight, stopped at ``max_epochs`` times its size, the
excess shared again by weight among the sources below their stop. Inside a
source every document has an exponential key, ``-ln(u) / quality weight``;
in the order of the keys the documents fill the budget by a prefix sum of
their sizes (Efraimidis and Spirakis, "Weighted random sampling with a
reservoir", 2006: the smallest keys are a weighted sample without
replacement). Complete epochs come first; the keys choose the rest.

A source's order is never sorted in one task: keys fall into many slices, the
slices' sums give each slice its offset, and only a slice is sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import running_count
from .common import WORD_RE, materialize, pack_rows, unpack_rows

SYMBOLS = "#*$%&|<>"
WEIGHTS = (3, 1, 2)         # by rank of the source, repeating
ROWS_PER_SLICE = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """1 for a text without symbol characters, down to 0.1 for nothing else."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    return 1 - 0.9 * (n - F.length(F.translate(t, SYMBOLS, ""))) / F.greatest(n, F.lit(1))


def sampling_key(id: Column, weight: Column, seed: int) -> Column:
    """``-ln(u) / weight`` with u in (0, 1) from a digest of the id, so that
    reruns agree however the rows are partitioned."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), id.cast("string")))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, budget: float, max_epochs: int, weights=WEIGHTS) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, size)``."""
    per = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running_count(per, [], [F.col("source").asc_nulls_last()], out="rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", w.alias("w"),
                                       (F.col("source_size") * max_epochs).cast("double").alias("stop")), "sources")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    want, level = budget * total, 0.0
    while True:             # each round is one small aggregate; the level only rises
        at = F.col("stop") <= F.col("w") * level
        stopped, open_w = ranked.agg(F.coalesce(F.sum(F.when(at, F.col("stop"))), F.lit(0.0)),
                                     F.coalesce(F.sum(F.when(~at, F.col("w"))), F.lit(0.0))).first()
        new = (want - stopped) / open_w if open_w else level
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.least("stop", F.col("w") * level).alias("target"))


def plan_mix(docs: DataFrame, budget: float = 1.5, max_epochs: int = 2, weights=WEIGHTS, seed: int = 7,
             quality=quality_weight, text: str = "text", source: str = "source", id: str = "doc_id") -> DataFrame:
    """What the mix takes of every row of ``docs``.

    Returns ``(doc_id, h, source, size, source_size, target, epochs, part,
    taken)``: h is a hash of the text, part the words taken beyond the
    complete epochs (all of a document's words, or for the one document at
    the budget's edge some of them) and taken = epochs * size + part.

    ``budget`` is a multiple of all sizes and at most ``max_epochs``.
    Sources rank by code point, null last (null is a source of its own). A
    null or empty text has size 0 and nothing is taken; a source without
    words has target 0. Repeated rows are separate documents; equal keys go
    by id, then text hash. Null ids share one key and go by text hash.
    ``quality`` gives a row's weight, above 0, from its text.
    """
    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{id}`").alias("doc_id"), F.xxhash64(t).alias("h"),
                       F.col(f"`{source}`").alias("source"), word_count(t).alias("size"),
                       sampling_key(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")), quality(t), seed)
                       .alias("key"))
    rows = materialize(rows, "sizes")
    targets = source_targets(rows, budget, max_epochs, weights)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0,
                                                  F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint"))
    slices = max(64, rows.count() // ROWS_PER_SLICE)
    rows = rows.withColumn("slice", F.floor((1 - F.exp(-F.col("key"))) * slices).cast("bigint"))
    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"),
                       F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    sums = sums.join(targets, F.col("s_source").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "h", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    part = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("offset") - F.col("ahead")))
    return out.withColumn("part", part).select(
        "doc_id", "h", "source", "size", "source_size", "target", "epochs", "part",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def mix(docs: DataFrame, budget: float = 1.5, max_epochs: int = 2, weights=WEIGHTS, seed: int = 7) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: a document stands once
    for each epoch and once more if at least half of it lies in the part
    beyond. Rows that repeat an id and its text share their copies."""
    takes = plan_mix(docs, budget, max_epochs, weights, seed) \
        .withColumn("copies", F.col("epochs") + (F.col("part") * 2 >= F.greatest("size", F.lit(1))).cast("int"))
    copies = takes.groupBy("doc_id", "h", "source").agg(F.sum("copies").cast("int").alias("copies"))
    copies = copies.where((F.col("copies") > 0))
    rows = pack_rows(docs, _id=F.col("doc_id"), _h=F.xxhash64("text"), _source=F.col("source")) \
        .groupBy("_id", "_h", "_source").agg(F.first("_row").alias("_row"))
    both = rows.join(copies, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("h"))
                     & F.col("_source").eqNullSafe(F.col("source")))
    return unpack_rows(both.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")))
