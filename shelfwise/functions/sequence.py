"""Positions and running counts under a global order, without hot tasks.

A window ``partitionBy(g).orderBy(o)`` sends a whole group to one task. For
open-ended groups (a category with a third of all products) the positions
are built instead from a range-partitioned sort: each row gets its offset
inside its (partition, group) slice, and the slice totals -- one row per
partition and group, a table bounded by partitions + groups -- are turned
into prefix offsets and joined back.

The range split is checkpointed (shared folder, reliable) before it is
used twice: range bounds come from sampling, so two evaluations of the
same plan could number rows against different bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def running_count(df: DataFrame, groups: Sequence[str], order: Sequence[Column],
                  flag: Column | None = None, out: str = "_pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = number of rows before this one in its group (0-based).

    ``order`` must be a total order inside each group (end it with a unique
    key). With ``flag`` (0/1 column) only flagged rows are counted, which
    lets a probe row learn how many data rows sort before it.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    weight = (flag if flag is not None else F.lit(1)).cast("bigint")
    group_cols = [F.col(g) for g in groups]
    ranged = materialize(df.withColumn("_w", weight)
                         .repartitionByRange(n, *group_cols, *order)
                         .withColumn("_pid", F.spark_partition_id()))
    # Local running count inside each (partition, group) slice; a slice is
    # at most one range partition, so the window never sees a whole group.
    local_w = (Window.partitionBy("_pid", *groups).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    with_local = ranged.withColumn("_local", F.coalesce(F.sum("_w").over(local_w), F.lit(0)))
    slices = ranged.groupBy("_pid", *groups).agg(F.sum("_w").alias("_slice"))
    prefix_w = (Window.partitionBy(*groups).orderBy("_pid")
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = slices.select("_pid", *groups,
                            F.coalesce(F.sum("_slice").over(prefix_w), F.lit(0)).alias("_offset"))
    # null-safe on the group keys: a NULL group is still a group
    o = offsets.select(F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_og{i}") for i, g in enumerate(groups)],
                       "_offset")
    cond = [with_local["_pid"] == o["_opid"]] + [with_local[g].eqNullSafe(o[f"_og{i}"]) for i, g in enumerate(groups)]
    return (with_local.join(o, cond)
            .withColumn(out, F.col("_local") + F.col("_offset"))
            .drop("_w", "_pid", "_local", "_offset", "_opid", *[f"_og{i}" for i in range(len(groups))]))
