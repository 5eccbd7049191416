"""Distinct counts that can be stored and merged (opt-in forms of Q18 and E3).

The exact counts stay the default. A sketch (HyperLogLog, ``2^lg`` registers) of
each partition of a table -- a month of reviews, say -- is a few kilobytes
whatever the partition's size. Counts over any set of partitions come from the
stored sketches alone, so a new month costs a pass over that month only. The
relative standard error is ``1.04 / sqrt(2^lg)``, 0.8 % by default.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 14     # registers of a sketch, as a power of two


def error_bound(lg: int = LG, deviations: float = 4.0) -> float:
    """Relative error that an estimate stays within but for a chance below
    one in ten thousand."""
    return deviations * 1.04 / sqrt(2 ** lg)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Column | None = None, lg: int = LG) -> DataFrame:
    """``(part, <column>...)``: one sketch of each column for each value of ``by``
    (one of all rows without it). Nulls are no values; they are not counted.
    A null ``by`` is a part of its own."""
    part = F.lit(None).cast("string") if by is None else by.cast("string")
    some = [F.hll_sketch_agg(F.col(c), lg).alias(c) for c in columns]
    return df.withColumn("part", part).groupBy("part").agg(*some)


def merge_sketches(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the estimated distinct count of each column over all
    parts given; 0 where there is none. Every sketch is read twice: one that
    was never merged is estimated in another way, and a count must not depend
    on how the rows were parted."""
    sketches = sketches.unionAll(sketches)
    both = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).cast("bigint").alias(c) for c in columns]
    return sketches.agg(*both)
