"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# A word everywhere in this package: a run of anything but ASCII white
# space. ``bytes.split()`` splits on exactly these characters.
WORD_RE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["WORD_RE", "ascii_lower", "map_batches", "materialize", "pack_rows", "table", "texts_of", "unpack_rows"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would fold every script)."""
    return F.translate(col, UPPER, LOWER)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it returns the output columns by
    name, in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = pa.RecordBatch.from_pydict(fn(b))
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def pack_rows(df: DataFrame, **keys: Column) -> DataFrame:
    """Keep whole rows in one struct beside computed keys, so no column of
    the input can clash with a name used inside an operator."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                     *[c.alias(n) for n, c in keys.items()])


def unpack_rows(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (the finaliser of splitmix64; its constants
    are fixed values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
