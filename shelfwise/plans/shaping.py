"""Output shaping shared by registered plans: exact-comparable types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def shape(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 digits, small ints widened to bigint, dates as
    ``yyyy-MM-dd`` strings, arrays joined with commas."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), DIGITS)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)
