"""Column-level helpers: comparisons, safe conversions, orderings, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"

# Comparison operators accepted by the threshold queries.
COMPARATORS = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "=": lambda c, v: c == v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def compare(column: str | Column, op: str, value) -> Column:
    """``column <op> value`` for op in ``> >= = < <=``; other ops raise."""
    if op not in COMPARATORS:
        raise ValueError(f"Unsupported operator: {op}")
    c = F.col(column) if isinstance(column, str) else column
    return COMPARATORS[op](c, F.lit(value))


def safe_int(c: Column, default: int = 0) -> Column:
    """Integer value of ``c`` (numbers, numeric strings) else ``default``.

    A fractional value truncates toward zero like ``int()``.
    """
    as_double = c.try_cast("double")
    return F.coalesce(c.try_cast("bigint"), as_double.try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_divide(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` and ``default`` when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def order_by(*spec: tuple[str, str]) -> list[Column]:
    """Sort expressions from ``(column, 'asc'|'desc')`` pairs, nulls last."""
    out = []
    for name, direction in spec:
        c = F.col(name)
        out.append(c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last())
    return out


def top_n(df: DataFrame, n: int | None, order: Sequence[Column], rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows under ``order`` (TakeOrderedAndProject); ``None`` = all.

    ``rank_col`` adds the 1-based position; the window runs over at most
    ``n`` rows after the limit.
    """
    if n is None:
        if rank_col:
            # whole result ranked without a single-partition window
            from .sequence import running_count
            ranked = running_count(df, [], order, out=rank_col)
            return ranked.withColumn(rank_col, F.col(rank_col) + 1).orderBy(*order)
        return df.orderBy(*order)
    out = df.orderBy(*order).limit(n)
    if rank_col:
        out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    return out


def top_n_per_group(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column],
                    rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per key group; ``row_number() <= n`` is planned as a
    WindowGroupLimit, which trims every map task to ``n`` rows per key
    before the shuffle, so a hot key never reaches one task whole. The
    optimizer does so up to a threshold, which is raised to ``n`` if lower."""
    conf = df.sparkSession.conf
    if n > int(conf.get(GROUP_LIMIT_CONF)):
        conf.set(GROUP_LIMIT_CONF, str(n))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
