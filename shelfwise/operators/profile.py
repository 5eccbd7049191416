"""Dataset utilities (U1-U4): sampling, one-pass profile, safe ratio,
display join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import order_by, safe_divide

DEFAULT_FRACTION = 0.1
DEFAULT_SEED = 42
DISPLAY_COLUMNS = ["product_id", "title", "category", "average_rating", "review_count", "sales_rank"]


def sample(df: DataFrame, fraction: float = DEFAULT_FRACTION, seed: int = DEFAULT_SEED) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def profile(df: DataFrame) -> DataFrame:
    """One aggregation pass; long form with one row per column:
    name, type, position, null count, mean and sample stddev (numeric
    columns), plus the table's row and column counts."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"))
        if isinstance(f.dataType, NumericType):
            aggs.append(F.avg(F.col(f.name)).alias(f"_m{i}"))
            aggs.append(F.stddev_samp(F.col(f.name)).alias(f"_s{i}"))
    one = df.agg(*aggs)
    entries = []
    for i, f in enumerate(fields):
        numeric = isinstance(f.dataType, NumericType)
        entries.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(i).alias("position"),
            F.col(f"_n{i}").alias("null_count"),
            (F.col(f"_m{i}") if numeric else F.lit(None)).cast("double").alias("mean"),
            (F.col(f"_s{i}") if numeric else F.lit(None)).cast("double").alias("stddev")))
    return (one.select(F.col("_rows").alias("row_count"), F.lit(len(fields)).alias("column_count"),
                       F.explode(F.array(*entries)).alias("_e"))
            .select("row_count", "column_count", "_e.*"))


def safe_ratio(num, den, default: float = 0.0):
    """``num / den``, ``default`` when the denominator is 0 or NULL."""
    return safe_divide(F.col(num) if isinstance(num, str) else num,
                       F.col(den) if isinstance(den, str) else den, default)


def display_join(recs: DataFrame, products: DataFrame, score_cols: list[str] | None = None) -> DataFrame:
    """U4: recommendations with the catalogue's display columns, best rated
    first, then by sales rank; only the key and score columns of ``recs``
    are kept, so no name is ambiguous."""
    keep = [c for c in recs.columns if c not in DISPLAY_COLUMNS or c == "product_id"]
    if score_cols is not None:
        keep = ["product_id", *score_cols]
    return (recs.select(*keep).join(products.select(*DISPLAY_COLUMNS), "product_id")
            .orderBy(*order_by(("average_rating", "desc"), ("sales_rank", "asc"), ("product_id", "asc"))))
