"""JSON-lines catalogue sources.

``read_catalog_json`` is the plain scanner (explicit schema, no inference
pass; PERMISSIVE/DROPMALFORMED/FAILFAST; single quotes; multi-line).
``parse_catalog_lines`` is the tolerant ingest: a strict-ish parse with
reader options, a structural repair of trailing commas for lines that
still fail, and a ``status`` per line so bad lines are quarantined and
counted instead of silently dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CORRUPT_COLUMN, RAW_JSON_PRODUCT, RAW_JSON_PRODUCT_WITH_CORRUPT

TOLERANT_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowUnquotedFieldNames": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
}
# Fixed repair rule: drop a comma that directly precedes a closing brace
# or bracket. Quoted text is matched first and put back as it is.
TRAILING_COMMA = r"""("[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+')|,\s*([}\]])"""

PROBE_SCHEMA = "_probe string, _corrupt_record string"

STATUS_OK = "ok"
STATUS_PARTIAL = "partial"          # parsed; a field of the wrong type became NULL
STATUS_REPAIRED = "repaired"        # parsed after the trailing-comma repair
STATUS_MISSING_ASIN = "missing_asin"
STATUS_MALFORMED = "malformed"
STATUS_BLANK = "blank"
ACCEPTED = (STATUS_OK, STATUS_PARTIAL, STATUS_REPAIRED)
STATUSES = (*ACCEPTED, STATUS_MISSING_ASIN, STATUS_MALFORMED, STATUS_BLANK)


def read_catalog_json(spark: SparkSession, path: str, mode: str = "PERMISSIVE",
                      allow_single_quotes: bool = False, multiline: bool = False,
                      min_partitions: int | None = None) -> DataFrame:
    """Scan JSON-lines (or multi-line JSON) with the raw schema.

    In PERMISSIVE mode bad rows keep their text in ``_corrupt_record``.
    A ``.gz`` file is one unsplittable partition; ``min_partitions``
    spreads it out right after the scan.
    """
    schema = RAW_JSON_PRODUCT_WITH_CORRUPT if mode.upper() == "PERMISSIVE" else RAW_JSON_PRODUCT
    reader = (spark.read.schema(schema).option("mode", mode)
              .option("allowSingleQuotes", str(allow_single_quotes).lower())
              .option("multiLine", str(multiline).lower()))
    if mode.upper() == "PERMISSIVE":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    df = reader.json(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def _syntax_ok(text) -> "F.Column":
    """True when ``text`` is well-formed (with the tolerant options). The
    probe schema has no typed field, so only syntax can fail it."""
    probe = F.from_json(text, PROBE_SCHEMA, TOLERANT_OPTIONS)
    return probe.getField(CORRUPT_COLUMN).isNull()


def parse_catalog_lines(lines: DataFrame, value_col: str = "value", min_partitions: int | None = None) -> DataFrame:
    """S3: tolerant parse of one JSON record per line.

    Returns the raw record fields plus ``line`` (original text) and
    ``status``. Spark keeps partial records both for a field of the wrong
    type (accepted, that field NULL) and for broken syntax (rejected), so
    lines the typed parse flags get a syntax probe. Broken lines get one
    structural repair (trailing commas) and are quarantined if still bad.
    """
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        # parsing is CPU-bound; spread a few large inputs (e.g. one .gz)
        lines = lines.repartition(min_partitions)
    line = F.col("line")
    staged = lines.select(F.col(value_col).alias("line")).withColumn(
        "_a", F.from_json(line, RAW_JSON_PRODUCT_WITH_CORRUPT, TOLERANT_OPTIONS))
    flagged_a = F.col(f"_a.{CORRUPT_COLUMN}").isNotNull()
    staged = staged.withColumn("_sa", F.when(flagged_a, _syntax_ok(line)).otherwise(F.lit(True)))
    repaired = F.regexp_replace(line, TRAILING_COMMA, "$1$2")
    staged = staged.withColumn("_b", F.when(~F.col("_sa"), F.from_json(repaired, RAW_JSON_PRODUCT_WITH_CORRUPT,
                                                                        TOLERANT_OPTIONS)))
    flagged_b = F.col(f"_b.{CORRUPT_COLUMN}").isNotNull()
    staged = staged.withColumn("_sb", F.when(~F.col("_sa"), F.when(flagged_b, _syntax_ok(repaired))
                                             .otherwise(F.lit(True))))
    blank = F.trim(F.coalesce(line, F.lit(""))) == ""
    status = (F.when(blank, F.lit(STATUS_BLANK))
              .when(F.col("_sa") & F.col("_a.asin").isNotNull() & ~flagged_a, F.lit(STATUS_OK))
              .when(F.col("_sa") & F.col("_a.asin").isNotNull(), F.lit(STATUS_PARTIAL))
              .when(F.col("_sa"), F.lit(STATUS_MISSING_ASIN))
              .when(F.col("_sb") & F.col("_b.asin").isNotNull(), F.lit(STATUS_REPAIRED))
              .when(F.col("_sb"), F.lit(STATUS_MISSING_ASIN))
              .otherwise(F.lit(STATUS_MALFORMED)))
    rec = F.when(F.col("_sa"), F.col("_a")).when(F.col("_sb"), F.col("_b"))
    fields = [rec.getField(f.name).alias(f.name) for f in RAW_JSON_PRODUCT.fields]
    # A one-row ``inline`` per line is a plan barrier: without it Catalyst
    # substitutes the parse expressions into every later filter on
    # ``status``/``asin``, re-parsing each line once per reference.
    return staged.select(F.inline(F.array(F.struct(F.col("line"), status.alias("status"), *fields))))


def accepted(parsed: DataFrame) -> DataFrame:
    """Lines that produced a record with an asin."""
    return parsed.where(F.col("status").isin(*ACCEPTED) & (F.col("asin") != ""))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Non-blank lines that produced no usable record, with their text."""
    return parsed.where(~F.col("status").isin(*ACCEPTED, STATUS_BLANK)
                        | (F.col("status").isin(*ACCEPTED) & (F.col("asin") == ""))).select("line", "status")


def ingest_counts(parsed: DataFrame) -> DataFrame:
    """Number of lines per status (one small aggregation)."""
    return parsed.groupBy("status").agg(F.count(F.lit(1)).alias("lines"))


def require_valid(parsed: DataFrame) -> int:
    """Number of accepted lines; raises when there is none."""
    n = accepted(parsed).count()
    if n == 0:
        raise ValueError("No valid JSON products found in the dataset")
    return n


@dataclass(frozen=True)
class Ingested:
    """What one pass over the lines has written and counted."""

    accepted: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]      # lines by status, blank ones included


def ingest(parsed: DataFrame, path: str) -> Ingested:
    """S3 and S4 in one pass: records and quarantined lines are written to
    ``path`` (folders ``_kind=accepted`` and ``_kind=quarantine``; blank lines
    go), while the lines of each status are counted in flight.

    The counts come from the tasks whose output was committed. Raises when
    no record was accepted, as :func:`require_valid` does.
    """
    seen = Observation("ingest")
    usable = F.col("status").isin(*ACCEPTED) & (F.col("asin") != "")
    kind = F.when(usable, F.lit("accepted")).when(F.col("status") != STATUS_BLANK, F.lit("quarantine"))
    counted = parsed.observe(seen, *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES],
                             F.count(F.when(usable, 1)).alias("_usable"))
    counted.withColumn("_kind", kind).where("_kind is not null") \
        .write.mode("overwrite").partitionBy("_kind").parquet(path)
    counts = dict(seen.get)
    if not counts.pop("_usable"):
        raise ValueError("No valid JSON products found in the dataset")
    rows = parsed.sparkSession.read.schema(StructType([*parsed.schema, StructField("_kind", StringType())])).parquet(path)
    of = lambda k: rows.where(F.col("_kind") == k).drop("_kind")
    return Ingested(of("accepted"), of("quarantine").select("line", "status"), counts)


def read_catalog_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """S3 from files: ``spark.read.text`` (splittable for plain text)."""
    return parse_catalog_lines(spark.read.text(path), min_partitions=min_partitions)
