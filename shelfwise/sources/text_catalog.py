"""Block-text catalogue source.

Records start with ``Id:`` and hold ``ASIN``, ``title``, ``group``,
``salesrank``, ``similar``, ``categories``, ``reviews`` lines and review
lines (``<date> cutomer: <id> rating: <n> votes: <n> helpful: <n>``; the
misspelling is part of the format). Reading with ``lineSep="\\nId:"``
gives one row per record -- still a splittable text scan -- and each field
is then extracted with anchored regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SEP = "\nId:"

# Fixed field patterns of the format (multi-line mode, anchored at the
# start of a line after optional indentation; [ \t] keeps a match on one
# line, [^\r\n] copes with CRLF files).
P_ID = r"^(?:Id:)?[ \t]+(\d+)"
P_ASIN = r"(?m)^[ \t]*ASIN:[ \t]+(\w+)"
P_TITLE = r"(?m)^[ \t]*title:[ \t]+([^\r\n]*\S)"
P_GROUP = r"(?m)^[ \t]*group:[ \t]+([^\r\n]*\S)"
P_SALESRANK = r"(?m)^[ \t]*salesrank:[ \t]+(\d+)"
P_SIMILAR = r"(?m)^[ \t]*similar:[ \t]+(\d+)[ \t]+(\S[^\r\n]*)"
P_CATEGORIES = r"(?m)^[ \t]*categories:[ \t]+(\d+)"
P_REVIEWS = r"(?m)^[ \t]*reviews:[ \t]+total:[ \t]+(\d+)[ \t]+downloaded:[ \t]+(\d+)[ \t]+avg rating:[ \t]+([\d.]+)"
P_REVIEW = (r"(?m)^[ \t]*(\d{4}-\d{1,2}-\d{1,2})[ \t]+cutomer:[ \t]+(\w+)[ \t]+rating:[ \t]+(\d+)"
            r"[ \t]+votes:[ \t]+(\d+)[ \t]+helpful:[ \t]+(\d+)")
BLANK_LINE = r"\r?\n[ \t]*\r?\n"


def _last(text: Column, pattern: str, group: int = 1) -> Column:
    """Value of the last line matching ``pattern`` (a later line of the
    same field overrides an earlier one), NULL when none matches."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), group), F.lit(-1))


def read_block_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (``value``) from block-text files."""
    return spark.read.option("lineSep", RECORD_SEP).text(path)


def parse_block_records(records: DataFrame, value_col: str = "value",
                        min_partitions: int | None = None) -> DataFrame:
    """Parse record rows into the block-text product fields plus a
    ``reviews`` array. Text after a blank line belongs to no record; a
    header without ``Id`` is dropped. ``min_partitions`` spreads a few
    large unsplittable inputs before the CPU-bound extraction."""
    if min_partitions and records.rdd.getNumPartitions() < min_partitions:
        records = records.repartition(min_partitions)
    body = F.get(F.split(F.col(value_col), BLANK_LINE), 0)
    rec = records.select(body.alias("_t"))
    t = F.col("_t")
    sim_count = _last(t, P_SIMILAR, 1).try_cast("int")
    sim_list = F.split(F.trim(_last(t, P_SIMILAR, 2)), r"[ \t]+")
    rv_total = _last(t, P_REVIEWS, 1).try_cast("bigint")
    # one scan of the record for whole review lines, then each short line
    # is split into its five fields
    review_lines = F.regexp_extract_all(t, F.lit(P_REVIEW), 0)
    reviews = F.when(rv_total > 0, F.transform(review_lines, lambda ln: F.struct(
        F.regexp_extract(ln, P_REVIEW, 1).alias("date"),
        F.regexp_extract(ln, P_REVIEW, 2).alias("customer_id"),
        F.regexp_extract(ln, P_REVIEW, 3).try_cast("bigint").alias("rating"),
        F.regexp_extract(ln, P_REVIEW, 4).try_cast("bigint").alias("votes"),
        F.regexp_extract(ln, P_REVIEW, 5).try_cast("bigint").alias("helpful"))))
    parsed = rec.select(
        F.regexp_extract(t, P_ID, 1).alias("_id"),
        _last(t, P_ASIN).alias("asin"),
        _last(t, P_TITLE).alias("title"),
        _last(t, P_GROUP).alias("group"),
        _last(t, P_SALESRANK).try_cast("bigint").alias("salesrank"),
        F.when(sim_count.isNotNull(), F.slice(sim_list, 1, F.greatest(sim_count, F.lit(0))))
         .alias("similar"),
        _last(t, P_CATEGORIES).try_cast("int").alias("categories_count"),
        rv_total.alias("reviews_total"),
        _last(t, P_REVIEWS, 2).try_cast("bigint").alias("reviews_downloaded"),
        _last(t, P_REVIEWS, 3).try_cast("double").alias("avg_rating"),
        reviews.alias("reviews"))
    return (parsed.where(F.col("_id") != "")
            .withColumn("source_id", F.col("_id").try_cast("bigint")).drop("_id")
            .select("source_id", "asin", "title", "group", "salesrank", "similar", "categories_count",
                    "reviews_total", "reviews_downloaded", "avg_rating", "reviews"))


def review_date(text: Column) -> Column:
    """The date of a review line, NULL for one that the calendar has not."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date")


def review_line_counts(parsed: DataFrame) -> DataFrame:
    """S4 for the block format: review lines in all, with an impossible date,
    and with a number that does not fit."""
    r = F.col("_r")
    bad_number = r.getField("rating").isNull() | r.getField("votes").isNull() | r.getField("helpful").isNull()
    return (parsed.select(F.explode("reviews").alias("_r"))
            .agg(F.count(F.lit(1)).alias("review_lines"), F.count_if(review_date(r.getField("date")).isNull()).alias("bad_dates"),
                 F.count_if(bad_number).alias("bad_numbers")))


def block_reviews(parsed: DataFrame) -> DataFrame:
    """N14 for the block format: one canonical review row per review line. An
    impossible date or an overlong number is NULL; the line's own date text
    stays in ``review_date_text``."""
    r = F.col("_r")
    return (parsed.select(F.col("asin").alias("product_id"), F.explode("reviews").alias("_r"))
            .select("product_id", r.getField("customer_id").alias("customer_id"),
                    r.getField("rating").cast("double").alias("rating"),
                    review_date(r.getField("date")).alias("review_date"), r.getField("date").alias("review_date_text"),
                    r.getField("helpful").alias("helpful_votes"),
                    r.getField("votes").alias("total_votes")))


def read_block_catalog(spark: SparkSession, path: str) -> DataFrame:
    return parse_block_records(read_block_text(spark, path))
