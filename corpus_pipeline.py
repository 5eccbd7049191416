"""The corpus pipeline: five stages from ``documents`` to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last keep the columns of ``documents`` (and any others that docs has). Null
and empty texts pass through every stage by the rules of its operator: they
score like any text, hold no lines to delete, share the fingerprint zero, and
are no words to mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import line_dedup, mixing, quality, sentencepiece_codec, simhash
from shelfwise.llm.common import table
from shelfwise.session import drop_table, scratch_path, scratch_scope


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines aligned with an earlier document go from the text;
    n_chars is counted anew where the text has changed."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (4-word shingles, 4 bits)."""
    return simhash.keep_representatives(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to 150 % of all words; a document stands once for every
    epoch the mix takes of it."""
    return mixing.mix(docs, budget=1.5, max_epochs=2, weights=(3, 1, 2), seed=7)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, source, ids, n_tokens)`` of every mixed document."""
    return sentencepiece_codec.encode(docs, keep=("lang", "source"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", cut_lines),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]

# Model fitting, alignment, fingerprints and token ids are not expressible in
# SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. A stage's scratch tables go when its
    output is written, and the output once the next stage's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"{name.replace(' ', '-')}-{uuid.uuid4().hex}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop_table(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
