"""Structured Streaming ingest of JSON-lines catalogue files.

The batch parser is a pure Column transformation, so the same function
runs on a file stream: each micro-batch splits into accepted records
(canonical products and reviews appended as Parquet) and quarantined
lines, each written to its own ``batch_id`` partition. Progress lives in the
checkpoint folder that the caller names, so a restarted query resumes
exactly where it stopped and a replayed batch overwrites its own output. A
product that comes in several batches has a row in each; ``read_products``
gives one row for each id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import dedupe_products, products_from_raw, reviews_from_raw
from ..session import materialize, scratch_scope
from ..sources.json_catalog import accepted, parse_catalog_lines, quarantine


def catalog_line_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of parsed catalogue lines (with ``status``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_catalog_lines(reader.load(source_dir))


def _write_batch(out_dir: str):
    """Each micro-batch overwrites its own ``batch_id=<n>`` partition, so a
    batch replayed after a failure replaces its earlier output instead of
    appending it twice (exactly-once output with the source offsets)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        with scratch_scope(batch.sparkSession):
            parsed = materialize(batch, "batch")        # read three times, parsed once
            good = accepted(parsed)
            products_from_raw(good).write.mode("overwrite").parquet(f"{out_dir}/products/{part}")
            reviews_from_raw(good).write.mode("overwrite").parquet(f"{out_dir}/reviews/{part}")
            quarantine(parsed).write.mode("overwrite").parquet(f"{out_dir}/quarantine/{part}")
    return run


def read_products(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row for each product id over all batches (the catalogue's rule:
    best sales rank first)."""
    return dedupe_products(spark.read.parquet(f"{out_dir}/products").drop("batch_id"))


def start_catalog_ingest(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                         available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream; ``available_now`` processes the files that
    exist and stops (incremental batch), else it keeps watching.
    ``checkpoint_dir`` is a lasting shared folder of this stream's own."""
    writer = (catalog_line_stream(spark, source_dir, max_files_per_trigger).writeStream
              .foreachBatch(_write_batch(out_dir)).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
