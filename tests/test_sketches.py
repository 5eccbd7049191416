"""Mergeable distinct counts and counts taken in flight."""
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfwise.operators import sketches
from shelfwise.sources import json_catalog


@pytest.mark.parametrize("n", [0, 7, 5_000, 300_000])
def test_merged_sketches(spark, n, tmp_path):
    df = spark.range(3 * n).selectExpr(f"if(id % 11 = 0, null, id % {max(n, 1)}) as a", "cast(id % 3 as string) as b", "id % 40 as m")
    sketches.distinct_sketches(df, ["a", "b"], F.col("m")).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    got = sketches.merge_sketches(stored, ["a", "b"]).first()
    exact = df.agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")).first()
    assert got == sketches.merge_sketches(sketches.distinct_sketches(df, ["a", "b"]), ["a", "b"]).first()
    assert all(abs(got[c] - exact[c]) <= sketches.error_bound() * exact[c] for c in "ab")
    half = sketches.merge_sketches(stored.where("cast(part as int) < 20"), ["b"]).first()     # any set of parts
    assert half["b"] == exact["b"]


def test_one_pass_ingest(spark, tmp_path):
    lines = ['{"asin": "A", "title": "x"}', "{'asin': 'B', 'price': 'dear'}", '{"asin": "C",}', '{"title": "none"}', "{broken", "", "  ",
             '{"asin": ""}', '{"asin": "A", "title": "x"}', None]
    parsed = json_catalog.parse_catalog_lines(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3))
    done = json_catalog.ingest(parsed, str(tmp_path / "out"))
    assert {k: v for k, v in done.counts.items() if v} == {r["status"]: r["lines"] for r in json_catalog.ingest_counts(parsed).collect()}
    assert sum(done.counts.values()) == len(lines)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(done.accepted) == rows(json_catalog.accepted(parsed))
    assert rows(done.quarantine) == rows(json_catalog.quarantine(parsed))
    with pytest.raises(ValueError):
        json_catalog.ingest(parsed.where("status = 'malformed'"), str(tmp_path / "bad"))


def test_sketches_of_the_reviews_are_small(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    size = sketches.distinct_sketches(orders, ["o_custkey"]).select(F.length("o_custkey")).first()[0]
    assert size <= 2 ** sketches.LG + 64
