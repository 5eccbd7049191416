"""The pipeline, stage by stage, against what its operators say."""
from collections import Counter

import corpus_pipeline
from llm_fixtures import SF, empty, messy  # noqa: F401
from pyspark.sql import functions as F
from test_duplicates import brute_components, plain_simhash

from shelfwise.llm import line_dedup, mixing, quality, sentencepiece_codec

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(k, spark, docs, sf_dir=SF):
    return corpus_pipeline.STAGES[k][1](spark, docs, sf_dir)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    good = stage(0, spark, docs).cache()
    said = {r["doc_id"]: r["predicted"] for r in quality.score_documents(docs, marks).collect()}
    assert good.columns == COLUMNS
    assert {r[0] for r in good.select("doc_id").collect()} == {d for d, p in said.items() if p}
    truth = {r["doc_id"]: r["quality"] for r in marks.collect()}
    assert sum(truth[d] == said[d] for d in truth) >= 0.95 * len(truth)

    lines = stage(1, spark, good).cache()
    assert lines.columns == COLUMNS and lines.count() == good.count()
    assert lines.where(F.length("text") != F.col("n_chars")).count() == 0
    want = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(good).collect()}
    before = {r["doc_id"]: r["text"] for r in good.collect()}
    after = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert after == want and any(after[d] != before[d] for d in after)
    for d, t in after.items():      # only lines that an earlier document has are gone
        gone = Counter(before[d].split("\n")) - Counter(t.split("\n"))
        earlier = {x for e, s in before.items() if e < d for x in s.split("\n")}
        assert all(x in earlier for x in gone if x.strip())

    one = stage(2, spark, lines).cache()
    assert one.columns == COLUMNS
    ids = sorted(after)
    comp = brute_components(ids, [plain_simhash(after[d]) for d in ids])
    assert {r[0] for r in one.select("doc_id").collect()} == set(comp)

    mixed = stage(3, spark, one).cache()
    assert mixed.columns == COLUMNS
    plan = {r["doc_id"]: r for r in mixing.plan_mix(one).collect()}
    copies = Counter(r[0] for r in mixed.select("doc_id").collect())
    assert copies == +Counter({d: r["epochs"] + (2 * r["part"] >= max(r["size"], 1)) for d, r in plan.items()})

    ids = stage(4, spark, mixed)
    back = sentencepiece_codec.decode(ids)
    text = {r["doc_id"]: r["text"] for r in one.collect()}
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter({(d, text[d]): n for d, n in copies.items()})


def test_run_has_the_rows_of_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens"] and out.count() > 0


def test_messy_and_empty_documents(spark, messy, empty):
    for docs in (messy, empty):
        for k in range(5):
            out = stage(k, spark, docs)
            assert (out.columns == docs.columns) == (k < 4)
            assert out.count() <= 2 * docs.count()
