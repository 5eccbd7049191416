import os
import tempfile

from pyspark.sql import functions as F

from shelfwise.operators import normalize
from shelfwise.sources import json_catalog, sinks, text_catalog

BLOCK = """# catalogue export
Total items: 4

Id:   71
ASIN: ZX00000071
  title: Field Guide to Moss: Second Walk
  group: Book
  salesrank: 5120
  similar: 3  ZX00000072  ZX90000001  ZX90000002
  categories: 2
   |Nature[11]|Plants[12]|Moss[13]
   |Nature[11]|Walks[14]
  reviews: total: 4  downloaded: 4  avg rating: 3.5
    2012-2-9  cutomer: READERONE  rating: 4  votes:   3  helpful:   1
    2012-2-30  cutomer: READERTWO  rating: 5  votes:   0  helpful:   0
    2013-11-1  cutomer: READERONE  rating: 3  votes:  99999999999999999999  helpful:   2
    2014-1-20  cutomer: READERSIX  rating: 2  votes:   8  helpful:   8

Id:   72
ASIN: ZX00000072
  title: Rain Songs
  group: Music
  salesrank: 88
  similar: 2  ZX00000071  ZX00000071
  categories: 0
  reviews: total: 0  downloaded: 0  avg rating: 0
Id:   73
ASIN: ZX00000073
  similar: 0
  salesrank: -1
Id:   74
ASIN: ZX00000074
  title: After a record without a blank line
"""


def _write(text, name, crlf=False):
    d = tempfile.mkdtemp(prefix="shelfwise-test-")
    p = os.path.join(d, name)
    with open(p, "w", newline="") as fh:
        fh.write(text.replace("\n", "\r\n") if crlf else text)
    return p


def test_block_text(spark):
    for crlf in (False, True):
        parsed = text_catalog.read_block_catalog(spark, _write(BLOCK, "cat.txt", crlf))
        got = {r.source_id: r for r in parsed.collect()}
        assert sorted(got) == [71, 72, 73, 74]
        first = got[71]
        assert (first.asin, first.title, first.group, first.salesrank) == (
            "ZX00000071", "Field Guide to Moss: Second Walk", "Book", 5120)
        assert first.similar == ["ZX00000072", "ZX90000001", "ZX90000002"] and first.categories_count == 2
        assert (first.reviews_total, first.avg_rating) == (4, 3.5) and len(first.reviews) == 4
        assert got[72].similar == ["ZX00000071", "ZX00000071"] and got[72].avg_rating == 0.0 and got[72].reviews is None
        assert got[73].similar is None and got[73].salesrank is None and got[73].title is None
        assert got[74].title == "After a record without a blank line"


def test_bad_review_lines_are_kept_and_counted(spark):
    parsed = text_catalog.read_block_catalog(spark, _write(BLOCK, "cat.txt"))
    got = {r.review_date_text: r for r in text_catalog.block_reviews(parsed).collect()}
    assert len(got) == 4 and str(got["2012-2-9"].review_date) == "2012-02-09"
    assert got["2012-2-30"].review_date is None and got["2012-2-30"].rating == 5.0
    assert got["2013-11-1"].total_votes is None and got["2013-11-1"].helpful_votes == 2
    assert tuple(text_catalog.review_line_counts(parsed).first()) == (4, 1, 1)


def test_text_catalogue_is_canonical(spark):
    from shelfwise.operators import recommend, search
    from shelfwise.schemas import PRODUCTS
    parsed = text_catalog.read_block_catalog(spark, _write(BLOCK + BLOCK.split("\n", 2)[2], "cat.txt"))
    products = normalize.text_to_canonical(parsed)
    assert [(f.name, f.dataType) for f in products.schema.fields] == [(f.name, f.dataType) for f in PRODUCTS.fields]
    rows = {r.product_id: r for r in products.collect()}
    assert sorted(rows) == ["ZX00000071", "ZX00000072", "ZX00000073", "ZX00000074"] and products.count() == 4
    bare = rows["ZX00000073"]
    assert (bare.title, bare.category, bare.sales_rank, bare.price, bare.brand, bare.average_rating) == (
        "Unknown", "General", 9999999, 0.0, "Unknown", 4.0)
    assert search.complex_query(products, max_price=5.0, min_reviews=1).first().product_id == "ZX00000071"
    assert recommend.popularity(products, None, 1).first().product_id == "ZX00000072"


def test_repair_leaves_quoted_text_alone(spark):
    lines = ['{"asin": "Q1", "title": "odd ,} text", "price": 2,}', "{'asin': 'Q2', 'title': 'it ,] ends', 'price': 3,}",
             '{"asin": "Q3", "title": "a \\" ,} b", }']
    df = json_catalog.parse_catalog_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {r.asin: r.title for r in json_catalog.accepted(df).collect()}
    assert got["Q1"] == "odd ,} text" and got["Q2"] == "it ,] ends"


JSON_LINES = [
    '{"asin": "A1", "title": "Good", "price": 9.5, "categories": [["Books", "X"]], "salesRank": {"Books": 5},'
    ' "related": {"also_viewed": ["V1"], "bought_together": ["T1"]}, "rating": 4.5,'
    ' "reviews": [{"reviewerID": "r1", "overall": 5.0, "helpful": [2, 3], "vote": "4"},'
    ' {"reviewerID": "", "overall": 4}, {"reviewerID": "r2", "overall": 0}, {"reviewerID": "r3", "overall": 6},'
    ' {"reviewerID": "r4", "overall": "5.0", "helpful": 7}]}',
    "{'asin': 'A2', 'title': 'Single'}",
    '{asin: "A3", title: "Bare"}',
    '{"asin": "A4", "title": "Trailing",}',
    '{"asin": "A5", "tit',
    '',
    '{"title": "No asin"}',
    '{"asin": "A6", "salesRank": 77, "categories": [[]], "related": {}}',
    '{"asin": "A7", "categories": [], "rating": 9}',
    '{"asin": "A1", "title": "Duplicate", "salesRank": {"Books": 9}}',
]


def _lines(spark):
    return spark.createDataFrame([(x,) for x in JSON_LINES], "value string")


def test_json_statuses_and_quarantine(spark):
    parsed = json_catalog.parse_catalog_lines(_lines(spark))
    counts = {r.status: r.lines for r in json_catalog.ingest_counts(parsed).collect()}
    assert counts == {"ok": 5, "partial": 1, "repaired": 1, "malformed": 1, "blank": 1, "missing_asin": 1}
    q = {r.line for r in json_catalog.quarantine(parsed).collect()}
    assert q == {'{"asin": "A5", "tit', '{"title": "No asin"}'}
    assert json_catalog.require_valid(parsed) == 7


def test_json_normalisation(spark):
    good = json_catalog.accepted(json_catalog.parse_catalog_lines(_lines(spark)))
    products = {r.product_id: r for r in normalize.products_from_raw(good).collect()}
    assert products["A1"].title == "Good" and products["A1"].sales_rank == 5  # best rank wins the dedupe
    assert products["A1"].similar_products == ["V1"] and products["A1"].category == "Books"
    assert products["A2"].title == "Single" and products["A2"].category == "Books"
    assert products["A2"].sales_rank == 9999999 and products["A2"].description == "No description"
    assert products["A6"].category == "Books" and products["A6"].category_count == 1
    assert products["A7"].category_count == 0
    reviews = normalize.reviews_from_raw(good)
    got = sorted((r.customer_id, r.rating, r.helpful_votes) for r in reviews.where("product_id = 'A1'").collect())
    assert got == [("r1", 5.0, 2), ("r4", 5.0, 7)]
    parser = {r.product_id: r for r in normalize.parser_products(good).collect() if r.title != "Duplicate"}
    assert parser["A1"].similar == ["V1", "T1"] and parser["A1"].group == "Books"
    assert parser["A7"].avg_rating == 5.0 and parser["A2"].avg_rating == 0.0 and parser["A2"].group == "General"
    assert parser["A1"].reviews_total == 2


def test_json_scanner_modes(spark):
    p = _write("\n".join(JSON_LINES[:1] + JSON_LINES[4:5]), "c.json")
    permissive = json_catalog.read_catalog_json(spark, p)
    got = permissive.select("asin", "_corrupt_record").collect()
    assert len(got) == 2 and sum(r._corrupt_record is not None for r in got) == 1
    dropped = json_catalog.read_catalog_json(spark, p, mode="DROPMALFORMED")
    assert [r.asin for r in dropped.collect()] == ["A1"]


def test_sinks_roundtrip(spark, shop):
    d = tempfile.mkdtemp(prefix="shelfwise-sink-")
    sinks.write_csv(shop.products, f"{d}/csv", single_file=True)
    back = sinks.read_csv(spark, f"{d}/csv")
    assert back.count() == 9 and back.where("product_id = 'G-30'").first().similar_products == '["G-31"]'
    sinks.write_parquet(shop.products, f"{d}/pq", partition_by=["category"])
    assert spark.read.parquet(f"{d}/pq").count() == 9


def test_streaming_ingest(spark):
    from shelfwise.streaming.catalog_stream import start_catalog_ingest
    src = tempfile.mkdtemp(prefix="shelfwise-src-")
    out = tempfile.mkdtemp(prefix="shelfwise-out-")
    ckpt = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    with open(os.path.join(src, "part-1.json"), "w") as fh:
        fh.write("\n".join(JSON_LINES[:5]) + "\n")
    q = start_catalog_ingest(spark, src, out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{out}/products").count() == 4
    assert spark.read.parquet(f"{out}/quarantine").count() == 1
    # a new file is picked up by the next run; old files are not re-read
    with open(os.path.join(src, "part-2.json"), "w") as fh:
        fh.write(JSON_LINES[7] + "\n")
    q = start_catalog_ingest(spark, src, out, ckpt)
    q.awaitTermination(120)
    products = spark.read.parquet(f"{out}/products")
    assert products.count() == 5 and "batch_id" in products.columns
    from shelfwise.streaming.catalog_stream import read_products
    with open(os.path.join(src, "part-3.json"), "w") as fh:
        fh.write(JSON_LINES[9] + "\n")      # an id of the first batch again
    start_catalog_ingest(spark, src, out, ckpt).awaitTermination(120)
    assert spark.read.parquet(f"{out}/products").count() == 6
    assert {r.product_id: r.title for r in read_products(spark, out).collect()}["A1"] == "Good"
    products = spark.read.parquet(f"{out}/products").where("title <> 'Duplicate'")
    # replaying a batch (same id) replaces its output instead of duplicating it
    from shelfwise.streaming.catalog_stream import _write_batch
    again = json_catalog.parse_catalog_lines(spark.createDataFrame([(JSON_LINES[7],)], "value string"))
    last = max(r.batch_id for r in products.select("batch_id").distinct().collect())
    _write_batch(out)(again, last)
    assert spark.read.parquet(f"{out}/products").count() == 6


def test_json_scanner_multiline_failfast_and_gzip(spark):
    import gzip
    import pytest as _pytest
    multi = _write('[{"asin": "M1",\n "title": "one"},\n {"asin": "M2", "title": "two"}]', "m.json")
    got = json_catalog.read_catalog_json(spark, multi, multiline=True)
    assert sorted(r.asin for r in got.select("asin").collect()) == ["M1", "M2"]
    bad = _write(JSON_LINES[0] + "\n" + JSON_LINES[4] + "\n", "bad.json")
    with _pytest.raises(Exception):
        json_catalog.read_catalog_json(spark, bad, mode="FAILFAST").select("asin").collect()
    quoted = _write(JSON_LINES[1] + "\n", "q.json")
    assert json_catalog.read_catalog_json(spark, quoted, allow_single_quotes=True).select("asin").first().asin == "A2"
    d = tempfile.mkdtemp(prefix="shelfwise-gz-")
    with gzip.open(os.path.join(d, "c.json.gz"), "wt") as fh:
        fh.write("\n".join(JSON_LINES[:4]) + "\n")
    gz = json_catalog.read_catalog_lines(spark, d, min_partitions=4)
    assert gz.rdd.getNumPartitions() >= 4
    assert json_catalog.accepted(gz).count() == 4
