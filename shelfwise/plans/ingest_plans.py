"""Registered ingest plans: catalogue text rendered from ``part`` (see
sources/testdata.py) is parsed back; the oracle states the expected rows
straight from ``part``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import order_by
from ..functions.sequence import running_count
from ..operators import normalize, recommend, search
from ..session import materialize, scratch_path
from ..sources import json_catalog, text_catalog
from ..sources.testdata import block_records_from_part, json_lines_from_part
from .registry import PLANS, plan

JSON_STATUS = """
st AS (SELECT p.*, p.p_partkey AS pk,
              CASE WHEN p_partkey % 10 = 5 THEN 'blank' WHEN p_partkey % 10 = 3 THEN 'malformed'
                   WHEN p_partkey % 37 = 0 THEN 'missing_asin' WHEN p_partkey % 10 = 2 THEN 'repaired'
                   WHEN p_partkey % 19 = 0 AND p_partkey % 7 <> 0 THEN 'partial' ELSE 'ok' END AS status
       FROM part p),
acc AS (SELECT * FROM st WHERE status IN ('ok', 'partial', 'repaired')),
rv AS (SELECT pk, i, (pk + i) % 7 AS v FROM (SELECT pk, unnest(range(pk % 4)) AS i FROM acc)
       WHERE NOT (i = 1 AND pk % 8 = 1) AND (pk + i) % 7 BETWEEN 1 AND 5),
rs AS (SELECT pk, count(*) AS n, avg(v) AS a FROM rv GROUP BY pk)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _parallelism(spark) -> int:
    return spark.sparkContext.defaultParallelism


def _text_records(spark, d, records=None):
    records = block_records_from_part(spark, d) if records is None else records
    return text_catalog.parse_block_records(records, min_partitions=_parallelism(spark))


def _parsed(spark, d):
    return json_catalog.parse_catalog_lines(json_lines_from_part(spark, d), min_partitions=_parallelism(spark))


@plan("json_ingest", _with(JSON_STATUS, """
SELECT 'P' || pk AS product_id, 'P' || pk AS asin,
       CASE WHEN pk % 23 = 0 THEN 'Unknown' ELSE p_name END AS title,
       CASE WHEN pk % 11 = 0 OR pk % 13 = 0 OR pk % 17 = 0 THEN 'Books' ELSE p_type END AS category,
       CAST(CASE WHEN pk % 7 = 0 OR pk % 19 = 0 THEN 9999999 ELSE p_size * 1000 END AS BIGINT) AS sales_rank,
       '' AS image_url, 'No description' AS description, round(p_retailprice, 6) AS price, p_brand AS brand,
       CASE pk % 4 WHEN 0 THEN 'P' || (pk + 1) || ',P' || (pk + 2) WHEN 1 THEN 'P' || (pk + 5) || ',,P' || (pk + 5)
                   WHEN 2 THEN 'P' || (pk + 7) ELSE '' END AS similar_products,
       CAST(CASE WHEN pk % 11 = 0 OR pk % 13 = 0 THEN 0 WHEN pk % 17 = 0 THEN 1 ELSE 2 END AS BIGINT) AS category_count,
       coalesce(rs.n, 0) AS review_count, round(coalesce(rs.a, 4.0), 6) AS average_rating
FROM acc LEFT JOIN rs USING (pk)"""))
def q_json_ingest(spark, d):
    # read by products and reviews: parsed once; every third line comes twice
    lines = json_lines_from_part(spark, d)
    lines = lines.unionByName(lines.where(F.pmod(F.length("value"), F.lit(3)) == 0))
    parsed = materialize(json_catalog.accepted(json_catalog.parse_catalog_lines(lines, min_partitions=_parallelism(spark))),
                         "parsed")
    products = normalize.products_from_raw(parsed)
    reviews = normalize.reviews_from_raw(parsed).distinct()
    return normalize.enrich_review_stats(products, reviews)


@plan("json_quarantine_counts", _with(JSON_STATUS, "SELECT status, count(*) AS lines FROM st GROUP BY status"))
def q_json_quarantine_counts(spark, d):
    return json_catalog.ingest_counts(_parsed(spark, d))


@plan("json_ingest_one_pass", _with(JSON_STATUS, """
SELECT status, count(*) AS lines, CASE WHEN status = 'blank' THEN 0 ELSE count(*) END AS written FROM st GROUP BY status"""))
def q_json_ingest_one_pass(spark, d):
    """Lines counted in flight, beside the rows that the same pass wrote."""
    done = json_catalog.ingest(_parsed(spark, d), scratch_path(spark, f"ingest-{uuid.uuid4().hex}"))
    lines = spark.createDataFrame(list(done.counts.items()), "status string, lines bigint").where("lines > 0")
    rows = done.accepted.select("status").unionByName(done.quarantine.select("status")).groupBy("status") \
        .agg(F.count(F.lit(1)).alias("written"))
    return lines.join(rows, "status", "left").select("status", "lines", F.coalesce("written", F.lit(0)).cast("bigint").alias("written"))


@plan("embedded_reviews", _with(JSON_STATUS, """
SELECT 'P' || pk AS product_id, 'U' || ((pk * 7 + i) % 50) AS customer_id, CAST(v AS DOUBLE) AS rating,
       '2020-01-0' || (i + 1) AS review_date, CAST(pk % 5 AS BIGINT) AS helpful_votes,
       CAST(i + pk % 3 AS BIGINT) AS total_votes
FROM rv"""))
def q_embedded_reviews(spark, d):
    return normalize.reviews_from_raw(json_catalog.accepted(_parsed(spark, d)))


@plan("parser_products", _with(JSON_STATUS, """
SELECT 'P' || pk AS product_id, 'P' || pk AS asin, CASE WHEN pk % 23 = 0 THEN '' ELSE p_name END AS title,
       CASE WHEN pk % 11 = 0 OR pk % 13 = 0 OR pk % 17 = 0 THEN 'General' ELSE p_type END AS "group",
       CAST(CASE WHEN pk % 7 = 0 OR pk % 19 = 0 THEN 9999999 ELSE p_size * 1000 END AS BIGINT) AS salesrank,
       CASE pk % 4 WHEN 0 THEN 'P' || (pk + 1) || ',P' || (pk + 2) || ',P' || (pk + 3) WHEN 1 THEN 'P' || (pk + 5)
                   WHEN 2 THEN 'P' || (pk + 7) ELSE '' END AS similar,
       CAST(CASE WHEN pk % 11 = 0 OR pk % 13 = 0 THEN 0 WHEN pk % 17 = 0 THEN 1 ELSE 2 END AS BIGINT) AS categories_count,
       coalesce(rs.n, 0) AS reviews_total, coalesce(rs.n, 0) AS reviews_downloaded,
       round(CASE WHEN pk % 9 = 0 THEN coalesce(rs.a, 0.0) WHEN pk % 29 = 0 THEN 5.0 ELSE p_size / 10 END, 6)
         AS avg_rating
FROM acc LEFT JOIN rs USING (pk)"""))
def q_parser_products(spark, d):
    return normalize.parser_products(json_catalog.accepted(_parsed(spark, d)))


@plan("parser_canonical", f"""
SELECT product_id, asin, title, "group" AS category, salesrank AS sales_rank, '' AS image_url,
       'No description' AS description, CAST(0.0 AS DOUBLE) AS price, 'Unknown' AS brand, "similar" AS similar_products,
       categories_count AS category_count, reviews_total AS review_count, avg_rating AS average_rating
FROM ({PLANS["parser_products"].sql})""")
def q_parser_canonical(spark, d):
    return normalize.parser_to_canonical(normalize.parser_products(json_catalog.accepted(_parsed(spark, d))))


TEXT_SQL = """
SELECT p_partkey AS source_id, 'B' || p_partkey AS asin,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS title,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS "group",
       CASE WHEN p_partkey % 13 = 0 OR p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size * 1000 AS BIGINT) END AS salesrank,
       CASE WHEN p_partkey % 13 = 0 OR p_partkey % 4 = 0 THEN NULL
            ELSE array_to_string(list_transform(range(1, p_partkey % 4 + 1), lambda i: 'S' || (p_partkey + i)), ',')
       END AS similar,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_partkey % 3 AS BIGINT) END AS categories_count,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_partkey % 3 AS BIGINT) END AS reviews_total,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_partkey % 3 AS BIGINT) END AS reviews_downloaded,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE round(p_size / 10, 6) END AS avg_rating
FROM part"""


@plan("text_ingest", TEXT_SQL)
def q_text_ingest(spark, d):
    return _text_records(spark, d).drop("reviews")


TEXT_REVIEW_LINES = """
FROM (SELECT p_partkey AS pk, unnest(range(p_partkey % 3)) AS i FROM part WHERE p_partkey % 13 <> 0)"""


@plan("text_reviews", """
SELECT 'B' || pk AS product_id, 'C' || ((pk * 3 + i) % 40) AS customer_id, CAST((pk + i) % 5 + 1 AS DOUBLE) AS rating,
       CASE WHEN pk % 17 <> 0 THEN strftime(make_date(2001, CAST(i + 1 AS INTEGER), CAST(pk % 28 + 1 AS INTEGER)), '%Y-%m-%d')
       END AS review_date,
       CASE WHEN pk % 17 = 0 THEN '2001-2-30' ELSE '2001-' || (i + 1) || '-' || (pk % 28 + 1) END AS review_date_text,
       CAST(i AS BIGINT) AS helpful_votes, CASE WHEN pk % 19 <> 0 THEN CAST(i + 2 AS BIGINT) END AS total_votes"""
      + TEXT_REVIEW_LINES)
def q_text_reviews(spark, d):
    return text_catalog.block_reviews(_text_records(spark, d))


@plan("text_review_line_counts", """
SELECT count(*) AS review_lines, count(*) FILTER (pk % 17 = 0) AS bad_dates, count(*) FILTER (pk % 19 = 0) AS bad_numbers"""
      + TEXT_REVIEW_LINES)
def q_text_review_line_counts(spark, d):
    return text_catalog.review_line_counts(_text_records(spark, d))


TEXT_CANONICAL_SQL = f"""
SELECT asin AS product_id, asin, coalesce(title, 'Unknown') AS title, coalesce("group", 'General') AS category,
       coalesce(salesrank, 9999999) AS sales_rank, '' AS image_url, 'No description' AS description,
       CAST(0.0 AS DOUBLE) AS price, 'Unknown' AS brand, coalesce("similar", '') AS similar_products,
       coalesce(categories_count, 0) AS category_count, coalesce(reviews_total, 0) AS review_count,
       coalesce(avg_rating, 4.0) AS average_rating
FROM ({TEXT_SQL})"""


def _text_products(spark, d):
    """Canonical products of the block text, some records of which come twice."""
    records = block_records_from_part(spark, d)
    again = records.where(F.pmod(F.length("value"), F.lit(3)) == 0)
    return normalize.text_to_canonical(_text_records(spark, d, records.unionByName(again)))


@plan("text_canonical", TEXT_CANONICAL_SQL)
def q_text_canonical(spark, d):
    return _text_products(spark, d)


@plan("text_catalog_search", f"""
WITH c AS ({TEXT_CANONICAL_SQL})
SELECT 'filter' AS kind, product_id, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM c WHERE average_rating >= 2.0 AND sales_rank <= 40000 AND price <= 10.0
UNION ALL
SELECT 'popular', product_id, row_number() OVER (ORDER BY sales_rank, average_rating DESC, product_id) AS rank
FROM c WHERE average_rating >= 3.5 OR sales_rank <= 100000 QUALIFY rank <= 10""")
def q_text_catalog_search(spark, d):
    products = materialize(_text_products(spark, d), "text-products")
    found = search.search(products, "complex", min_rating=2.0, max_salesrank=40_000, max_price=10.0)
    found = running_count(found.select("sales_rank", "product_id"), [], order_by(*search.BY_RANK), out="rank")
    popular = recommend.popularity(products, None, 10)
    return found.select(F.lit("filter").alias("kind"), "product_id", (F.col("rank") + 1).alias("rank")).unionByName(
        popular.select(F.lit("popular").alias("kind"), "product_id", F.col("rank").cast("bigint").alias("rank")))


@plan("json_scan_modes", """
WITH l AS (
  SELECT p_partkey % 10 AS d, p_partkey % 37 = 0 AS plain, p_partkey % 19 = 0 AND p_partkey % 7 <> 0 AS mistyped
  FROM part WHERE p_partkey % 10 <> 5),
c AS (
  SELECT mistyped OR d = 3 OR (d IN (1, 2, 4) AND NOT plain) AS strict,
         mistyped OR d = 3 OR (d IN (2, 4) AND NOT plain) AS quoted FROM l)
SELECT 'permissive' AS mode, count(*) AS rows, count(*) FILTER (strict) AS corrupt FROM c
UNION ALL SELECT 'permissive, single quotes', count(*), count(*) FILTER (quoted) FROM c
UNION ALL SELECT 'drop malformed', count(*) FILTER (NOT strict), 0 FROM c""")
def q_json_scan_modes(spark, d):
    """The rendered lines as files, scanned in each mode."""
    path = scratch_path(spark, f"lines-{uuid.uuid4().hex}")
    json_lines_from_part(spark, d).write.text(path)
    out = []
    for name, options in (("permissive", {}), ("permissive, single quotes", {"allow_single_quotes": True}),
                          ("drop malformed", {"mode": "DROPMALFORMED"})):
        df = json_catalog.read_catalog_json(spark, path, **options)
        # the whole row is used, so that every field is parsed
        bad = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in df.columns else F.lit(False)
        out.append(df.where(F.length(F.to_json(F.struct("*"))) > 0).select(bad.alias("bad"))
                   .agg(F.count("bad").alias("rows"), F.count_if("bad").alias("corrupt")).withColumn("mode", F.lit(name)))
    return out[0].unionByName(out[1]).unionByName(out[2])
