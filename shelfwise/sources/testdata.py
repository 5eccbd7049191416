"""Bridge from the TPC-H-like test tables to ``products`` / ``reviews``.

The test tables have no catalogue, so one is derived deterministically:
a review is one line item of an order (customer = order's customer,
product = part), and a product is a part. Every value is an integer-exact
function of the source row, so a SQL engine reproduces it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..operators.normalize import enrich_review_stats

# Fixed values of the bridge (must equal the SQL in plans/oracles.py).
RANK_BASE = 2_000_000
RANK_PER_UNIT = 2_000
DEFAULT_AVERAGE = 4.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    helpful = F.col("l_quantity").cast("bigint") % 11
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .select(
                F.col("l_partkey").alias("product_id"),
                F.col("o_custkey").alias("customer_id"),
                F.least(F.lit(5), F.greatest(F.lit(1), F.col("l_partkey") % 5 + F.col("l_linenumber") % 3))
                 .cast("double").alias("rating"),
                F.col("l_shipdate").cast("date").alias("review_date"),
                helpful.alias("helpful_votes"),
                (helpful + F.col("l_linenumber") % 3).alias("total_votes")))


def products_from_tables(spark: SparkSession, sf_dir: str, reviews: DataFrame | None = None) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    sold = (read_table(spark, sf_dir, "lineitem")
            .groupBy("l_partkey").agg(F.sum("l_quantity").alias("_units")))
    pk = F.col("p_partkey")
    base = (part.join(sold, part.p_partkey == sold.l_partkey, "left")
            .select(
                pk.alias("product_id"),
                F.col("p_name").alias("title"),
                F.col("p_type").alias("category"),
                F.col("p_brand").alias("brand"),
                F.col("p_retailprice").alias("price"),
                F.greatest(F.lit(1).cast("bigint"),
                           F.lit(RANK_BASE) - F.lit(RANK_PER_UNIT) * F.coalesce(F.col("_units").cast("bigint"), F.lit(0)))
                 .alias("sales_rank"),
                F.when(pk % 4 == 0, F.array().cast("array<bigint>"))
                 .otherwise(F.array(pk + 1, pk + 17, pk * 2 + 3)).alias("similar_products"),
                F.lit(1).alias("category_count"),
                F.lit(0).cast("bigint").alias("review_count"),
                F.lit(DEFAULT_AVERAGE).alias("average_rating")))
    if reviews is None:
        reviews = reviews_from_tables(spark, sf_dir)
    return enrich_review_stats(base, reviews)


def catalog_from_tables(spark: SparkSession, sf_dir: str) -> Catalog:
    reviews = reviews_from_tables(spark, sf_dir)
    return Catalog(products_from_tables(spark, sf_dir, reviews), reviews)


# ------------------------------------------------------------------------
# Catalogue text rendered from ``part`` for the ingest plans: one JSON line
# or one block-text record per part, with defects placed by key so that a
# SQL engine can state the expected result directly from ``part``.

def _s(c):
    return c.cast("string")


def json_lines_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-lines catalogue line per part (column ``value``).

    Defects by ``p_partkey`` (checked in this order): %10=5 blank line,
    %10=3 truncated, %37=0 no asin, %10=2 trailing comma, %10=1 single
    quotes, %10=4 bare keys. Field variants: title null (%23=0),
    categories null/[]/[[]] (%11/%13/%17=0), salesRank without the Books
    key (%7=0) or a bare number (%19=0), related list by %4, rating absent
    (%9=0) or 7 (%29=0), %4 embedded reviews with invalid ratings, an
    empty reviewer, string ratings (%6=0) and list-or-int ``helpful``.
    """
    part = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    q = F.lit('"')

    def kv(key, value):
        return F.concat(q, F.lit(key), q, F.lit(": "), value)

    def jstr(c):
        return F.concat(q, c, q)

    title = F.when(pk % 23 == 0, F.lit("null")).otherwise(jstr(F.col("p_name")))
    cats = (F.when(pk % 11 == 0, F.lit("null")).when(pk % 13 == 0, F.lit("[]"))
            .when(pk % 17 == 0, F.lit("[[]]"))
            .otherwise(F.concat(F.lit('[["'), F.col("p_type"), F.lit('", "Sub'), _s(pk % 5), F.lit('"], ["Other"]]'))))
    rank = (F.when(pk % 7 == 0, F.lit('{"Music": 5}')).when(pk % 19 == 0, F.lit("77"))
            .otherwise(F.concat(F.lit('{"Books": '), _s(F.col("p_size") * 1000), F.lit("}"))))
    pid = lambda k: F.concat(F.lit('"P'), _s(pk + k), F.lit('"'))
    related = (F.when(pk % 4 == 0, F.concat(F.lit('{"also_bought": ['), pid(1), F.lit(", "), pid(2),
                                            F.lit('], "also_viewed": ['), pid(3), F.lit("]}")))
               .when(pk % 4 == 1, F.concat(F.lit('{"also_viewed": ['), pid(5), F.lit(', "", '), pid(5), F.lit("]}")))
               .when(pk % 4 == 2, F.concat(F.lit('{"bought_together": ['), pid(7), F.lit("]}"))))
    rating = F.when(pk % 29 == 0, F.lit("7")).otherwise(_s(F.col("p_size") / 10))

    def review(i):
        who = F.when((i == 1) & (pk % 8 == 1), F.lit("")).otherwise(F.concat(F.lit("U"), _s((pk * 7 + i) % 50)))
        v = (pk + i) % 7
        overall = F.when(pk % 6 == 0, F.concat(q, _s(v), F.lit(".0"), q)).otherwise(_s(v))
        helpful = F.when(i % 2 == 0, F.concat(F.lit("["), _s(pk % 5), F.lit(", 9]"))).otherwise(_s(pk % 5))
        return F.concat(F.lit("{"), kv("reviewerID", jstr(who)), F.lit(", "), kv("overall", overall), F.lit(", "),
                        kv("reviewTime", jstr(F.concat(F.lit("2020-01-0"), _s(i + 1)))), F.lit(", "),
                        kv("vote", jstr(_s(i + pk % 3))), F.lit(", "), kv("helpful", helpful), F.lit("}"))

    n_rev = pk % 4
    reviews = F.array_join(F.transform(F.filter(F.array(*[F.lit(i) for i in range(3)]), lambda i: i < n_rev),
                                       review), ", ")
    fields = F.concat_ws(", ",
                         F.when(pk % 37 != 0, kv("asin", F.concat(F.lit('"P'), _s(pk), q))),
                         kv("title", title), kv("price", _s(F.col("p_retailprice"))),
                         kv("brand", jstr(F.col("p_brand"))), kv("categories", cats), kv("salesRank", rank),
                         F.when(related.isNotNull(), kv("related", related)),
                         F.when(pk % 9 != 0, kv("rating", rating)),
                         kv("reviews", F.concat(F.lit("["), reviews, F.lit("]"))))
    line = F.concat(F.lit("{"), fields, F.lit("}"))
    d = pk % 10
    text = (F.when(d == 5, F.lit(""))
            .when(d == 3, F.expr("substring(_line, 1, length(_line) div 2)"))
            .when(pk % 37 == 0, F.col("_line"))
            .when(d == 2, F.concat(F.expr("substring(_line, 1, length(_line) - 1)"), F.lit(",}")))
            .when(d == 1, F.translate(F.col("_line"), '"', "'"))
            .when(d == 4, F.regexp_replace(F.col("_line"), r'"(\w+)":', "$1:"))
            .otherwise(F.col("_line")))
    return part.select(line.alias("_line"), pk).select(text.alias("value"))


def block_records_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block-text record per part (column ``value``), as a text scan
    split at ``\\nId:`` yields them: even keys keep the ``Id:`` prefix, odd
    keys start after it. CRLF line ends for %5=0; %13=0 records hold only
    Id and ASIN; salesrank -1 for %9=0; ``similar`` announces %4 ids but
    lists one more (``similar: 0`` has none); %3 review lines, dated on an
    impossible day for %17=0 and with an overlong vote count for %19=0; %7=0
    adds an orphan line after a blank line."""
    part = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    nl = F.when(pk % 5 == 0, F.lit("\r\n")).otherwise(F.lit("\n"))
    k = pk % 4
    r = pk % 3
    sim_ids = F.array_join(F.transform(F.sequence(F.lit(1), k + 1), lambda i: F.concat(F.lit("S"), _s(pk + i))), "  ")
    similar = F.when(k == 0, F.lit("  similar: 0")).otherwise(F.concat(F.lit("  similar: "), _s(k), F.lit("  "), sim_ids))

    def review(i):
        day = F.when(pk % 17 == 0, F.lit("2-30")).otherwise(F.concat(_s(i + 1), F.lit("-"), _s(pk % 28 + 1)))
        votes = F.when(pk % 19 == 0, F.lit("9" * 25)).otherwise(_s(i + 2))
        return F.concat(F.lit("    2001-"), day, F.lit("  cutomer: C"),
                        _s((pk * 3 + i) % 40), F.lit("  rating: "), _s((pk + i) % 5 + 1),
                        F.lit("  votes:  "), votes, F.lit("  helpful:   "), _s(i))

    reviews = F.filter(F.array(*[F.when(F.lit(i) < r, review(F.lit(i))) for i in range(2)]), lambda x: x.isNotNull())
    body_lines = F.concat(
        F.array(F.concat(F.lit("  title: "), F.col("p_name")),
                F.concat(F.lit("  group: "), F.col("p_type")),
                F.concat(F.lit("  salesrank: "), F.when(pk % 9 == 0, F.lit("-1")).otherwise(_s(F.col("p_size") * 1000))),
                similar,
                F.concat(F.lit("  categories: "), _s(pk % 3)),
                F.concat(F.lit("   |Books[1]|"), F.col("p_type"), F.lit("[2]")),
                F.concat(F.lit("  reviews: total: "), _s(r), F.lit("  downloaded: "), _s(r),
                         F.lit("  avg rating: "), _s(F.col("p_size") / 10))),
        reviews)
    head = F.concat(F.when(pk % 2 == 0, F.lit("Id:   ")).otherwise(F.lit("   ")), _s(pk), nl,
                    F.lit("ASIN: B"), _s(pk))
    body = F.when(pk % 13 == 0, F.lit("")).otherwise(F.concat(nl, F.call_function("array_join", body_lines, nl)))
    lines = F.concat(head, body, nl)
    orphan = F.when(pk % 7 == 0, F.concat(nl, F.lit("  title: Orphan"), nl)).otherwise(F.lit(""))
    return part.select(F.concat(lines, orphan).alias("value"))
