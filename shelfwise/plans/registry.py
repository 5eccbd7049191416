"""Registered plans: one per operator, each with its DuckDB oracle SQL.

Every plan reads the given tables (through the catalogue bridge) and runs
over them whole. Parameters are the reference's defaults where it has
them, otherwise values that make every filter selective on the test data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import order_by
from ..functions.sequence import running_count
from ..operators import collab, evaluate, profile, recommend, search, sketches
from ..operators.normalize import review_stats
from ..operators.stored_catalog import StoredCatalog
from ..session import materialize, scratch_path
from ..sources import sinks
from ..sources.testdata import catalog_from_tables
from .shaping import shape


@dataclass(frozen=True)
class Plan:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(name: str, sql: str | None):
    def wrap(fn):
        PLANS[name] = Plan(lambda spark, sf_dir: shape(fn(spark, sf_dir)), sql)
        return fn
    return wrap


# ---------------------------------------------------------------- oracle
# The catalogue bridge in SQL (same rules as sources/testdata.py).
BRIDGE = """
reviews AS (
  SELECT l_partkey AS product_id, o_custkey AS customer_id,
         CAST(least(5, greatest(1, l_partkey % 5 + l_linenumber % 3)) AS DOUBLE) AS rating,
         CAST(l_shipdate AS DATE) AS review_date,
         CAST(l_quantity AS BIGINT) % 11 AS helpful_votes,
         CAST(l_quantity AS BIGINT) % 11 + l_linenumber % 3 AS total_votes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
products AS (
  SELECT p.p_partkey AS product_id, p.p_name AS title, p.p_type AS category, p.p_brand AS brand,
         p.p_retailprice AS price,
         greatest(1, 2000000 - 2000 * CAST(coalesce(s.units, 0) AS BIGINT)) AS sales_rank,
         CASE WHEN p.p_partkey % 4 = 0 THEN CAST([] AS BIGINT[])
              ELSE [p.p_partkey + 1, p.p_partkey + 17, p.p_partkey * 2 + 3] END AS similar_products,
         coalesce(r.n, 0) AS review_count,
         coalesce(r.a, CAST(4.0 AS DOUBLE)) AS average_rating
  FROM part p
  LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS units FROM lineitem GROUP BY l_partkey) s
         ON p.p_partkey = s.l_partkey
  LEFT JOIN (SELECT product_id, count(rating) AS n, avg(rating) AS a FROM reviews GROUP BY product_id) r
         ON p.p_partkey = r.product_id),
inter AS (
  SELECT DISTINCT customer_id, product_id FROM reviews
  WHERE customer_id IS NOT NULL AND product_id IS NOT NULL)"""


def sql(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {BRIDGE}{extra}\n{body}"


def catalog(spark: SparkSession, sf_dir: str):
    return catalog_from_tables(spark, sf_dir)


P_COLS = "product_id, title, category, sales_rank, round(average_rating, 6) AS average_rating, review_count, price"
P_SPARK = ["product_id", "title", "category", "sales_rank", "average_rating", "review_count", "price"]


def with_global_rank(df: DataFrame, order) -> DataFrame:
    """1-based position over the whole (unlimited) result, built without a
    single-partition window."""
    return running_count(df, [], order, out="rank").withColumn("rank", F.col("rank") + 1)


# ------------------------------------------------------- catalogue queries
@plan("best_sellers", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM products WHERE category = 'PROMO' QUALIFY rank <= 10"""))
def q_best_sellers(spark, d):
    return search.best_sellers(catalog(spark, d).products, "PROMO", 10).select(*P_SPARK, "rank")


@plan("best_sellers_per_category", sql(f"""
SELECT {P_COLS}, row_number() OVER (PARTITION BY category ORDER BY sales_rank, product_id) AS rank
FROM products QUALIFY rank <= 5"""))
def q_best_sellers_per_category(spark, d):
    return search.best_sellers_per_category(catalog(spark, d).products, 5).select(*P_SPARK, "rank")


@plan("review_count_cmp", sql("""
SELECT product_id, review_count FROM products WHERE review_count >= 35"""))
def q_review_count_cmp(spark, d):
    return search.products_by_review_count(catalog(spark, d).products, ">=", 35).select("product_id", "review_count")


@plan("rating_cmp", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY average_rating DESC, sales_rank, product_id) AS rank
FROM products WHERE average_rating > 3.5 QUALIFY rank <= 10"""))
def q_rating_cmp(spark, d):
    return search.products_by_rating(catalog(spark, d).products, ">", 3.5, 10).select(*P_SPARK, "rank")


@plan("multi_filter", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM products WHERE category = 'STANDARD' AND average_rating >= 3.0 AND review_count >= 25
  AND sales_rank <= 1500000 AND price <= 950.0"""))
def q_multi_filter(spark, d):
    out = search.complex_query(catalog(spark, d).products, category="STANDARD", min_rating=3.0,
                               min_reviews=25, max_salesrank=1_500_000, max_price=950.0)
    return with_global_rank(out.select(*P_SPARK), order_by(*search.BY_RANK))


@plan("title_match", sql("""
SELECT product_id, title FROM products WHERE contains(lower(title), lower('WIDGET'))"""))
def q_title_match(spark, d):
    return search.title_search(catalog(spark, d).products, "WIDGET").select("product_id", "title")


@plan("title_search", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM products WHERE contains(lower(title), 'widget') QUALIFY rank <= 10"""))
def q_title_search(spark, d):
    return search.search_by_title(catalog(spark, d).products, "Widget", 10).select(*P_SPARK, "rank")


def stored(spark, d) -> StoredCatalog:
    return StoredCatalog.write(catalog(spark, d).products, scratch_path(spark, f"catalogue-{uuid.uuid4().hex}"))


@plan("title_match_indexed", sql("""
SELECT product_id, title FROM products WHERE contains(lower(title), 'd widg')"""))
def q_title_match_indexed(spark, d):
    return stored(spark, d).title_search("D Widg").select("product_id", "title")


@plan("title_search_indexed", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM products WHERE contains(lower(title), 'ue') QUALIFY rank <= 10"""))
def q_title_search_indexed(spark, d):
    return stored(spark, d).search_by_title("UE", 10).select(*P_SPARK, "rank")


@plan("multi_filter_stored", sql(f"""
SELECT {P_COLS} FROM products WHERE category = 'STANDARD' AND average_rating >= 3.0 AND review_count >= 25
  AND sales_rank <= 1500000 AND price <= 950.0"""))
def q_multi_filter_stored(spark, d):
    return stored(spark, d).complex_query(category="STANDARD", min_rating=3.0, min_reviews=25, max_salesrank=1_500_000,
                                          max_price=950.0).select(*P_SPARK)


@plan("price_range_stored", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM products WHERE price >= 920.5 AND price <= 925.0 QUALIFY rank <= 10"""))
def q_price_range_stored(spark, d):
    return stored(spark, d).products_by_price_range(920.5, 925.0, 10).select(*P_SPARK, "rank")


@plan("price_match", sql("""
SELECT product_id, price FROM products WHERE price >= 920.5 AND price <= 925.0"""))
def q_price_match(spark, d):
    return search.price_range_search(catalog(spark, d).products, 920.5, 925.0).select("product_id", "price")


@plan("price_range", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, product_id) AS rank
FROM products WHERE price >= 920.5 AND price <= 925.0 QUALIFY rank <= 10"""))
def q_price_range(spark, d):
    return search.products_by_price_range(catalog(spark, d).products, 920.5, 925.0, 10).select(*P_SPARK, "rank")


@plan("top_products", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY average_rating DESC, sales_rank, product_id) AS rank
FROM products WHERE average_rating >= 4.0 AND review_count > 0 QUALIFY rank <= 10"""))
def q_top_products(spark, d):
    return search.top_products(catalog(spark, d).products, None, 10).select(*P_SPARK, "rank")


@plan("top_products_per_category", sql(f"""
SELECT {P_COLS}, row_number() OVER (PARTITION BY category ORDER BY average_rating DESC, sales_rank, product_id) AS rank
FROM products WHERE average_rating >= 4.0 AND review_count > 0 QUALIFY rank <= 5"""))
def q_top_products_per_category(spark, d):
    return search.top_products_per_category(catalog(spark, d).products, 5).select(*P_SPARK, "rank")


@plan("popular_by_rank", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY sales_rank, average_rating DESC, product_id) AS rank
FROM products WHERE sales_rank < 1000000 QUALIFY rank <= 10"""))
def q_popular_by_rank(spark, d):
    return search.popular_products(catalog(spark, d).products, 10).select(*P_SPARK, "rank")


@plan("high_engagement", sql(f"""
SELECT {P_COLS}, row_number() OVER (ORDER BY review_count DESC, average_rating DESC, product_id) AS rank
FROM products WHERE review_count >= 10 QUALIFY rank <= 10"""))
def q_high_engagement(spark, d):
    return search.high_engagement(catalog(spark, d).products, 10, 10).select(*P_SPARK, "rank")


@plan("product_info", sql("""
SELECT p.product_id, p.title, p.category, p.sales_rank, p.price, coalesce(c.n, 0) AS review_count
FROM products p LEFT JOIN (SELECT product_id, count(*) AS n FROM reviews GROUP BY product_id) c
  ON p.product_id = c.product_id"""))
def q_product_info(spark, d):
    c = catalog(spark, d)
    return search.product_info(c.products, c.reviews).select(
        "product_id", "title", "category", "sales_rank", "price", "review_count")


@plan("user_history", sql("""
SELECT r.customer_id, r.product_id, p.title, p.category, r.rating, CAST(r.review_date AS VARCHAR) AS review_date,
       r.helpful_votes, r.total_votes,
       row_number() OVER (PARTITION BY r.customer_id ORDER BY r.review_date DESC, r.product_id, r.rating DESC,
                          r.helpful_votes DESC, r.total_votes DESC) AS rank
FROM reviews r JOIN products p ON r.product_id = p.product_id"""))
def q_user_history(spark, d):
    c = catalog(spark, d)
    return search.user_review_history(c.products, c.reviews)


@plan("category_stats", sql("""
SELECT category, count(product_id) AS product_count, round(avg(average_rating), 6) AS avg_category_rating,
       round(avg(review_count), 6) AS avg_reviews_per_product, min(sales_rank) AS best_salesrank,
       round(avg(price), 6) AS avg_price, round(max(average_rating), 6) AS max_rating,
       round(min(average_rating), 6) AS min_rating
FROM products GROUP BY category"""))
def q_category_stats(spark, d):
    return search.category_stats(catalog(spark, d).products)


@plan("similar_band", sql("""
SELECT t.product_id AS target_id, c.product_id, c.category, round(c.average_rating, 6) AS average_rating,
       c.sales_rank,
       row_number() OVER (PARTITION BY t.product_id
                          ORDER BY c.average_rating DESC, c.sales_rank, c.product_id) AS rank
FROM products t JOIN products c
  ON t.category = c.category AND c.product_id <> t.product_id
 AND c.average_rating >= t.average_rating - 0.5 AND c.average_rating <= t.average_rating + 0.5
QUALIFY rank <= 10"""))
def q_similar_band(spark, d):
    return search.similar_in_band(catalog(spark, d).products, 10)


@plan("copurchasers", sql("""
SELECT b.customer_id, b.product_id, CAST(pp.n - 1 AS BIGINT) AS copurchasers
FROM (SELECT DISTINCT customer_id, product_id FROM reviews WHERE customer_id IS NOT NULL) b
JOIN (SELECT product_id, count(DISTINCT customer_id) AS n FROM reviews GROUP BY product_id) pp
  ON b.product_id = pp.product_id"""))
def q_copurchasers(spark, d):
    return search.copurchasers(catalog(spark, d).reviews)


@plan("dataset_info", sql("""
SELECT (SELECT count(*) FROM products) AS total_products,
       (SELECT CAST(count(DISTINCT category) + max(CAST(category IS NULL AS INTEGER)) AS BIGINT) FROM products) AS categories,
       (SELECT count(*) FROM reviews) AS total_reviews,
       (SELECT CAST(count(DISTINCT customer_id) + max(CAST(customer_id IS NULL AS INTEGER)) AS BIGINT) FROM reviews) AS unique_users"""))
def q_dataset_info(spark, d):
    c = catalog(spark, d)
    return search.dataset_info(c.products, c.reviews)


@plan("product_review_stats", sql("""
SELECT product_id, count(rating) AS review_count, round(avg(rating), 6) AS average_rating
FROM reviews GROUP BY product_id"""))
def q_product_review_stats(spark, d):
    return review_stats(catalog(spark, d).reviews)


# ------------------------------------------------------ heuristic recommenders
R_COLS = "product_id, title, category, round(average_rating, 6) AS average_rating, sales_rank, review_count, price"

CONTENT_CTES = """
prof AS (SELECT DISTINCT r.customer_id, p.category FROM reviews r JOIN products p ON r.product_id = p.product_id),
content AS (
  SELECT pr.customer_id, e.product_id, e.title, e.category, e.average_rating, e.sales_rank, e.review_count, e.price,
         row_number() OVER (PARTITION BY pr.customer_id
                            ORDER BY e.average_rating DESC, e.sales_rank, e.product_id) AS rank
  FROM prof pr JOIN (SELECT * FROM products WHERE average_rating >= 4.0) e ON pr.category = e.category
  QUALIFY rank <= 10)"""


@plan("popularity_recs", sql(f"""
SELECT {R_COLS}, row_number() OVER (ORDER BY sales_rank, average_rating DESC, product_id) AS rank
FROM products WHERE average_rating >= 3.5 OR sales_rank <= 100000 QUALIFY rank <= 10"""))
def q_popularity_recs(spark, d):
    return recommend.popularity(catalog(spark, d).products, None, 10).select(*recommend.REC_COLUMNS, "rank")


@plan("popularity_recs_per_category", sql(f"""
SELECT {R_COLS}, row_number() OVER (PARTITION BY category ORDER BY sales_rank, average_rating DESC, product_id) AS rank
FROM products WHERE average_rating >= 3.5 OR sales_rank <= 100000 QUALIFY rank <= 5"""))
def q_popularity_recs_per_category(spark, d):
    return recommend.popularity_per_category(catalog(spark, d).products, 5).select(*recommend.REC_COLUMNS, "rank")


@plan("user_category_profile", sql("""
SELECT r.customer_id, p.category, count(r.rating) AS review_count, round(avg(r.rating), 6) AS avg_user_rating
FROM reviews r JOIN products p ON r.product_id = p.product_id
GROUP BY r.customer_id, p.category HAVING count(r.rating) >= 1"""))
def q_user_category_profile(spark, d):
    c = catalog(spark, d)
    return recommend.user_category_profile(c.products, c.reviews)


@plan("content_recs_all_users", sql(f"SELECT customer_id, {R_COLS}, rank FROM content", CONTENT_CTES))
def q_content_recs_all_users(spark, d):
    c = catalog(spark, d)
    return recommend.content_based(c.products, c.reviews, 10)


@plan("content_recs_unseen", sql(f"""
SELECT customer_id, {R_COLS}, rank FROM (
  SELECT pr.customer_id, e.*, row_number() OVER (PARTITION BY pr.customer_id
                            ORDER BY e.average_rating DESC, e.sales_rank, e.product_id) AS rank
  FROM prof pr JOIN (SELECT * FROM products WHERE average_rating >= 4.0) e ON pr.category = e.category
  WHERE NOT EXISTS (SELECT 1 FROM inter i WHERE i.customer_id = pr.customer_id AND i.product_id = e.product_id)
  QUALIFY rank <= 10)""", CONTENT_CTES))
def q_content_recs_unseen(spark, d):
    c = catalog(spark, d)
    return recommend.content_based(c.products, c.reviews, 10, exclude_seen=True)


@plan("hybrid_recs", sql(f"""
SELECT customer_id, {R_COLS}, row_number() OVER (PARTITION BY customer_id ORDER BY src, p) AS rank
FROM (
  SELECT customer_id, product_id, title, category, average_rating, sales_rank, review_count, price, 0 AS src, rank AS p
  FROM content
  UNION ALL
  SELECT u.customer_id, pop.product_id, pop.title, pop.category, pop.average_rating, pop.sales_rank,
         pop.review_count, pop.price, 1 AS src, pop.p
  FROM (SELECT DISTINCT customer_id FROM reviews WHERE customer_id IS NOT NULL) u CROSS JOIN pop
  WHERE NOT EXISTS (SELECT 1 FROM content c WHERE c.customer_id = u.customer_id AND c.product_id = pop.product_id))
QUALIFY rank <= 10""", CONTENT_CTES + """,
pop AS (SELECT *, row_number() OVER (ORDER BY sales_rank, average_rating DESC, product_id) AS p
        FROM products WHERE average_rating >= 3.5 OR sales_rank <= 100000 QUALIFY p <= 20)"""))
def q_hybrid_recs(spark, d):
    c = catalog(spark, d)
    return recommend.hybrid(c.products, c.reviews, None, 10)


@plan("similar_products_tiered", sql(f"""
SELECT target_id, {R_COLS}, tier, rank FROM (
  SELECT target_id, product_id, title, category, average_rating, sales_rank, review_count, price, 1 AS tier,
         row_number() OVER (PARTITION BY target_id ORDER BY pos) AS rank
  FROM t1 QUALIFY rank <= 10
  UNION ALL
  SELECT t.product_id AS target_id, c.product_id, c.title, c.category, c.average_rating, c.sales_rank,
         c.review_count, c.price, 2 AS tier,
         row_number() OVER (PARTITION BY t.product_id ORDER BY c.average_rating DESC, c.sales_rank, c.product_id) AS rank
  FROM products t JOIN products c ON t.category = c.category AND c.product_id <> t.product_id
   AND c.average_rating >= 3.5
  WHERE t.product_id NOT IN (SELECT target_id FROM t1)
  QUALIFY rank <= 10)""", """
lst AS (SELECT product_id AS target_id, unnest(similar_products) AS sid,
               unnest(range(len(similar_products))) AS pos FROM products),
t1 AS (SELECT l.target_id, min(l.pos) AS pos, c.product_id, c.title, c.category, c.average_rating,
              c.sales_rank, c.review_count, c.price
       FROM lst l JOIN products c ON l.sid = c.product_id
       GROUP BY l.target_id, c.product_id, c.title, c.category, c.average_rating, c.sales_rank,
                c.review_count, c.price)"""))
def q_similar_products_tiered(spark, d):
    return recommend.similar_products(catalog(spark, d).products, 10)


# -------------------------------------------------- collaborative filtering
@plan("interactions", sql("SELECT customer_id, product_id, 1 AS interaction FROM inter"))
def q_interactions(spark, d):
    return collab.interactions(catalog(spark, d).reviews)


@plan("item_freq", sql("SELECT product_id, count(*) AS product_frequency FROM inter GROUP BY product_id"))
def q_item_freq(spark, d):
    return collab.item_frequency(collab.interactions(catalog(spark, d).reviews))


PAIRS_CTE = """
pairs AS (SELECT a.product_id AS product1, b.product_id AS product2, count(*) AS co
          FROM inter a JOIN inter b ON a.customer_id = b.customer_id AND a.product_id < b.product_id
          GROUP BY a.product_id, b.product_id),
freq AS (SELECT product_id, count(*) AS f FROM inter GROUP BY product_id),
sim AS (SELECT p.product1, p.product2, p.co, p.co / (f1.f + f2.f - p.co) AS s
        FROM pairs p JOIN freq f1 ON p.product1 = f1.product_id JOIN freq f2 ON p.product2 = f2.product_id)"""


@plan("cooccurrence", sql("SELECT product1, product2, co AS co_occurrence_count FROM pairs", PAIRS_CTE))
def q_cooccurrence(spark, d):
    co = collab.item_cooccurrence(collab.interactions(catalog(spark, d).reviews))
    return co.select("product1", "product2", "co_occurrence_count")


@plan("item_jaccard", sql("""
SELECT product1, product2, co AS co_occurrence_count, round(s, 6) AS similarity_score FROM sim""", PAIRS_CTE))
def q_item_jaccard(spark, d):
    return collab.item_jaccard(collab.interactions(catalog(spark, d).reviews))


ALSO_SQL = sql("""
SELECT e.product1, c.product_id, c.title, c.category, round(c.average_rating, 6) AS average_rating,
       c.review_count, c.price, round(e.s, 6) AS similarity_score,
       row_number() OVER (PARTITION BY e.product1 ORDER BY e.s DESC, c.product_id) AS rank
FROM (SELECT product1, product2, s FROM sim UNION ALL SELECT product2, product1, s FROM sim) e
JOIN products c ON e.product2 = c.product_id
QUALIFY rank <= 10""", PAIRS_CTE)


@plan("also_bought_topk", ALSO_SQL)
def q_also_bought_topk(spark, d):
    c = catalog(spark, d)
    # one-shot form; a reusable model (fit_similarity) would also store the scores
    return collab.also_bought_all(collab.interactions(c.reviews), c.products, 10)


@plan("also_bought_bounded", ALSO_SQL)
def q_also_bought_bounded(spark, d):
    """The lists of also_bought_topk without the table of all pairs."""
    c = catalog(spark, d)
    return collab.also_bought_bounded(collab.interactions(c.reviews), c.products, 10)


@plan("also_bought_refit", ALSO_SQL)
def q_also_bought_refit(spark, d):
    """A model fitted on the reviews of early dates, stored, loaded and
    updated with the others, equals a full fit."""
    c = catalog(spark, d)
    late = F.col("review_date") >= F.lit("2001-06-01").cast("date")
    path = scratch_path(spark, f"refit-{uuid.uuid4().hex}")
    collab.fit_similarity(c.reviews.where(~late), store_pairs=False).save(path)
    model = collab.update_similarity(collab.SimilarityModel.load(spark, path), c.reviews.where(late))
    return collab.also_bought(model.edges, c.products, 10, known=model.frequency)


@plan("popular_by_interactions", sql("""
SELECT c.product_id, c.title, c.category, round(c.average_rating, 6) AS average_rating, c.review_count, c.price,
       n.cnt AS interaction_count, row_number() OVER (ORDER BY n.cnt DESC, c.product_id) AS rank
FROM (SELECT product_id, count(*) AS cnt FROM inter GROUP BY product_id) n
JOIN products c ON n.product_id = c.product_id QUALIFY rank <= 10"""))
def q_popular_by_interactions(spark, d):
    c = catalog(spark, d)
    return collab.popular_by_interactions(collab.interactions(c.reviews), c.products, 10)


USER_PAIRS_CTE = """
udeg AS (SELECT customer_id, count(*) AS d FROM inter GROUP BY customer_id),
upairs AS (SELECT a.customer_id AS customer1, b.customer_id AS customer2, count(*) AS common_products
           FROM inter a JOIN inter b ON a.product_id = b.product_id AND a.customer_id < b.customer_id
           GROUP BY a.customer_id, b.customer_id)"""


@plan("user_jaccard", sql("""
SELECT u.customer1, u.customer2, u.common_products,
       round(u.common_products / (d1.d + d2.d - u.common_products), 6) AS similarity
FROM upairs u JOIN udeg d1 ON u.customer1 = d1.customer_id JOIN udeg d2 ON u.customer2 = d2.customer_id""",
                          USER_PAIRS_CTE))
def q_user_jaccard(spark, d):
    return collab.user_jaccard(collab.interactions(catalog(spark, d).reviews))


def user_cf_ctes(train: str) -> str:
    """User-based CF in SQL over the interaction relation ``train``."""
    return f"""
ov AS (SELECT a.customer_id AS c1, b.customer_id AS c2, count(*) AS common
       FROM {train} a JOIN {train} b ON a.product_id = b.product_id AND a.customer_id <> b.customer_id
       GROUP BY a.customer_id, b.customer_id),
nb AS (SELECT * FROM ov QUALIFY row_number() OVER (PARTITION BY c1 ORDER BY common DESC, c2) <= 100),
cand AS (SELECT nb.c1 AS customer_id, i.product_id, count(*) AS score, avg(nb.common) AS sim
         FROM nb JOIN {train} i ON i.customer_id = nb.c2 GROUP BY nb.c1, i.product_id),
cf AS (SELECT c.customer_id, p.product_id, p.title, p.category, p.average_rating, p.review_count, p.price,
              c.score AS recommendation_score, c.sim AS user_similarity,
              row_number() OVER (PARTITION BY c.customer_id ORDER BY c.score DESC, p.product_id) AS rank
       FROM cand c JOIN products p ON c.product_id = p.product_id
       WHERE NOT EXISTS (SELECT 1 FROM {train} o WHERE o.customer_id = c.customer_id AND o.product_id = c.product_id)
       QUALIFY rank <= 10)"""


@plan("user_neighbours", sql("SELECT c1 AS customer_id, c2 AS neighbour_id, common AS common_products FROM nb",
                             user_cf_ctes("inter")))
def q_user_neighbours(spark, d):
    return collab.neighbours_bounded(collab.interactions(catalog(spark, d).reviews))


@plan("user_cf_batch", sql("""
SELECT customer_id, product_id, title, category, round(average_rating, 6) AS average_rating, review_count, price,
       recommendation_score, round(user_similarity, 6) AS user_similarity, rank FROM cf""", user_cf_ctes("inter")))
def q_user_cf_batch(spark, d):
    c = catalog(spark, d)
    return collab.user_cf(collab.interactions(c.reviews), c.products, 10)


# ------------------------------------------------------------- evaluation
SPLIT = "((((42 + customer_id * 7919 + product_id * 104729) % 1000003) + 1000003) % 1000003) / CAST(1000003 AS DOUBLE)"


@plan("split_counts", sql(f"""
SELECT CASE WHEN {SPLIT} < 0.2 THEN 'test' ELSE 'train' END AS split, count(*) AS rows,
       count(DISTINCT customer_id) AS distinct_keys
FROM inter GROUP BY 1"""))
def q_split_counts(spark, d):
    inter = collab.interactions(catalog(spark, d).reviews)
    return evaluate.split_counts(inter, ["customer_id", "product_id"], 0.2, 42, "arith")


SCORED_CTES = f"""
train AS (SELECT * FROM inter WHERE {SPLIT} >= 0.2),
test AS (SELECT * FROM inter WHERE {SPLIT} < 0.2),""" + user_cf_ctes("train") + """,
scored AS (
  SELECT t.customer_id, coalesce(max(h.hits), 0) AS hits, count(*) AS n_actual, coalesce(max(p.n), 0) AS n_predicted
  FROM test t
  LEFT JOIN (SELECT customer_id, count(*) AS n FROM cf GROUP BY customer_id) p ON p.customer_id = t.customer_id
  LEFT JOIN (SELECT a.customer_id, count(*) AS hits FROM test a JOIN cf c
             ON a.customer_id = c.customer_id AND a.product_id = c.product_id GROUP BY a.customer_id) h
    ON h.customer_id = t.customer_id
  GROUP BY t.customer_id)"""


@plan("precision_recall_at_k", sql("""
SELECT round(coalesce(avg(hits / n_predicted) FILTER (n_predicted > 0), 0), 6) AS precision_at_k,
       round(coalesce(avg(hits / n_actual) FILTER (n_predicted > 0), 0), 6) AS recall_at_k,
       count(*) FILTER (n_predicted > 0) AS users_evaluated, count(*) AS test_users_total
FROM scored""", SCORED_CTES))
def q_precision_recall_at_k(spark, d):
    c = catalog(spark, d)
    return evaluate.evaluate_user_cf(c.reviews, c.products, 0.2, 10, 42, "arith")


@plan("precision_recall_per_user", sql("""
SELECT customer_id, hits, n_actual, n_predicted,
       round(CASE WHEN n_predicted > 0 THEN hits / n_predicted ELSE 0 END, 6) AS precision,
       round(hits / n_actual, 6) AS recall
FROM scored""", SCORED_CTES))
def q_precision_recall_per_user(spark, d):
    c = catalog(spark, d)
    return evaluate.user_cf_precision_recall(c.reviews, c.products, 0.2, 10, 42, "arith")


@plan("rec_diversity", sql("""
SELECT customer_id, round(coalesce((count(DISTINCT category) + max(CAST(category IS NULL AS INTEGER)))
                                   / count(*), 0), 6) AS diversity
FROM content GROUP BY customer_id""", CONTENT_CTES))
def q_rec_diversity(spark, d):
    c = catalog(spark, d)
    return evaluate.diversity(recommend.content_based(c.products, c.reviews, 10))


@plan("rec_avg_rating", sql("""
SELECT customer_id, round(coalesce(avg(average_rating), 0), 6) AS avg_rating FROM content GROUP BY customer_id""",
                            CONTENT_CTES))
def q_rec_avg_rating(spark, d):
    c = catalog(spark, d)
    return evaluate.mean_rating(recommend.content_based(c.products, c.reviews, 10))


@plan("rating_error", sql(f"""
SELECT round(sqrt(avg((t.rating - coalesce(m.m, g.m)) * (t.rating - coalesce(m.m, g.m)))), 6) AS rmse,
       round(avg(abs(t.rating - coalesce(m.m, g.m))), 6) AS mae, count(*) AS n
FROM (SELECT * FROM reviews WHERE {SPLIT} < 0.2) t
LEFT JOIN (SELECT product_id, avg(rating) AS m FROM reviews WHERE {SPLIT} >= 0.2 GROUP BY product_id) m
  ON t.product_id = m.product_id
CROSS JOIN (SELECT avg(rating) AS m FROM reviews WHERE {SPLIT} >= 0.2) g"""))
def q_rating_error(spark, d):
    reviews = catalog(spark, d).reviews
    train, test = evaluate.train_test_split(reviews, ["customer_id", "product_id"], 0.2, 42, "arith")
    return evaluate.rating_error(evaluate.mean_baseline_predictions(train, test))


@plan("category_distribution", sql("""
SELECT category, count(*) AS count FROM products GROUP BY category"""))
def q_category_distribution(spark, d):
    return evaluate.category_distribution(catalog(spark, d).products)


@plan("rating_distribution", sql("SELECT rating, count(*) AS count FROM reviews GROUP BY rating"))
def q_rating_distribution(spark, d):
    return evaluate.rating_distribution(catalog(spark, d).reviews)


# ---------------------------------------------------------------- utilities
@plan("sample", None)
def q_sample(spark, d):
    return profile.sample(catalog(spark, d).reviews, 0.1, 42)


def _profile_row(pos: int, name: str, dtype: str, numeric: bool) -> str:
    stats = (f"avg({name}) AS mean, stddev_samp({name}) AS stddev" if numeric
             else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev")
    return (f"SELECT '{name}' AS column_name, '{dtype}' AS data_type, {pos} AS position, "
            f"count(*) FILTER (WHERE {name} IS NULL) AS null_count, {stats} FROM reviews")


PROFILE_COLUMNS = [("product_id", "bigint", True), ("customer_id", "bigint", True), ("rating", "double", True),
                   ("review_date", "date", False), ("helpful_votes", "bigint", True),
                   ("total_votes", "bigint", True)]


@plan("profile", sql("""
SELECT (SELECT count(*) FROM reviews) AS row_count, CAST(6 AS BIGINT) AS column_count, column_name, data_type,
       CAST(position AS BIGINT) AS position, null_count, round(mean, 6) AS mean, round(stddev, 6) AS stddev
FROM (""" + "\nUNION ALL\n".join(_profile_row(i, *c) for i, c in enumerate(PROFILE_COLUMNS)) + ")"))
def q_profile(spark, d):
    return profile.profile(catalog(spark, d).reviews)


@plan("safe_ratio", sql("""
SELECT product_id, customer_id, helpful_votes, total_votes,
       round(CASE WHEN total_votes = 0 THEN 0.0 ELSE helpful_votes / total_votes END, 6) AS helpful_ratio
FROM reviews"""))
def q_safe_ratio(spark, d):
    r = catalog(spark, d).reviews
    return r.select("product_id", "customer_id", "helpful_votes", "total_votes",
                    profile.safe_ratio("helpful_votes", "total_votes").alias("helpful_ratio"))


@plan("display_join", sql("""
SELECT n.product_id, n.cnt AS interaction_count, p.title, p.category, round(p.average_rating, 6) AS average_rating,
       p.review_count, p.sales_rank
FROM (SELECT product_id, count(*) AS cnt FROM inter GROUP BY product_id) n
JOIN products p ON n.product_id = p.product_id"""))
def q_display_join(spark, d):
    c = catalog(spark, d)
    inter = collab.interactions(c.reviews)
    recs = inter.groupBy("product_id").agg(F.count(F.lit(1)).alias("interaction_count"))
    return profile.display_join(recs, c.products, ["interaction_count"])


@plan("sample_facts", sql("""
SELECT true AS within_bounds, CAST(0 AS BIGINT) AS not_in_table"""))
def q_sample_facts(spark, d):
    """The sample's size is within five standard deviations and all its rows
    are the table's."""
    r = catalog(spark, d).reviews
    s = profile.sample(r, 0.1, 42)
    n, total = (x.select(F.count(F.lit(1))).scalar() for x in (s, r))
    strange = s.exceptAll(r).select(F.count(F.lit(1))).scalar()
    return spark.range(1).select((F.abs(n - 0.1 * total) <= 5 * F.sqrt(0.09 * total)).alias("within_bounds"),
                                 strange.alias("not_in_table"))


# ------------------------------------------------------ requested keys only
REQUESTED = "(SELECT c_custkey AS customer_id FROM customer WHERE c_custkey IS NOT NULL UNION ALL SELECT -1 UNION ALL SELECT -2)"


def requested_customers(spark, d):
    """Every customer, most with history, and two unknown ids."""
    known = spark.read.parquet(f"{d}/customer.parquet").where("c_custkey IS NOT NULL").select(F.col("c_custkey").alias("customer_id"))
    return known.unionByName(spark.createDataFrame([(-1,), (-2,)], "customer_id bigint"))


@plan("user_cf_requested", sql(f"""
SELECT u.customer_id, cf.product_id, cf.title, cf.category, round(cf.average_rating, 6) AS average_rating, cf.review_count,
       cf.price, cf.recommendation_score, round(cf.user_similarity, 6) AS user_similarity, cf.rank
FROM {REQUESTED} u JOIN cf ON u.customer_id = cf.customer_id
UNION ALL
SELECT u.customer_id, p.product_id, p.title, p.category, round(p.average_rating, 6), p.review_count, p.price, p.cnt, NULL, p.rank
FROM {REQUESTED} u CROSS JOIN (
  SELECT c.*, n.cnt, row_number() OVER (ORDER BY n.cnt DESC, c.product_id) AS rank
  FROM (SELECT product_id, count(*) AS cnt FROM inter GROUP BY product_id) n JOIN products c ON n.product_id = c.product_id
  QUALIFY rank <= 10) p
WHERE u.customer_id NOT IN (SELECT customer_id FROM inter)""", user_cf_ctes("inter")))
def q_user_cf_requested(spark, d):
    c = catalog(spark, d)
    return collab.recommend_for_users(collab.interactions(c.reviews), c.products, requested_customers(spark, d), 10)


@plan("hybrid_recs_requested", sql(f"""
SELECT customer_id, {R_COLS}, row_number() OVER (PARTITION BY customer_id ORDER BY src, p) AS rank
FROM (
  SELECT c.customer_id, c.product_id, c.title, c.category, c.average_rating, c.sales_rank, c.review_count, c.price, 0 AS src,
         c.rank AS p
  FROM content c JOIN {REQUESTED} u ON c.customer_id = u.customer_id
  UNION ALL
  SELECT u.customer_id, pop.product_id, pop.title, pop.category, pop.average_rating, pop.sales_rank,
         pop.review_count, pop.price, 1 AS src, pop.p
  FROM {REQUESTED} u CROSS JOIN pop
  WHERE NOT EXISTS (SELECT 1 FROM content c WHERE c.customer_id = u.customer_id AND c.product_id = pop.product_id))
QUALIFY rank <= 10""", CONTENT_CTES + """,
pop AS (SELECT *, row_number() OVER (ORDER BY sales_rank, average_rating DESC, product_id) AS p
        FROM products WHERE average_rating >= 3.5 OR sales_rank <= 100000 QUALIFY p <= 20)"""))
def q_hybrid_recs_requested(spark, d):
    c = catalog(spark, d)
    return recommend.hybrid(c.products, c.reviews, requested_customers(spark, d), 10)


@plan("similar_products_requested", PLANS["similar_products_tiered"].sql.replace(
    "SELECT target_id, product_id, title, category, round(average_rating, 6) AS average_rating, sales_rank, review_count, "
    "price, tier, rank FROM (", f"""
SELECT -5 AS target_id, {R_COLS}, 0 AS tier, row_number() OVER (ORDER BY sales_rank, average_rating DESC, product_id) AS rank
FROM products WHERE average_rating >= 3.5 OR sales_rank <= 100000 QUALIFY rank <= 10
UNION ALL
SELECT target_id, {R_COLS}, tier, rank FROM (""") + " WHERE target_id IS NOT NULL")
def q_similar_products_requested(spark, d):
    products = catalog(spark, d).products
    targets = products.where("product_id IS NOT NULL").select("product_id").unionByName(
        spark.createDataFrame([(-5,)], "product_id bigint"))
    return recommend.similar_products(products, 10, targets)


@plan("user_jaccard_pairs", sql("""
SELECT q.customer1, q.customer2,
       round(CASE WHEN coalesce(d1.d, 0) + coalesce(d2.d, 0) > 0
                  THEN coalesce(c.n, 0) / (coalesce(d1.d, 0) + coalesce(d2.d, 0) - coalesce(c.n, 0)) ELSE 0 END, 6) AS similarity
FROM req q LEFT JOIN udeg d1 ON q.customer1 = d1.customer_id LEFT JOIN udeg d2 ON q.customer2 = d2.customer_id
LEFT JOIN (SELECT q.customer1, q.customer2, count(*) AS n FROM req q JOIN inter a ON a.customer_id = q.customer1
           JOIN inter b ON b.customer_id = q.customer2 AND a.product_id = b.product_id GROUP BY q.customer1, q.customer2) c
  ON c.customer1 = q.customer1 AND c.customer2 = q.customer2""", """
udeg AS (SELECT customer_id, count(*) AS d FROM inter GROUP BY customer_id),
req AS (SELECT c_custkey AS customer1, c_custkey + 1 AS customer2 FROM customer UNION ALL SELECT -1, -2)"""))
def q_user_jaccard_pairs(spark, d):
    pairs = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("customer1"),
                                                               (F.col("c_custkey") + 1).alias("customer2"))
    pairs = pairs.unionByName(spark.createDataFrame([(-1, -2)], "customer1 bigint, customer2 bigint"))
    return collab.user_jaccard_pairs(collab.interactions(catalog(spark, d).reviews), pairs)


@plan("model_roundtrip", ALSO_SQL)
def q_model_roundtrip(spark, d):
    """Fit, save, load, query."""
    c = catalog(spark, d)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    collab.fit_similarity(c.reviews, store_pairs=False).save(path)
    model = collab.SimilarityModel.load(spark, path)
    return collab.also_bought(model.edges, c.products, 10, known=model.frequency)


@plan("csv_roundtrip", sql(f"""
SELECT {P_COLS}, CASE WHEN len(similar_products) = 0 THEN '[]' ELSE '[' || array_to_string(similar_products, ',') || ']' END
       AS similar_products FROM products"""))
def q_csv_roundtrip(spark, d):
    """Write as CSV, read the files back."""
    p = catalog(spark, d).products.select(*P_SPARK, "similar_products")
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    sinks.write_csv(p, path, single_file=False)
    kinds = {f.name: f.dataType.simpleString() for f in p.schema.fields} | {"similar_products": "string"}
    return spark.read.option("header", True).option("escape", '"').schema(
        ", ".join(f"{n} {kinds[n]}" for n in p.columns)).csv(path)


# --------------------------------------------------- matrix factorisation
@plan("als_recs", None)
def q_als_recs(spark, d):
    from ..operators.als import als_recommendations
    return als_recommendations(collab.interactions(catalog(spark, d).reviews), k=10)


@plan("als_rating_error", None)
def q_als_rating_error(spark, d):
    from ..operators.als import als_rating_error
    # written once: ids, fit and score read both sides four times
    reviews = materialize(catalog(spark, d).reviews.select("customer_id", "product_id", "rating"), "reviews")
    train, test = evaluate.train_test_split(reviews, ["customer_id", "product_id"], 0.2, 42, "arith")
    return als_rating_error(train, test)


@plan("als_recs_facts", sql("""
SELECT customer_id, CAST(10 AS BIGINT) AS recs, 1 AS first_rank, 10 AS last_rank, CAST(10 AS BIGINT) AS products,
       true AS falling, CAST(0 AS BIGINT) AS unknown_products
FROM inter GROUP BY customer_id"""))
def q_als_recs_facts(spark, d):
    """Every customer with history gets ten different products that were
    bought, ranked 1 to 10 by falling score."""
    from ..operators.als import als_recommendations
    inter = collab.interactions(catalog(spark, d).reviews)
    recs = materialize(als_recommendations(inter, k=10), "recs")
    known = inter.select("product_id").distinct().withColumn("known", F.lit(True))
    by_rank = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: -x["score"])
    return recs.join(known, "product_id", "left").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("recs"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.count_distinct("product_id").alias("products"), (F.array_sort(by_rank) == by_rank).alias("falling"),
        F.count_if(F.col("known").isNull()).alias("unknown_products"))


@plan("als_rating_error_facts", sql(f"""
SELECT count(*) AS n, true AS mae_below_rmse, true AS rmse_in_range
FROM reviews t WHERE {SPLIT} < 0.2
 AND customer_id IN (SELECT customer_id FROM reviews WHERE {SPLIT} >= 0.2)
 AND product_id IN (SELECT product_id FROM reviews WHERE {SPLIT} >= 0.2)"""))
def q_als_rating_error_facts(spark, d):
    """Scored are the test rows whose customer and product the model knows."""
    e = q_als_rating_error(spark, d)
    return e.select("n", (F.col("mae") <= F.col("rmse")).alias("mae_below_rmse"),
                    F.col("rmse").between(0.0, 4.0).alias("rmse_in_range"))


@plan("distinct_sketch_facts", sql("""
SELECT column_name, exact, TRUE AS merged_is_one_pass, TRUE AS within_bound FROM (
  SELECT 'customer_id' AS column_name, count(DISTINCT customer_id) AS exact FROM reviews
  UNION ALL SELECT 'product_id', count(DISTINCT product_id) FROM reviews)"""))
def q_distinct_sketch_facts(spark, d):
    """Stored sketches of each month, merged, against a sketch of all
    reviews and the exact counts."""
    reviews, cols = catalog(spark, d).reviews, ["customer_id", "product_id"]
    path = scratch_path(spark, f"sketches-{uuid.uuid4().hex}")
    sketches.distinct_sketches(reviews, cols, F.date_trunc("month", "review_date")).write.parquet(path)
    merged = sketches.merge_sketches(spark.read.parquet(path), cols)
    once = sketches.merge_sketches(sketches.distinct_sketches(reviews, cols), cols)
    exact = reviews.agg(*[F.count_distinct(c).alias(c) for c in cols])
    long = lambda df, out: df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(out)) for c in cols])))
    out = long(merged, "m").join(long(once, "o"), "column_name").join(long(exact, "exact"), "column_name")
    return out.select("column_name", "exact", (F.col("m") == F.col("o")).alias("merged_is_one_pass"),
                      (F.abs(F.col("m") - F.col("exact")) <= sketches.error_bound() * F.col("exact")).alias("within_bound"))
