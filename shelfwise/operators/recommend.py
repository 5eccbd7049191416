"""Heuristic recommenders (R1-R5) in per-key and all-users batch forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import order_by, top_n, top_n_per_group
from ..functions.sequence import running_count
from ..session import materialize
from .search import validate_search_parameters

# Fixed thresholds of the reference recommenders.
POPULAR_MIN_RATING = 3.5
POPULAR_MAX_RANK = 100_000
CONTENT_MIN_RATING = 4.0
SIMILAR_MIN_RATING = 3.5
DEFAULT_N = 10
ROWS_PER_TASK = 500_000     # candidates ranked in one task

BY_RANK_THEN_RATING = (("sales_rank", "asc"), ("average_rating", "desc"), ("product_id", "asc"))
BY_RATING_THEN_RANK = (("average_rating", "desc"), ("sales_rank", "asc"), ("product_id", "asc"))
REC_COLUMNS = ["product_id", "title", "category", "average_rating", "sales_rank", "review_count", "price"]


def _popular_filter(products: DataFrame) -> DataFrame:
    return products.where((F.col("average_rating") >= POPULAR_MIN_RATING)
                          | (F.col("sales_rank") <= POPULAR_MAX_RANK))


def popularity(products: DataFrame, category: str | None = None, n: int = DEFAULT_N) -> DataFrame:
    """Rated >= 3.5 or ranked <= 100,000; by rank asc, rating desc."""
    validate_search_parameters(category=category, n=n)
    base = products.where(F.col("category") == category) if category is not None else products
    return top_n(_popular_filter(base), n, order_by(*BY_RANK_THEN_RATING), "rank")


def popularity_per_category(products: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """R1 batch: top ``n`` popular products of every category."""
    validate_search_parameters(n=n)
    return top_n_per_group(_popular_filter(products), ["category"], n, order_by(*BY_RANK_THEN_RATING))


def _list_scalar(df: DataFrame, cols: list[str]) -> Column:
    """A bounded result (a top-n) as one array value, evaluated once as a
    scalar subquery -- the way to hand every user the same short list
    without a cross join."""
    return df.select(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("_rank"), *[F.col(c) for c in cols])))
                     .alias("_l")).scalar()


def user_category_profile(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per user and category, number of ratings and mean rating."""
    return (reviews.join(products.select("product_id", "category"), "product_id")
            .groupBy("customer_id", "category")
            .agg(F.count("rating").alias("review_count"), F.avg("rating").alias("avg_user_rating"))
            .where(F.col("review_count") >= 1))


def _ranked_in_category(products: DataFrame, min_rating: float) -> DataFrame:
    """Products rated >= ``min_rating`` numbered 0.. inside their category
    by rating desc, rank asc, id (scalable numbering, no per-category task)."""
    eligible = products.where(F.col("average_rating") >= min_rating).select(*REC_COLUMNS)
    return running_count(eligible, ["category"], order_by(*BY_RATING_THEN_RANK), out="_pos")


def content_based(products: DataFrame, reviews: DataFrame, n: int = DEFAULT_N,
                  exclude_seen: bool = False, one_user: bool = False) -> DataFrame:
    """R2 for every user with reviews: products rated >= 4.0 in the
    categories the user reviewed, by rating desc, rank asc; top ``n``.

    A user meets the best n products of a category only. With
    ``exclude_seen`` each (user, category) probes as many more positions of
    its category's ranked list as the user has items there, an equi-join on
    (category, position) that never pairs a user with a whole category.
    The reviews of ``one_user`` make few candidates: nothing is counted or
    written for them.
    """
    validate_search_parameters(n=n)
    prof = user_category_profile(products, reviews).select("customer_id", "category")
    if not exclude_seen:
        # n products of each category are enough
        eligible = products.where(F.col("average_rating") >= CONTENT_MIN_RATING).select(*REC_COLUMNS)
        best = top_n_per_group(eligible, ["category"], n, order_by(*BY_RATING_THEN_RANK), rank_col="_pos")
        dealt = prof
        if not one_user:
            best = materialize(best, "best")
            dealt = prof.repartition(_parts(prof, prof.count() * n), "customer_id")
        out = top_n_per_group(dealt.join(best, "category"), ["customer_id"], n, order_by(*BY_RATING_THEN_RANK))
        return out.select("customer_id", *REC_COLUMNS, "rank")
    ranked = _ranked_in_category(products, CONTENT_MIN_RATING)
    own = materialize(reviews.select("customer_id", "product_id").distinct(), "seen")
    seen = (own.join(ranked.select("product_id", "category"), "product_id")
            .groupBy("customer_id", "category").agg(F.count(F.lit(1)).alias("_seen")))
    prof = materialize(prof.join(seen, ["customer_id", "category"], "left")
                       .select("customer_id", "category", (F.lit(n - 1) + F.coalesce("_seen", F.lit(0))).alias("_last")), "profiles")
    rows, deepest = prof.agg(F.sum(F.col("_last") + 1), F.max("_last")).first()
    parts = _parts(prof, rows or 0)
    # no one probes beyond the deepest position: a short table, which is written so that its size is known
    ranked = materialize(ranked.where(F.col("_pos") <= F.lit(deepest)), "ranked")
    probes = prof.repartition(parts, "customer_id").select(
        "customer_id", "category", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_pos"))
    keys = ["customer_id", "product_id"]
    cand = probes.join(ranked, ["category", "_pos"]).repartition(parts, *keys).join(own.repartition(parts, *keys), keys, "left_anti")
    out = top_n_per_group(cand.repartition(parts, "customer_id"), ["customer_id"], n, order_by(*BY_RATING_THEN_RANK))
    return out.select("customer_id", *REC_COLUMNS, "rank")


def _parts(df: DataFrame, rows: int) -> int:
    """Partitions for ``rows`` candidates. They repeat few products, so they
    shrink to almost nothing when shuffled; adaptive execution, which sizes
    partitions by these bytes, would sort very many in one task."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(rows / ROWS_PER_TASK) + 1)


def content_based_for(products: DataFrame, reviews: DataFrame, user_id, n: int = DEFAULT_N) -> DataFrame:
    """R2 for one user; a user without reviews gets R1."""
    validate_search_parameters(n=n)
    mine = reviews.where(F.col("customer_id") == F.lit(user_id))
    recs = content_based(products, mine, n, one_user=True).drop("customer_id")
    pop = popularity(products, None, n).select(*REC_COLUMNS, "rank")
    has_reviews = mine.select(F.count(F.lit(1)) > 0).scalar()
    return recs.where(has_reviews).unionByName(pop.where(~has_reviews))


def hybrid(products: DataFrame, reviews: DataFrame, users: DataFrame | None = None,
           n: int = DEFAULT_N, dedupe: bool = True, one_user: bool = False) -> DataFrame:
    """R3 for every user (or the ``users`` ids): content recommendations,
    filled up to ``n`` from the popularity list. ``dedupe`` skips popular
    items already recommended (``False`` keeps the reference's repeats).
    Users without reviews get the popularity list.
    """
    validate_search_parameters(n=n)
    if users is None:
        users = reviews.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    else:
        users = users.select("customer_id").distinct()
        reviews = reviews.join(users, "customer_id", "left_semi")
    content = content_based(products, reviews, n, one_user=one_user).select("customer_id", "product_id", F.lit(0).alias("_src"),
                                                         F.col("rank").alias("_p"))
    # only users short of n need popular products, and of these only the ids
    counts = content.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_have"))
    short = (users.join(counts, "customer_id", "left")
             .select("customer_id", F.coalesce(F.col("_have"), F.lit(0)).alias("_have")).where(F.col("_have") < n))
    pop_list = _list_scalar(popularity(products, None, 2 * n), ["product_id"])
    pop = (short.select("customer_id", "_have", F.explode(pop_list).alias("_e"))
           .select("customer_id", "_have", F.col("_e").getField("product_id").alias("product_id"), F.lit(1).alias("_src"),
                   F.col("_e").getField("_rank").alias("_p")))
    if dedupe:
        pop = pop.join(content.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_anti")
    else:
        # reference: the top (n - have) popular items, repeats allowed
        pop = pop.where(F.col("_p") <= F.lit(n) - F.col("_have"))
    both = content.unionByName(pop.drop("_have"))
    out = top_n_per_group(both, ["customer_id"], n, [F.col("_src").asc(), F.col("_p").asc()])
    return out.join(products.select(*REC_COLUMNS), "product_id").select("customer_id", *REC_COLUMNS, "rank")


def similar_products(products: DataFrame, n: int = DEFAULT_N, targets: DataFrame | None = None) -> DataFrame:
    """R4 for every product (or the ``targets`` ids).

    Tier 1: the product's curated ``similar_products`` that exist in the
    catalogue, in list order, top ``n``. Tier 2 (no tier-1 item): same
    category, other id, rated >= 3.5, by rating desc, rank asc. Requested
    ids missing from the catalogue get R1.
    """
    validate_search_parameters(n=n)
    cat = products.select(*REC_COLUMNS)
    tgt = products if targets is None else products.join(targets.select("product_id"), "product_id", "left_semi")
    listed = tgt.select(F.col("product_id").alias("target_id"),
                        F.posexplode(F.coalesce(F.col("similar_products"), F.array())).alias("_p", "_sid"))
    listed = listed.withColumn("_sid", F.col("_sid").cast(products.schema["product_id"].dataType))
    # first listed position per (target, item): a partially aggregated min
    first = listed.groupBy("target_id", "_sid").agg(F.min("_p").alias("_p"))
    t1 = first.join(cat, first._sid == cat.product_id).drop("_sid")
    t1 = top_n_per_group(t1, ["target_id"], n, [F.col("_p").asc()])
    have_t1 = t1.select("target_id").distinct()
    need = (tgt.select(F.col("product_id").alias("target_id"), "category")
            .join(have_t1, "target_id", "left_anti"))
    # n + 1 products of a category are enough: the target itself may be one
    eligible = products.where(F.col("average_rating") >= SIMILAR_MIN_RATING).select(*REC_COLUMNS)
    if targets is not None:
        eligible = eligible.join(need.select("category").distinct(), "category", "left_semi")
    best = top_n_per_group(eligible, ["category"], n + 1, order_by(*BY_RATING_THEN_RANK), rank_col="_pos")
    t2 = need.join(best, "category").where(F.col("product_id") != F.col("target_id"))
    t2 = top_n_per_group(t2, ["target_id"], n, [F.col("_pos").asc()])
    out = (t1.select("target_id", *REC_COLUMNS, F.lit(1).alias("tier"), "rank")
           .unionByName(t2.select("target_id", *REC_COLUMNS, F.lit(2).alias("tier"), "rank")))
    if targets is not None:
        missing = targets.select(F.col("product_id").alias("target_id")).distinct().join(
            products.select(F.col("product_id").alias("target_id")), "target_id", "left_anti")
        pop_list = _list_scalar(popularity(products, None, n), REC_COLUMNS)
        fb = (missing.select("target_id", F.explode(pop_list).alias("_e"))
              .select("target_id", *[F.col("_e").getField(c).alias(c) for c in REC_COLUMNS],
                      F.lit(0).alias("tier"), F.col("_e").getField("_rank").alias("rank")))
        out = out.unionByName(fb)
    return out


def get_recommendations(products: DataFrame, reviews: DataFrame, user_id=None, product_id=None,
                        n: int = DEFAULT_N) -> DataFrame:
    """A user gets R3, else a product gets R4, else R1."""
    spark = products.sparkSession
    if user_id is not None:
        users = spark.createDataFrame([(user_id,)], "customer_id " + reviews.schema["customer_id"].dataType.simpleString())
        return hybrid(products, reviews, users, n, one_user=True).drop("customer_id")
    if product_id is not None:
        targets = spark.createDataFrame([(product_id,)], "product_id " + products.schema["product_id"].dataType.simpleString())
        return similar_products(products, n, targets).drop("target_id", "tier")
    return popularity(products, None, n)
