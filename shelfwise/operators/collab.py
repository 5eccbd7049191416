"""Item-item co-purchase similarity and user-based collaborative filtering
(C1-C10), all users / all items in one distributed plan each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import best_partners, count_pairs, whole_ids
from ..functions.columns import order_by, top_n, top_n_per_group
from ..functions.skew import DEFAULT_CHUNK, co_members, grid_join, group_salts, narrow_types
from ..session import materialize
from .overlap import top_common, top_jaccard
from .search import validate_search_parameters

# Fixed values of the reference behaviour.
MAX_NEIGHBOURS = 100
DEFAULT_N = 10

# A stored model keeps interactions in this many folders by customer.
STORE_BUCKETS = 64
BUCKET = "_bucket"

# Fixed tuning values: products in one list, products of a customer counted in one task, rows unrolled by a task.
LIST_CHUNK = 1024
HOT_CUSTOMER = 65_536
PRODUCTS_PER_TASK = 2_000_000

PRODUCT_COLUMNS = ["product_id", "title", "category", "average_rating", "review_count", "price"]


def interactions(reviews: DataFrame) -> DataFrame:
    """One row per (customer_id, product_id) with ``interaction`` = 1."""
    return (reviews.select("customer_id", "product_id")
            .where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
            .distinct()
            .withColumn("interaction", F.lit(1)))


def item_frequency(inter: DataFrame) -> DataFrame:
    """Number of distinct customers per product."""
    return inter.groupBy("product_id").agg(F.count(F.lit(1)).alias("product_frequency"))


def item_cooccurrence(inter: DataFrame, chunk: int = DEFAULT_CHUNK, persist: bool = True) -> DataFrame:
    """Unordered product pairs (product1 < product2) bought by the same
    customers, with the pair count and both products' frequencies.

    Frequencies ride along the self-join so the pair table -- the largest
    intermediate -- is shuffled once (for the pair aggregation) only. Whole
    numbers as ids are counted by blocks (``functions.blocks``): no pair is shuffled.
    """
    freq = item_frequency(inter)
    if persist:
        # a written side joins by a plain exchange: a hot product can be split
        freq = materialize(freq, "frequency")
    tagged = inter.select("customer_id", "product_id").join(freq, "product_id")
    if persist and whole_ids(tagged, "product_id"):
        tagged = materialize(tagged.where("customer_id is not null and product_id is not null"), "tagged")
        pairs = count_pairs(tagged, "customer_id", "product_id", "product_frequency")
        return pairs.select(F.col("m1").alias("product1"), F.col("m2").alias("product2"), F.col("c").alias("co_occurrence_count"),
                            F.col("size1").alias("frequency1"), F.col("size2").alias("frequency2"))
    pairs = co_members(tagged, "customer_id", "product_id", carry=["product_frequency"],
                       chunk=chunk, count_col="co_occurrence_count", persist=persist)
    return pairs.select(F.col("m1").alias("product1"), F.col("m2").alias("product2"),
                        "co_occurrence_count",
                        F.col("product_frequency1").alias("frequency1"),
                        F.col("product_frequency2").alias("frequency2"))


def jaccard(co: str, f1: str, f2: str):
    """|A and B| / |A or B| from the pair count and the two set sizes."""
    return F.col(co) / (F.col(f1) + F.col(f2) - F.col(co))


def item_jaccard(inter: DataFrame, chunk: int = DEFAULT_CHUNK, persist: bool = True) -> DataFrame:
    """C4 (undirected): product1 < product2 with co-occurrence and score."""
    co = item_cooccurrence(inter, chunk, persist)
    return co.select("product1", "product2", "co_occurrence_count",
                     jaccard("co_occurrence_count", "frequency1", "frequency2").alias("similarity_score"))


def directed_edges(undirected: DataFrame) -> DataFrame:
    """Both directions of a symmetric edge table (the score is symmetric).

    One ``explode`` per row instead of a union, so the pair table is
    aggregated once."""
    cols = [c for c in undirected.columns if c not in ("product1", "product2")]
    both = F.array(F.struct(F.col("product1").alias("a"), F.col("product2").alias("b")),
                   F.struct(F.col("product2").alias("a"), F.col("product1").alias("b")))
    return (undirected.select(F.explode(both).alias("_e"), *cols)
            .select(F.col("_e.a").alias("product1"), F.col("_e.b").alias("product2"), *cols))


@dataclass(frozen=True)
class SimilarityModel:
    """Fitted item-item model. Exists only once fitted, so querying an
    untrained model is impossible by construction. The symmetric scores
    are stored once per unordered pair; ``edges`` is the directed view."""

    interactions: DataFrame
    pairs: DataFrame  # product1 < product2, co_occurrence_count, similarity_score
    frequency: DataFrame | None = None  # product_id, product_frequency (counted from the interactions if not given)

    @property
    def edges(self) -> DataFrame:
        return directed_edges(self.pairs)

    def edges_of(self, product_id) -> DataFrame:
        """Directed edges leaving one product; the filter reaches the stored
        pair table (both orientations) before the directed view."""
        pid = F.lit(product_id)
        near = self.pairs.where((F.col("product1") == pid) | (F.col("product2") == pid))
        return directed_edges(near).where(F.col("product1") == pid)

    def save(self, path: str) -> None:
        """Store the three tables; interactions in ``STORE_BUCKETS`` folders
        by customer, so that an update opens those of its customers only."""
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(STORE_BUCKETS)).cast("int")
        self.interactions.withColumn(BUCKET, bucket).repartition(STORE_BUCKETS, BUCKET) \
            .sortWithinPartitions(BUCKET, "customer_id").write.mode("overwrite").partitionBy(BUCKET) \
            .parquet(f"{path}/interactions")
        self.pairs.write.mode("overwrite").parquet(f"{path}/pairs")
        frequency = self.frequency if self.frequency is not None else item_frequency(self.interactions)
        frequency.write.mode("overwrite").parquet(f"{path}/frequency")

    @staticmethod
    def load(spark, path: str) -> "SimilarityModel":
        return SimilarityModel(spark.read.parquet(f"{path}/interactions"), spark.read.parquet(f"{path}/pairs"),
                               spark.read.parquet(f"{path}/frequency"))


def fit_similarity(reviews: DataFrame, persist: bool = True, chunk: int = DEFAULT_CHUNK,
                   store_pairs: bool = True) -> SimilarityModel:
    """Interactions -> co-occurrence -> Jaccard scores.

    With ``persist`` the interactions and the pair scores are checkpointed
    to the shared folder, so later queries reuse them and survive executor
    loss. A model that is saved at once needs no checkpoint of its pairs
    (``store_pairs=False``).
    """
    inter = interactions(reviews)
    if persist:
        inter = materialize(inter)
    pairs = item_jaccard(inter, chunk, persist)
    if persist and store_pairs:
        pairs = materialize(pairs)
    return SimilarityModel(inter, pairs)


def new_interactions(model: SimilarityModel, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Interactions of ``reviews`` that the model does not have, and the stored
    ones of the customers concerned. Of a stored model only these customers'
    folders are opened."""
    fresh = materialize(interactions(reviews).select("customer_id", "product_id"), "fresh")
    who = materialize(fresh.select("customer_id").distinct(), "customers")
    stored = model.interactions
    if BUCKET in stored.columns:        # a number of folders at most, so the list is short
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(STORE_BUCKETS)).cast("int")
        stored = stored.where(F.col(BUCKET).isin([r[0] for r in who.select(bucket).distinct().collect()]))
    old = materialize(stored.join(who, "customer_id", "left_semi").select("customer_id", "product_id"), "stored")
    return materialize(fresh.join(old, ["customer_id", "product_id"], "left_anti"), "new"), old


def update_similarity(model: SimilarityModel, reviews: DataFrame, chunk: int = DEFAULT_CHUNK) -> SimilarityModel:
    """C5 by increments: the model of the old and the new reviews together.

    Only pairs with a new interaction are made (new with old and new with new
    of the customers concerned) and added to the stored counts; only the
    scores take the frequencies anew. Interactions known already change
    nothing, so an update can be repeated.
    """
    new, old = new_interactions(model, reviews)
    one = lambda df, new_: df.select("customer_id", F.col("product_id").alias("b"), F.lit(new_).alias("new"))
    both = materialize(one(new, True).unionByName(one(old, False)), "both")
    left = new.select("customer_id", F.col("product_id").alias("a"))
    met = grid_join(left, both, "customer_id", "a", "b", both, chunk)
    met = met.where(F.when(F.col("new"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")))
    made = met.groupBy(F.least("a", "b").alias("product1"), F.greatest("a", "b").alias("product2")) \
        .agg(F.count(F.lit(1)).alias("co_occurrence_count"))
    counts = model.pairs.select("product1", "product2", "co_occurrence_count").unionByName(made) \
        .groupBy("product1", "product2").agg(F.sum("co_occurrence_count").alias("co_occurrence_count"))
    known = model.frequency if model.frequency is not None else item_frequency(model.interactions)
    frequency = materialize(known.unionByName(item_frequency(new)).groupBy("product_id")
                            .agg(F.sum("product_frequency").alias("product_frequency")), "frequency")
    f1, f2 = frequency.toDF("product1", "frequency1"), frequency.toDF("product2", "frequency2")
    pairs = counts.join(f1, "product1").join(f2, "product2").select(
        "product1", "product2", "co_occurrence_count",
        jaccard("co_occurrence_count", "frequency1", "frequency2").alias("similarity_score"))
    inter = model.interactions.select("customer_id", "product_id").unionByName(new).withColumn("interaction", F.lit(1))
    return SimilarityModel(materialize(inter, "interactions"), materialize(pairs, "pairs"), frequency)


def also_bought(edges: DataFrame, products: DataFrame, n: int = DEFAULT_N,
                product_id=None, known: DataFrame | None = None) -> DataFrame:
    """Top ``n`` products by similarity for every product (or one).

    Catalogue membership is applied before the limit (uncatalogued items
    do not shrink the list) as a semi join on ids only; the per-product
    limit is a WindowGroupLimit, trimmed map-side before the shuffle; the
    display columns are joined to the ``n`` survivors per product. With
    ``known`` (all ``product_id`` that edges can have) those of them that are
    not catalogued are struck instead: few, so that edges need no shuffle.
    """
    validate_search_parameters(n=n)
    if product_id is not None:
        edges = edges.where(F.col("product1") == F.lit(product_id))
    ids = products.select(F.col("product_id").alias("product2"))
    kept = edges.select("product1", "product2", "similarity_score")
    if known is None:
        kept = kept.join(ids, "product2", "left_semi")
    else:
        strange = materialize(known.select(F.col("product_id").alias("product2")).join(ids, "product2", "left_anti"), "strange")
        kept = kept if strange.isEmpty() else kept.join(strange, "product2", "left_anti")
    ranked = top_n_per_group(kept, ["product1"], n,
                             order_by(("similarity_score", "desc"), ("product2", "asc")))
    cat = products.select(*PRODUCT_COLUMNS)
    joined = ranked.join(cat, ranked.product2 == cat.product_id)
    return joined.select("product1", *PRODUCT_COLUMNS, "similarity_score", "rank")


def also_bought_all(inter: DataFrame, products: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """C6 for every product in one go: the lists of :func:`also_bought`. Each
    product meets the catalogued products of its customers' lists and keeps
    its best ``n`` where they are counted; no pair or edge is shuffled. Whole
    numbers as ids meet by blocks (``functions.blocks``)."""
    validate_search_parameters(n=n)
    inter = materialize(inter.select("customer_id", "product_id"), "interactions")
    freq = materialize(item_frequency(inter), "frequency")
    ids = products.select("product_id").distinct().withColumn("listed", F.lit(True))
    facts = materialize(freq.join(ids, "product_id", "left")
                        .select("product_id", "product_frequency", F.col("listed").isNotNull().alias("listed")), "facts")
    if whole_ids(inter, "product_id"):
        tagged = materialize(inter.where("customer_id is not null").join(facts, "product_id"), "tagged")
        best = best_partners(tagged.select("customer_id", F.col("product_id").alias("a"), F.col("product_frequency").alias("fa")),
                             tagged.where("listed").select("customer_id", F.col("product_id").alias("b"), F.col("product_frequency").alias("fb")),
                             "customer_id", "a", "b", n, "jaccard", "fa", "fb", same=True)
        joined = best.join(products.select(*PRODUCT_COLUMNS), F.col("b") == F.col("product_id"))
        return joined.select(F.col("a").alias("product1"), *PRODUCT_COLUMNS, "similarity_score", "rank")
    met = co_members(inter.join(facts, "product_id"), "customer_id", "product_id", carry=["product_frequency"],
                     count_col="co_occurrence_count", directed=True, answers="listed")
    scored = met.select(F.col("m1").alias("product1"), F.col("m2").alias("product2"), jaccard(
        "co_occurrence_count", "product_frequency1", "product_frequency2").alias("similarity_score"))
    ranked = top_n_per_group(scored, ["product1"], n, order_by(("similarity_score", "desc"), ("product2", "asc")))
    joined = ranked.join(products.select(*PRODUCT_COLUMNS), F.col("product2") == F.col("product_id"))
    return joined.select("product1", *PRODUCT_COLUMNS, "similarity_score", "rank")


def also_bought_bounded(inter: DataFrame, products: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """C6 for every product without the table of all pairs: the lists of
    :func:`also_bought`, found by two common customers and bounds
    (``operators.overlap``)."""
    validate_search_parameters(n=n)
    ranked = top_jaccard(inter, "product_id", "customer_id", n, products)
    joined = ranked.withColumnRenamed("a", "product1").join(products.select(*PRODUCT_COLUMNS),
                                                            F.col("b") == F.col("product_id"))
    return joined.select("product1", *PRODUCT_COLUMNS, "similarity_score", "rank")


def neighbours_bounded(inter: DataFrame, max_neighbours: int = MAX_NEIGHBOURS) -> DataFrame:
    """The neighbours of :func:`neighbours` without the table of all pairs."""
    return top_common(inter, "customer_id", "product_id", max_neighbours).select(
        F.col("a").alias("customer_id"), F.col("b").alias("neighbour_id"), F.col("c").alias("common_products"))


def popular_by_interactions(inter: DataFrame, products: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """The ``n`` products with most interactions, with catalogue columns."""
    validate_search_parameters(n=n)
    counts = inter.groupBy("product_id").agg(F.count(F.lit(1)).alias("interaction_count"))
    joined = counts.join(products.select(*PRODUCT_COLUMNS), "product_id")
    return top_n(joined, n, order_by(("interaction_count", "desc"), ("product_id", "asc")), rank_col="rank")


def user_overlap(inter: DataFrame, chunk: int = DEFAULT_CHUNK, with_degrees: bool = True,
                 persist: bool = True, written: bool = False) -> DataFrame:
    """Unordered customer pairs (customer1 < customer2) with the number of
    products both bought (and both customers' item counts when
    ``with_degrees``)."""
    base = inter.select("customer_id", "product_id")
    if not with_degrees:
        pairs = co_members(base, "product_id", "customer_id", chunk=chunk, count_col="common_products",
                           persist=persist, written=written)
        return pairs.select(F.col("m1").alias("customer1"), F.col("m2").alias("customer2"), "common_products")
    degree = inter.groupBy("customer_id").agg(F.count(F.lit(1)).alias("items"))
    if persist:
        degree = materialize(degree, "degree")
    tagged = base.join(degree, "customer_id")
    pairs = co_members(tagged, "product_id", "customer_id", carry=["items"],
                       chunk=chunk, count_col="common_products", persist=persist)
    return pairs.select(F.col("m1").alias("customer1"), F.col("m2").alias("customer2"),
                        "common_products", "items1", "items2")


def user_jaccard(inter: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """C9 for all pairs that share a product (others are 0.0)."""
    ov = user_overlap(inter, chunk)
    return ov.select("customer1", "customer2", "common_products",
                     jaccard("common_products", "items1", "items2").alias("similarity"))


def user_jaccard_pairs(inter: DataFrame, pairs: DataFrame) -> DataFrame:
    """C9 for requested ``(customer1, customer2)`` pairs: Jaccard of the two
    product sets, 0.0 when either set is empty or they are disjoint."""
    deg = inter.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_d"))
    a = inter.select(F.col("customer_id").alias("customer1"), "product_id")
    b = inter.select(F.col("customer_id").alias("customer2"), "product_id")
    req = pairs.select("customer1", "customer2").distinct()
    common = (req.join(a, "customer1").join(b, ["customer2", "product_id"])
              .groupBy("customer1", "customer2").agg(F.count(F.lit(1)).alias("_c")))
    d1 = deg.select(F.col("customer_id").alias("customer1"), F.col("_d").alias("_d1"))
    d2 = deg.select(F.col("customer_id").alias("customer2"), F.col("_d").alias("_d2"))
    out = (req.join(common, ["customer1", "customer2"], "left")
           .join(d1, "customer1", "left").join(d2, "customer2", "left"))
    c = F.coalesce(F.col("_c"), F.lit(0))
    union = F.coalesce(F.col("_d1"), F.lit(0)) + F.coalesce(F.col("_d2"), F.lit(0)) - c
    return out.select("customer1", "customer2",
                      F.when(union > 0, c / union).otherwise(F.lit(0.0)).alias("similarity"))


def neighbours(inter: DataFrame, max_neighbours: int = MAX_NEIGHBOURS,
               chunk: int = DEFAULT_CHUNK, persist: bool = True, users: DataFrame | None = None,
               written: bool = False, one_user: bool = False) -> DataFrame:
    """Per customer, the ``max_neighbours`` other customers with the most
    products in common (ties by customer id). With ``users`` only those
    customers' neighbours are computed (their items joined to all buyers),
    instead of every overlapping pair; for ``one_user`` in one plain join
    that writes nothing. Whole numbers as ids meet by blocks
    (``functions.blocks``)."""
    base, asks = inter.select("customer_id", "product_id"), None
    if not one_user and whole_ids(base, "customer_id"):
        base = base.where("customer_id is not null and product_id is not null")
        base = base if written else materialize(base, "bought")
        mine = base
        if users is not None:
            mine = materialize(base.join(users.select("customer_id").distinct(), "customer_id", "left_semi"), "asking")
            base = materialize(base.join(mine.select("product_id").distinct(), "product_id", "left_semi"), "met")
        best = best_partners(mine.withColumnRenamed("customer_id", "a"), base.withColumnRenamed("customer_id", "b"),
                             "product_id", "a", "b", max_neighbours, same=True)
        return best.select(F.col("a").alias("customer_id"), F.col("b").alias("neighbour_id"), F.col("c").alias("common_products"))
    if one_user:
        mine = base.join(users.select("customer_id").distinct(), "customer_id", "left_semi")
        met = (mine.select("product_id", F.col("customer_id").alias("m1"))
               .join(base.select("product_id", F.col("customer_id").alias("m2")), "product_id").where(F.col("m1") != F.col("m2"))
               .groupBy("m1", "m2").agg(F.count(F.lit(1)).alias("common_products")))
    elif users is not None:
        asking = users.select("customer_id").distinct().withColumn("asks", F.lit(True))
        base = base.join(asking, "customer_id", "left").withColumn("asks", F.col("asks").isNotNull())
        base = materialize(base, "asking")
        base = base.join(base.where("asks").select("product_id").distinct(), "product_id", "left_semi")
        asks = "asks"
    if not one_user:
        met = co_members(base, "product_id", "customer_id", chunk=chunk, count_col="common_products",
                         persist=persist or users is not None, written=written and users is None, directed=True, asks=asks)
    both = met.select(F.col("m1").alias("customer1"), F.col("m2").alias("customer2"), "common_products")
    ranked = top_n_per_group(both, ["customer1"], max_neighbours,
                             order_by(("common_products", "desc"), ("customer2", "asc")), rank_col="_nr")
    return ranked.select(F.col("customer1").alias("customer_id"),
                         F.col("customer2").alias("neighbour_id"), "common_products")


def user_cf(inter: DataFrame, products: DataFrame, n: int = DEFAULT_N,
            max_neighbours: int = MAX_NEIGHBOURS, exclude: DataFrame | None = None,
            chunk: int = DEFAULT_CHUNK, persist: bool = True, users: DataFrame | None = None,
            one_user: bool = False) -> DataFrame:
    """C7 for every customer with history.

    Score of an item = number of the customer's neighbours who bought it;
    ``user_similarity`` = mean common-product count of those neighbours.
    Items the customer already has (``exclude``, default ``inter``) are
    removed by an anti join; only catalogued items count; top ``n`` by
    score, ties by product id.
    """
    validate_search_parameters(n=n)
    if persist:
        # read many times below: write once to the shared checkpoint folder
        inter = materialize(inter.select("customer_id", "product_id"))
    blocks = not one_user and whole_ids(inter, "customer_id", "product_id")
    nb = neighbours(inter, max_neighbours, chunk, persist=persist, users=users, written=persist, one_user=one_user)
    owned = (exclude if exclude is not None else inter).select("customer_id", "product_id")
    if users is not None:
        owned = owned.join(users.select("customer_id").distinct(), "customer_id", "left_semi")
    # catalogue membership on the (small) item side, before the fan-out
    items = (inter.select("customer_id", "product_id")
             .join(products.select("product_id"), "product_id", "left_semi"))
    if persist or blocks:
        nb, items = materialize(nb, "neighbours"), materialize(items, "items")
        if not blocks or exclude is not None:
            owned = materialize(owned, "owned")
    if blocks:
        ranked = _fan_out_in_blocks(nb, items, owned if exclude is not None else None, n)
    else:
        ranked = top_n_per_group(_fan_out(nb, items, owned, persist), ["customer_id"], n,
                                 order_by(("recommendation_score", "desc"), ("product_id", "asc")))
    joined = ranked.join(products.select(*PRODUCT_COLUMNS), "product_id")
    return joined.select("customer_id", *PRODUCT_COLUMNS, "recommendation_score", "user_similarity", "rank")


def _lists(rows: DataFrame, chunk: int = LIST_CHUNK, persist: bool = True) -> DataFrame:
    """``(customer_id, products)``: a customer's products in lists of about
    ``chunk`` at most."""
    salts = group_salts(rows, "customer_id", chunk)
    salts = materialize(salts, "salts") if persist else salts
    part = F.pmod(F.xxhash64("product_id"), F.coalesce("_n", F.lit(1)))
    return (rows.join(salts, "customer_id", "left").groupBy("customer_id", part.alias("_part"))
            .agg(F.collect_list("product_id").alias("products")).drop("_part"))


def _fan_out(nb: DataFrame, items: DataFrame, owned: DataFrame, persist: bool) -> DataFrame:
    """``(customer_id, product_id, recommendation_score, user_similarity)`` of
    all products of a customer's neighbours that the customer does not have.

    Lists of products travel, one for each neighbour, and are unrolled where
    they are counted: the shuffle carries a row for each neighbour instead of
    one for each neighbour and product. Owned products come along as a list
    with a flag. A customer with very many products is dealt out by parts of
    the products."""
    spark = nb.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the lists travel in the smallest type that holds the ids
    own = items.schema["product_id"].dataType
    kind = narrow_types(items.select("product_id").unionByName(owned.select("product_id")), ["product_id"])["product_id"]
    lists = _lists(items, persist=persist)
    size = items.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_d"))
    rows = nb.join(size, nb.neighbour_id == size.customer_id).agg(F.sum("_d")).first()[0] or 0 if persist else 0
    travel = F.col("products").cast(f"array<{kind}>").alias("products")
    fanned = nb.join(lists.withColumnRenamed("customer_id", "neighbour_id"), "neighbour_id") \
        .select("customer_id", "common_products", travel)
    mine = _lists(owned, persist=persist).select("customer_id", F.lit(None).cast("bigint").alias("common_products"), travel)
    hot = group_salts(owned, "customer_id", HOT_CUSTOMER)
    sent = fanned.unionByName(mine).join(materialize(hot, "hot") if persist else hot, "customer_id", "left")
    n = F.coalesce("_n", F.lit(1))
    sent = sent.select("customer_id", "common_products", "products", n.alias("_n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("_part"))
    # each partition unrolls far more rows than it reads, so the number of rows sets the number of partitions
    sent = sent.repartition(max(least, int(rows / PRODUCTS_PER_TASK) + 1), "customer_id", "_part")
    here = (F.col("_n") == 1) | (F.pmod(F.xxhash64("product_id"), F.col("_n")) == F.col("_part"))
    return (sent.select("customer_id", "_part", "_n", "common_products", F.explode("products").alias("product_id")).where(here)
            .groupBy("customer_id", "_part", "product_id")
            .agg(F.count("common_products").alias("recommendation_score"),
                 F.avg("common_products").alias("user_similarity"),
                 F.count(F.lit(1)).alias("_all"))
            .where(F.col("recommendation_score") == F.col("_all"))
            .select("customer_id", F.col("product_id").cast(own).alias("product_id"), "recommendation_score", "user_similarity"))


def _fan_out_in_blocks(nb: DataFrame, items: DataFrame, owned: DataFrame | None, n: int) -> DataFrame:
    """The ``n`` best rows of :func:`_fan_out` for each customer, ranked. A
    customer meets the products of its neighbours by blocks; it meets its own
    ones (``owned``, by default its ``items``) with weight 0, which strikes them."""
    own = items.schema["product_id"].dataType
    right = items.select(F.col("customer_id").alias("_g"), F.col("product_id").alias("b"))
    left = nb.select(F.col("neighbour_id").alias("_g"), F.col("customer_id").alias("a"), F.col("common_products").alias("w"))
    mine = nb.select("customer_id").distinct()
    if owned is not None:       # groups of their own: what a neighbour owns says nothing of its items
        kind = lambda df, k: df.withColumn("_g", F.struct(F.lit(k).alias("own"), F.col("_g").alias("id")))
        held = owned.where("product_id is not null").select(F.col("customer_id").alias("_g"), F.col("product_id").cast(own).alias("b")).distinct()
        right = kind(right, False).unionByName(kind(held, True))
        left = kind(left, False)
        mine = kind(mine.withColumn("_g", F.col("customer_id")), True)
    else:
        mine = mine.withColumn("_g", F.col("customer_id"))
    left = left.unionByName(mine.select("_g", F.col("customer_id").alias("a"), F.lit(0).cast("bigint").alias("w")))
    best = best_partners(left, right, "_g", "a", "b", n, weight="w")
    return best.select(F.col("a").alias("customer_id"), F.col("b").alias("product_id"), F.col("c").alias("recommendation_score"),
                       (F.col("total") / F.col("c")).alias("user_similarity"), "rank")


def recommend_for_users(inter: DataFrame, products: DataFrame, users: DataFrame,
                        n: int = DEFAULT_N, one_user: bool = False) -> DataFrame:
    """C7 with C8 fallback for requested ``users`` (column ``customer_id``):
    users with history get user-based CF, others the most-interacted list."""
    validate_search_parameters(n=n)
    if not one_user:        # read by several branches
        inter = materialize(inter.select("customer_id", "product_id"), "interactions")
    known = users.join(inter.select("customer_id").distinct(), "customer_id", "left_semi")
    cf = user_cf(inter, products, n, persist=False, users=known, one_user=one_user)
    cold = users.join(known, "customer_id", "left_anti")
    pop = popular_by_interactions(inter, products, n)
    pop_list = pop.select(F.collect_list(F.struct(*[F.col(c) for c in pop.columns])).alias("l")).scalar()
    fallback = (cold.select("customer_id", F.explode(pop_list).alias("_p"))
                .select("customer_id", *[F.col("_p").getField(c).alias(c) for c in PRODUCT_COLUMNS],
                        F.col("_p").getField("interaction_count").alias("recommendation_score"),
                        F.lit(None).cast("double").alias("user_similarity"),
                        F.col("_p").getField("rank").alias("rank")))
    return cf.unionByName(fallback)


def also_bought_for(inter: DataFrame, products: DataFrame, product_id, n: int = DEFAULT_N) -> DataFrame:
    """C6 for one product straight from the interactions: what its customers
    have, and the sizes of these products. No pair table is built."""
    validate_search_parameters(n=n)
    mine = inter.where(F.col("product_id") == F.lit(product_id)).select("customer_id")
    size = mine.select(F.count(F.lit(1))).scalar()
    co = (inter.join(mine, "customer_id", "left_semi").where(F.col("product_id") != F.lit(product_id))
          .groupBy("product_id").agg(F.count(F.lit(1)).alias("_co")))
    freq = item_frequency(inter.join(co.select("product_id"), "product_id", "left_semi"))
    scored = co.join(freq, "product_id").select("product_id", (
        F.col("_co") / (size + F.col("product_frequency") - F.col("_co"))).alias("similarity_score"))
    joined = products.select(*PRODUCT_COLUMNS).join(scored, "product_id")
    return top_n(joined, n, order_by(("similarity_score", "desc"), ("product_id", "asc")), rank_col="rank")


def get_collaborative_recommendations(inter: DataFrame, products: DataFrame, user_id=None,
                                      product_id=None, n: int = DEFAULT_N) -> DataFrame:
    """A user gets C7 (C8 when without history), a product gets C6,
    otherwise C8. Reads what the key needs; no model is fitted."""
    spark = products.sparkSession
    if user_id is not None:
        users = spark.createDataFrame(
            [(user_id,)], "customer_id " + inter.schema["customer_id"].dataType.simpleString())
        return recommend_for_users(inter, products, users, n, one_user=True).drop("customer_id")
    if product_id is not None:
        return also_bought_for(inter, products, product_id, n)
    return popular_by_interactions(inter, products, n)


def get_also_bought(model: SimilarityModel, products: DataFrame, product_id, n: int = DEFAULT_N) -> DataFrame:
    """C6 for one product of a fitted model."""
    return also_bought(model.edges_of(product_id), products, n).drop("product1")
