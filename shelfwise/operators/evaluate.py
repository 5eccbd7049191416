"""Offline evaluation (E1-E9): split, precision/recall@k, diversity, mean
rating, rating error and distributions -- all users in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import order_by, safe_divide, top_n_per_group
from ..session import materialize
from .collab import user_cf

DEFAULT_K = 10
DEFAULT_TEST_RATIO = 0.2
DEFAULT_SEED = 42
ARITH_STEPS = 1_000_003     # a prime


def split_fraction(keys: list[str], seed: int = DEFAULT_SEED, method: str = "hash") -> Column:
    """E5: a deterministic number in [0, 1) per row from its key columns.

    ``hash`` (default) has 2**32 steps and works for any id type; ``arith``
    is plain integer arithmetic on numeric ids, modulo a prime, that a SQL
    engine reproduces exactly.
    """
    if method == "hash":
        steps = 1 << 32
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(steps)) / F.lit(float(steps))
    if method == "arith":
        expr = F.lit(seed).cast("bigint")
        for i, k in enumerate(keys):
            expr = expr + F.col(k) * F.lit([7919, 104729, 1299709][i % 3])
        return F.pmod(expr, F.lit(ARITH_STEPS)) / F.lit(float(ARITH_STEPS))
    raise ValueError(f"unknown split method: {method}")


def train_test_split(df: DataFrame, keys: list[str], test_ratio: float = DEFAULT_TEST_RATIO,
                     seed: int = DEFAULT_SEED, method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """E5: rows go to test when their fraction is below ``test_ratio``; same
    rows on every run and every retry (unlike an unseeded random split)."""
    fraction = split_fraction(keys, seed, method)
    return df.where(fraction >= test_ratio), df.where(fraction < test_ratio)


def split_counts(df: DataFrame, keys: list[str], test_ratio: float = DEFAULT_TEST_RATIO,
                 seed: int = DEFAULT_SEED, method: str = "hash") -> DataFrame:
    """E5 summary: rows and distinct first-key values per side."""
    side = F.when(split_fraction(keys, seed, method) < test_ratio, F.lit("test")).otherwise(F.lit("train"))
    return (df.withColumn("split", side).groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(keys[0]).alias("distinct_keys")))


def precision_recall_at_k(actual: DataFrame, predicted: DataFrame, k: int = DEFAULT_K,
                          cut_actual: bool = False) -> DataFrame:
    """E1/E2 for every user of ``actual(customer_id, product_id)``.

    ``predicted`` has (customer_id, product_id, rank) and counts up to rank
    ``k``. All actual items count; with ``cut_actual`` (the list helpers'
    rule) only the first ``k`` by product id. A user without predicted items
    scores 0. One row of flags for each (user, product) and one aggregate by
    user; neither side is joined.
    """
    a = actual.select("customer_id", "product_id")
    if cut_actual:
        a = top_n_per_group(a.distinct(), ["customer_id"], k, order_by(("product_id", "asc")), rank_col="_ar").drop("_ar")
    flags = a.select("customer_id", "product_id", F.lit(1).alias("_a"), F.lit(0).alias("_p")).unionByName(
        predicted.where(F.col("rank") <= k).select("customer_id", "product_id", F.lit(0).alias("_a"), F.lit(1).alias("_p")))
    per_item = flags.groupBy("customer_id", "product_id").agg(F.max("_a").alias("_a"), F.max("_p").alias("_p"))
    per_user = per_item.groupBy("customer_id").agg(F.sum(F.col("_a") * F.col("_p")).alias("hits"),
                                                   F.sum("_a").alias("n_actual"), F.sum("_p").alias("n_predicted"))
    return per_user.where("n_actual > 0").select(
        "customer_id", "hits", "n_actual", "n_predicted",
        safe_divide(F.col("hits"), F.col("n_predicted")).alias("precision"),
        safe_divide(F.col("hits"), F.col("n_actual")).alias("recall"))


def user_cf_precision_recall(reviews_or_inter: DataFrame, products: DataFrame, test_ratio: float = DEFAULT_TEST_RATIO,
                             k: int = DEFAULT_K, seed: int = DEFAULT_SEED, method: str = "hash") -> DataFrame:
    """E1/E2 of user-based CF for every test user: fitted on the train split
    (neighbours and exclusions from train only), scored on all held-out
    items of the user."""
    inter = reviews_or_inter.select("customer_id", "product_id").where(
        F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()).distinct()
    # both splits read one written copy
    inter = materialize(inter, "interactions")
    train, test = train_test_split(inter, ["customer_id", "product_id"], test_ratio, seed, method)
    recs = user_cf(train, products, k, persist=False).select("customer_id", "product_id", "rank")
    return precision_recall_at_k(test, recs, k)


def evaluate_user_cf(reviews_or_inter: DataFrame, products: DataFrame, test_ratio: float = DEFAULT_TEST_RATIO,
                     k: int = DEFAULT_K, seed: int = DEFAULT_SEED, method: str = "hash") -> DataFrame:
    """Mean precision@k and recall@k over the test users that have
    recommendations, and how many these are of all test users."""
    per_user = user_cf_precision_recall(reviews_or_inter, products, test_ratio, k, seed, method)
    has = F.col("n_predicted") > 0
    return per_user.agg(
        F.coalesce(F.avg(F.when(has, F.col("precision"))), F.lit(0.0)).alias("precision_at_k"),
        F.coalesce(F.avg(F.when(has, F.col("recall"))), F.lit(0.0)).alias("recall_at_k"),
        F.count(F.when(has, 1)).alias("users_evaluated"), F.count(F.lit(1)).alias("test_users_total"))


def diversity(recs: DataFrame, by: str | None = "customer_id") -> DataFrame:
    """Distinct categories / recommended products (NULL category is a
    group of its own), per ``by`` key or overall."""
    keys = [by] if by else []
    cats = F.count_distinct("category") + F.max(F.col("category").isNull().cast("int"))
    return recs.groupBy(*keys).agg(safe_divide(cats, F.count(F.lit(1))).alias("diversity"))


def mean_rating(recs: DataFrame, by: str | None = "customer_id") -> DataFrame:
    """Mean ``average_rating`` of the recommendations, 0.0 if none."""
    keys = [by] if by else []
    return recs.groupBy(*keys).agg(F.coalesce(F.avg("average_rating"), F.lit(0.0)).alias("avg_rating"))


def rating_error(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """RMSE and MAE over rows with a prediction."""
    err = F.col(label) - F.col(prediction)
    return (predictions.where(F.col(prediction).isNotNull())
            .agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                 F.count(F.lit(1)).alias("n")))


def mean_baseline_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Predict each test rating by the product's train mean, else the
    global train mean (a plain baseline for E7)."""
    global_mean = train.select(F.avg("rating")).scalar()
    # written first: the join then has two plain exchanges, and a product with
    # very many test rows can be split
    means = materialize(train.groupBy("product_id").agg(F.avg("rating").alias("_m")), "means")
    return (test.join(means, "product_id", "left")
            .withColumn("prediction", F.coalesce(F.col("_m"), global_mean)).drop("_m"))


def category_distribution(products: DataFrame, top: int | None = None) -> DataFrame:
    """Product count of every category, largest first; only the
    ``top`` largest if given."""
    counts = products.groupBy("category").agg(F.count(F.lit(1)).alias("count"))
    counts = counts.orderBy(F.col("count").desc(), F.col("category").asc_nulls_last())
    return counts.limit(top) if top else counts


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Number of reviews per rating value."""
    return reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
