from collections import Counter

import pytest
from conftest import PRODUCTS, REVIEWS

from shelfwise.operators import evaluate, profile


def test_precision_recall(spark):
    actual = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c"), ("v", "x")],
                                   "customer_id string, product_id string")
    pred = spark.createDataFrame([("u", "a", 1), ("u", "z", 2), ("v", "y", 1), ("w", "q", 1)],
                                 "customer_id string, product_id string, rank int")
    got = {r.customer_id: (r.precision, r.recall) for r in evaluate.precision_recall_at_k(actual, pred, 10).collect()}
    assert got == {"u": (0.5, pytest.approx(1 / 3)), "v": (0.0, 0.0)}


def test_all_held_out_items_count(spark):
    actual = spark.createDataFrame([("u", x) for x in "abcde"] + [("none", "a")], "customer_id string, product_id string")
    pred = spark.createDataFrame([("u", "e", 1), ("u", "d", 2), ("u", "a", 3), ("u", "z", 9)],
                                 "customer_id string, product_id string, rank int")
    got = {r.customer_id: tuple(r)[1:] for r in evaluate.precision_recall_at_k(actual, pred, 3).collect()}
    assert got == {"u": (3, 5, 3, 1.0, pytest.approx(0.6)), "none": (0, 1, 0, 0.0, 0.0)}
    cut = {r.customer_id: tuple(r)[1:] for r in evaluate.precision_recall_at_k(actual, pred, 3, cut_actual=True).collect()}
    assert cut["u"] == (1, 3, 3, pytest.approx(1 / 3), pytest.approx(1 / 3))    # only a, b and c count


def test_small_ratios_are_not_rounded_away(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    train, test = evaluate.train_test_split(df, ["k"], 0.004)
    assert 250 < test.count() < 550 and train.count() + test.count() == 100_000


def test_split_is_deterministic_and_complete(shop):
    inter = shop.reviews.select("customer_id", "product_id").distinct()
    tr1, te1 = evaluate.train_test_split(inter, ["customer_id", "product_id"], 0.5)
    tr2, te2 = evaluate.train_test_split(inter.repartition(3), ["customer_id", "product_id"], 0.5)
    assert sorted(te1.collect(), key=repr) == sorted(te2.collect(), key=repr)
    assert tr1.count() + te1.count() == inter.count()


def test_diversity_and_mean(spark):
    recs = spark.createDataFrame([("u", "A", 4.0), ("u", "A", 2.0), ("u", None, 3.0), ("v", "B", 5.0)],
                                 "customer_id string, category string, average_rating double")
    div = {r.customer_id: r.diversity for r in evaluate.diversity(recs).collect()}
    assert div == {"u": pytest.approx(2 / 3), "v": 1.0}
    avg = {r.customer_id: r.avg_rating for r in evaluate.mean_rating(recs).collect()}
    assert avg == {"u": 3.0, "v": 5.0}


def test_rating_error(spark):
    df = spark.createDataFrame([(4.0, 3.0), (2.0, 4.0), (5.0, None)], "rating double, prediction double")
    r = evaluate.rating_error(df).first()
    assert r.rmse == pytest.approx((2.5) ** 0.5) and r.mae == 1.5 and r.n == 2


def test_distributions(shop, spark):
    cats = [(r.category, r["count"]) for r in evaluate.category_distribution(shop.products).collect()]
    assert cats == [("Kitchen", 4), ("Garden", 3), ("Toys", 1), (None, 1)]
    many = spark.createDataFrame([(f"c{i:02d}",) for i in range(25)], "category string")
    assert evaluate.category_distribution(many).count() == 25 and evaluate.category_distribution(many, 10).count() == 10
    assert {r.rating: r["count"] for r in evaluate.rating_distribution(shop.reviews).collect()} == Counter(r[2] for r in REVIEWS)


def test_evaluate_user_cf_runs(shop):
    r = evaluate.evaluate_user_cf(shop.reviews, shop.products, 0.5).first()
    assert 0.0 <= r.precision_at_k <= 1.0 and 0.0 <= r.recall_at_k <= 1.0
    assert r.users_evaluated <= r.test_users_total


def test_profile_and_utilities(shop, spark):
    p = {r.column_name: r for r in profile.profile(shop.products).collect()}
    assert p["sales_rank"].mean == pytest.approx(sum(x[3] for x in PRODUCTS) / 9) and p["title"].mean is None
    assert p["title"].null_count == 1 and p["title"].row_count == 9 and p["title"].column_count == 8
    df = spark.createDataFrame([(1, 0), (3, 4), (None, 2)], "a int, b int")
    assert [r.x for r in df.select(profile.safe_ratio("a", "b").alias("x")).collect()] == [0.0, 0.75, 0.0]
    assert profile.sample(shop.reviews, 0.5, 42).collect() == profile.sample(shop.reviews, 0.5, 42).collect()
    recs = spark.createDataFrame([("T-51", 0.9, "old"), ("K-11", 0.1, "old"), ("K-10", 0.2, "old"), ("x", 1.0, "old")],
                                 "product_id string, score double, title string")
    out = profile.display_join(recs, shop.products)
    assert [(r.product_id, r.title, r.score, r.review_count) for r in out.collect()] == [
        ("K-10", "Copper kettle", 0.2, 6), ("K-11", "Copper pan", 0.1, 2), ("T-51", "Wooden train", 0.9, 5)]
