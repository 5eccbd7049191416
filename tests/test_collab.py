from collections import Counter
from itertools import combinations

import pytest
from conftest import PRODUCTS, SF_SMALL, ids, owned
from pyspark.sql import functions as F

from shelfwise.functions.skew import co_members, pair_partitions
from shelfwise.operators import collab

OWNED = owned()
FREQ = Counter(p for own in OWNED.values() for p in own)
PAIRS = Counter(x for own in OWNED.values() for x in combinations(sorted(own), 2))
SCORE = {x: n / (FREQ[x[0]] + FREQ[x[1]] - n) for x, n in PAIRS.items()}
CATALOGUED = {p[0] for p in PRODUCTS}


def plain_also_bought(product):
    out = [(b if a == product else a, s) for (a, b), s in SCORE.items() if product in (a, b)]
    return sorted(((p, s) for p, s in out if p in CATALOGUED), key=lambda x: (-x[1], x[0]))


def plain_popular():
    return sorted((p for p in FREQ if p in CATALOGUED), key=lambda p: (-FREQ[p], p))


def plain_user_cf(user):
    near = [len(OWNED[user] & own) for u, own in OWNED.items() if u != user and OWNED[user] & own]
    score, common = Counter(), Counter()
    for u, own in OWNED.items():
        n = len(OWNED[user] & own)
        if u != user and n:
            for p in (own - OWNED[user]) & CATALOGUED:
                score[p] += 1
                common[p] += n
    assert len(near) <= collab.MAX_NEIGHBOURS
    return {p: (n, common[p] / n) for p, n in score.items()}


def test_interactions_and_frequency(shop):
    inter = collab.interactions(shop.reviews)
    assert {(r.customer_id, r.product_id) for r in inter.collect()} == {(u, p) for u, own in OWNED.items() for p in own}
    assert {r.product_id: r.product_frequency for r in collab.item_frequency(inter).collect()} == FREQ


def test_cooccurrence_and_jaccard(shop):
    inter = collab.interactions(shop.reviews)
    assert {(r.product1, r.product2): r.co_occurrence_count for r in collab.item_cooccurrence(inter).collect()} == PAIRS
    got = {(r.product1, r.product2): r.similarity_score for r in collab.item_jaccard(inter).collect()}
    assert got == {k: pytest.approx(v) for k, v in SCORE.items()}
    assert got[("K-10", "K-11")] == pytest.approx(1 / 3) and got[("G-32", "T-51")] == 1.0


def test_also_bought(shop):
    edges = collab.fit_similarity(shop.reviews).edges
    batch = collab.also_bought(edges, shop.products, 10)
    for product in FREQ:
        want = [(p, pytest.approx(s)) for p, s in plain_also_bought(product)]
        for out in (batch.where(F.col("product1") == product), collab.also_bought(edges, shop.products, 10, product),
                    collab.also_bought_for(collab.interactions(shop.reviews), shop.products, product, 10)):
            assert [(r.product_id, r.similarity_score) for r in out.orderBy("rank").collect()] == want, product
    both = {(r.product1, r.product2): r.similarity_score for r in edges.collect()}
    assert all(0 < s <= 1 and both[(b, a)] == s for (a, b), s in both.items())


def test_salted_pairs_equal_plain_self_join(spark):
    # one hot customer owning a third of all rows; chunk=2 forces salting
    data = [("HOT", f"P{i}") for i in range(30)] + [(f"C{i}", f"P{(i * 7) % 30}") for i in range(60)] + \
           [(f"C{i}", f"P{(i * 11) % 30}") for i in range(60)]
    df = spark.createDataFrame(data, "customer_id string, product_id string").distinct()
    salted = {(r.m1, r.m2): r.co_count for r in co_members(df, "customer_id", "product_id", chunk=2).collect()}
    a, b = df.alias("a"), df.alias("b")
    plain = (a.join(b, (F.col("a.customer_id") == F.col("b.customer_id"))
                    & (F.col("a.product_id") < F.col("b.product_id")))
             .groupBy(F.col("a.product_id").alias("m1"), F.col("b.product_id").alias("m2")).count())
    assert salted == {(r.m1, r.m2): r["count"] for r in plain.collect()}


def test_pair_partitions_follow_the_pairs(spark):
    df = spark.createDataFrame([("hot", i) for i in range(200)], "g string, m int")
    assert pair_partitions(df, "g", 1000) == 21      # 200 * 200 / 2 pairs
    assert pair_partitions(df.limit(0), "g") == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_user_jaccard(shop, spark):
    inter = collab.interactions(shop.reviews)
    want = {(a, b): len(OWNED[a] & OWNED[b]) / len(OWNED[a] | OWNED[b]) for a, b in combinations(sorted(OWNED), 2)}
    got = {(r.customer1, r.customer2): r.similarity for r in collab.user_jaccard(inter).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items() if v}
    ask = spark.createDataFrame([*want, ("ada", "nobody"), ("no", "one")], "customer1 string, customer2 string")
    got = {(r.customer1, r.customer2): r.similarity for r in collab.user_jaccard_pairs(inter, ask).collect()}
    assert got == {**{k: pytest.approx(v) for k, v in want.items()}, ("ada", "nobody"): 0.0, ("no", "one"): 0.0}


def test_user_cf(shop):
    inter = collab.interactions(shop.reviews)
    out = collab.user_cf(inter, shop.products, 10)
    for user in OWNED:
        got = {r.product_id: (r.recommendation_score, r.user_similarity) for r in out.where(F.col("customer_id") == user).collect()}
        assert got == plain_user_cf(user), user
    again = collab.user_cf(inter.repartition(7), shop.products, 10)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_router_and_cold_start(shop):
    c, inter = shop, collab.interactions(shop.reviews)
    assert ids(collab.get_collaborative_recommendations(inter, c.products, user_id="new", n=3)) == plain_popular()[:3]
    assert ids(collab.get_collaborative_recommendations(inter, c.products, n=1)) == plain_popular()[:1]
    warm = collab.get_collaborative_recommendations(inter, c.products, user_id="ben")
    assert {r.product_id for r in warm.collect()} == set(plain_user_cf("ben"))
    want = [p for p, _ in plain_also_bought("G-32")]
    assert ids(collab.get_collaborative_recommendations(inter, c.products, product_id="G-32")) == want
    assert ids(collab.get_also_bought(collab.fit_similarity(c.reviews), c.products, "G-32")) == want


def test_targeted_user_cf_equals_batch(spark):
    from shelfwise.sources.testdata import catalog_from_tables
    c = catalog_from_tables(spark, SF_SMALL)
    inter = collab.interactions(c.reviews)
    users = inter.select("customer_id").distinct().orderBy("customer_id").limit(7)
    batch = collab.user_cf(inter, c.products, 10).join(users, "customer_id", "left_semi")
    targeted = collab.user_cf(inter, c.products, 10, users=users)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, targeted.collect()))


def test_edges_of_equals_filtered_edges(shop):
    model = collab.fit_similarity(shop.reviews)
    one = sorted(map(tuple, model.edges_of("K-10").collect()))
    all_ = sorted(map(tuple, model.edges.where("product1 = 'K-10'").collect()))
    assert one == all_ and len(one) == 4


def test_model_save_load_roundtrip(shop, tmp_path):
    model = collab.fit_similarity(shop.reviews)
    model.save(str(tmp_path / "model"))
    back = collab.SimilarityModel.load(shop.reviews.sparkSession, str(tmp_path / "model"))
    assert sorted(map(tuple, back.edges.collect())) == sorted(map(tuple, model.edges.collect()))
    assert back.interactions.count() == model.interactions.count()


@pytest.mark.parametrize("directed", [False, True])
@pytest.mark.parametrize("chunk, values", [(4096, 2_000_000), (3, 2_000_000), (4096, 5), (3, 5)])
def test_pairs_travel_as_lists(spark, directed, chunk, values):
    """Hot groups and hot members give the plain counts, and no exchange deals rows out by pairs."""
    rows = sorted({(g, m) for g in range(12) for m in range(30) if (g * 7 + m * 5) % 4 == 0 or m == 3 or g == 2}) + [(None, 1), (1, None)]
    df = spark.createDataFrame([(g, m, None if m is None else m * 1000, m is not None and m % 3 > 0) for g, m in rows],
                               "g bigint, m bigint, w bigint, ok boolean")
    got = co_members(df, "g", "m", ["w"], chunk, directed=directed, answers="ok" if directed else None, values_per_task=values)
    want = {}
    for g, a in rows:
        for h, b in rows:
            if g is not None and g == h and None not in (a, b) and (a != b and b % 3 > 0 if directed else a < b):
                want[a, b, a * 1000, b * 1000] = want.get((a, b, a * 1000, b * 1000), 0) + 1
    assert {(r.m1, r.m2, r.w1, r.w2): r.co_count for r in got.collect()} == want
    assert got.schema["m2"].dataType.simpleString() == got.schema["w1"].dataType.simpleString() == "bigint"
    exchanges = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert exchanges and not any("m2" in x for x in exchanges)


def _exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]


def test_also_bought_all(shop):
    got = collab.also_bought_all(collab.interactions(shop.reviews), shop.products, 3)
    want = collab.also_bought(collab.fit_similarity(shop.reviews).edges, shop.products, 3)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_neighbours_shuffle_no_pairs(shop):
    assert not any("m2" in x for x in _exchanges(collab.neighbours(collab.interactions(shop.reviews), 5)))


def test_pairs_of_a_saved_model_are_written_once(shop, tmp_path, monkeypatch):
    written, write = [], collab.materialize
    monkeypatch.setattr(collab, "materialize", lambda df, name="stage": written.append(df.columns) or write(df, name))
    collab.fit_similarity(shop.reviews, store_pairs=False).save(str(tmp_path / "model"))
    assert written and not any("similarity_score" in c for c in written)
