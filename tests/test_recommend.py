import pytest
from conftest import PRODUCTS, REVIEWS, best, ids
from pyspark.sql import functions as F

from shelfwise.operators import recommend

BY_RANK = lambda p: (p[3], -(p[6] or 0), p[0])
BY_RATING = lambda p: (-p[6], p[3], p[0])
POPULAR = best(BY_RANK, lambda p: (p[6] or 0) >= 3.5 or p[3] <= 100_000)
CATEGORY = {p[0]: p[2] for p in PRODUCTS}


def content(user, n=None, unseen=False):
    mine = {r[0] for r in REVIEWS if r[1] == user}
    cats = {CATEGORY[x] for x in mine if CATEGORY.get(x) and any(r[0] == x and r[1] == user and r[2] is not None for r in REVIEWS)}
    return best(BY_RATING, lambda p: p[2] in cats and (p[6] or 0) >= 4.0 and not (unseen and p[0] in mine), n)


def test_popularity(shop):
    assert ids(recommend.popularity(shop.products, None, 4)) == POPULAR[:4] == ["G-30", "K-10", "K-11", "G-32"]
    assert ids(recommend.popularity(shop.products, "Toys", 4)) == ["T-51"]
    per = recommend.popularity_per_category(shop.products, 1)
    assert {r.category: r.product_id for r in per.collect()} == {"Garden": "G-30", "Kitchen": "K-10", "Toys": "T-51"}


def test_user_category_profile(shop):
    out = recommend.user_category_profile(shop.products, shop.reviews)
    got = {(r.customer_id, r.category): (r.review_count, r.avg_user_rating) for r in out.collect()}
    assert got[("ada", "Kitchen")] == (3, pytest.approx(10 / 3)) and got[("cleo", "Garden")] == (2, 2.5)
    assert ("dan", "Kitchen") not in got        # only a review without a rating


@pytest.mark.parametrize("unseen", [False, True])
def test_content_based(shop, unseen):
    out = recommend.content_based(shop.products, shop.reviews, 2, exclude_seen=unseen)
    for user in ("ada", "ben", "cleo", "dan"):
        assert ids(out.where(F.col("customer_id") == user)) == content(user, 2, unseen), user


def test_content_for_one_user(shop):
    assert ids(recommend.content_based_for(shop.products, shop.reviews, "dan", 5)) == content("dan", 5)
    assert ids(recommend.content_based_for(shop.products, shop.reviews, "nobody", 3)) == POPULAR[:3]


def test_hybrid_fills_from_popularity(shop, spark):
    out = recommend.hybrid(shop.products, shop.reviews, None, 4)
    for user in ("ada", "ben", "cleo", "dan"):
        want = content(user, 4)
        want += [p for p in POPULAR[:8] if p not in want]
        assert ids(out.where(F.col("customer_id") == user)) == want[:4], user
    users = spark.createDataFrame([("cleo",), ("new",), ("new",)], "customer_id string")
    some = recommend.hybrid(shop.products, shop.reviews, users, 4)
    assert sorted({r.customer_id for r in some.collect()}) == ["cleo", "new"]
    assert ids(some.where("customer_id = 'new'")) == POPULAR[:4]
    assert ids(some.where("customer_id = 'cleo'")) == ids(out.where("customer_id = 'cleo'"))
    repeats = recommend.hybrid(shop.products, shop.reviews, None, 4, dedupe=False)
    cleo = content("cleo", 4)
    assert ids(repeats.where("customer_id = 'cleo'")) == cleo + POPULAR[:4 - len(cleo)]


def test_similar_products_tiers(shop, spark):
    out = recommend.similar_products(shop.products, 3)
    tier = {r.target_id: r.tier for r in out.collect()}
    listed = {"K-10": ["K-12", "G-30"], "K-12": ["K-10"], "G-30": ["G-31"], "T-50": ["T-50", "K-10"]}
    for p in PRODUCTS:
        got = ids(out.where(F.col("target_id") == p[0]))
        if p[0] in listed:
            assert got == listed[p[0]] and tier[p[0]] == 1
        else:
            assert got == best(BY_RATING, lambda c: c[2] == p[2] and c[0] != p[0] and (c[6] or 0) >= 3.5, 3)
            assert tier.get(p[0], 2) == 2
    ask = spark.createDataFrame([("G-31",), ("K-10",), ("unknown",)], "product_id string")
    some = recommend.similar_products(shop.products, 3, ask)
    assert ids(some.where("target_id = 'unknown'")) == POPULAR[:3] and ids(some.where("target_id = 'G-31'")) == ["G-32", "G-30"]
    assert ids(some.where("target_id = 'K-10'")) == ["K-12", "G-30"]


def test_router(shop):
    c = shop
    assert ids(recommend.get_recommendations(c.products, c.reviews, user_id="ben", n=2)) == content("ben", 2)
    assert ids(recommend.get_recommendations(c.products, c.reviews, n=1)) == POPULAR[:1]
    assert ids(recommend.get_recommendations(c.products, c.reviews, product_id="K-12", n=5)) == ["K-10"]


def test_one_user_reads_only_their_reviews(shop):
    plan = recommend.get_recommendations(shop.products, shop.reviews, user_id="ben")._jdf.queryExecution().optimizedPlan()
    reviews = [i for i, line in enumerate(plan.toString().split("\n")) if "LogicalRDD" in line and "review_date" in line]
    lines = plan.toString().split("\n")
    # the nearest join above every scan of the reviews is the one with the asked users
    for i in reviews:
        above = [x for x in lines[:i] if "Join " in x and x.index("Join ") < lines[i].index("LogicalRDD")]
        assert "LeftSemi" in above[-1]
    assert reviews


@pytest.mark.parametrize("unseen", [False, True])
def test_content_candidates_are_dealt_by_their_number(shop, monkeypatch, unseen):
    want = sorted(map(tuple, recommend.content_based(shop.products, shop.reviews, 3, unseen).collect()))
    monkeypatch.setattr(recommend, "ROWS_PER_TASK", 1)
    got = recommend.content_based(shop.products, shop.reviews, 3, unseen)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == want
    dealt = [x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x]
    assert dealt and all("hashpartitioning(customer_id" in x and ", 8)" not in x for x in dealt)
