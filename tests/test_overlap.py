"""Bounded set joins against all pairs, and models updated by increments."""
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfwise.operators import collab, overlap
from shelfwise.sources.testdata import catalog_from_tables


def skewed_rows():
    """Sets of all sizes; token 0 is in a third of all sets, a set holds most tokens."""
    rng = random.Random(8)
    rows = set()
    for s in range(160):
        for _ in range(rng.choice([1, 2, 3, 6, 10, 25])):
            rows.add((s, int(rng.paretovariate(0.6)) % 90 + 1))
        if s % 3 == 0:
            rows.add((s, 0))
    rows |= {(500, t) for t in range(0, 90, 2)} | {(501, t) for t in range(45)}
    rows |= {(600, 1000), (601, 1000), (602, 1000), (603, 2000)}
    return sorted(rows)


ROWS = skewed_rows()


def all_overlaps():
    holders, size = defaultdict(list), Counter(s for s, _ in ROWS)
    for s, t in ROWS:
        holders[t].append(s)
    common = Counter(p for hs in holders.values() for p in combinations(sorted(hs), 2))
    both = defaultdict(list)
    for (a, b), c in common.items():
        both[a].append((b, c, c / (size[a] + size[b] - c)))
        both[b].append((a, c, c / (size[a] + size[b] - c)))
    return both


PARAMETERS = [(128, 1024, 4096), (6, 1024, 4096), (6, 12, 4096), (128, 12, 8), (2, 2, 8), (3, 40, 4096)]


@pytest.fixture(scope="module")
def sets(spark):
    return spark.createDataFrame(ROWS, "s bigint, t bigint").repartition(4).cache()


@pytest.mark.parametrize("n", [5])
@pytest.mark.parametrize("small, heavy, chunk", PARAMETERS)
def test_top_jaccard(spark, sets, small, heavy, chunk, n):
    ok = [s for s in {s for s, _ in ROWS} if s % 4]
    got = overlap.top_jaccard(sets, "s", "t", n, spark.createDataFrame([(s,) for s in ok], "s bigint"), small, heavy, chunk)
    want = {(a, b, c, x, i + 1) for a, bs in all_overlaps().items()
            for i, (b, c, x) in enumerate(sorted((r for r in bs if r[0] % 4), key=lambda r: (-r[2], r[0]))[:n])}
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("n", [40])
@pytest.mark.parametrize("small, heavy, chunk", PARAMETERS)
def test_top_common(sets, small, heavy, chunk, n):
    got = overlap.top_common(sets, "s", "t", n, small, heavy, chunk)
    want = {(a, b, c, i + 1) for a, bs in all_overlaps().items()
            for i, (b, c, _) in enumerate(sorted(bs, key=lambda r: (-r[1], r[0]))[:n])}
    assert {tuple(r) for r in got.collect()} == want


def test_sets_of_strings_and_of_nothing(sets):
    words = sets.select(F.concat(F.lit("x"), "s").alias("s"), F.concat(F.lit("y"), "t").alias("t"))
    assert overlap.top_common(words, "s", "t", 3).count() > 0
    assert overlap.top_jaccard(words.limit(0), "s", "t", 3).count() == 0
    assert overlap.top_common(words.limit(0), "s", "t", 3).count() == 0


def test_few_pairs_are_made(spark):
    """Of products with few customers in common a small part of the pairs is made."""
    inter = spark.range(80_000).selectExpr("id % 4000 as customer_id", "pmod(xxhash64(id), 8000) as product_id").distinct()
    rows, facts = overlap._prepare(inter, "product_id", "customer_id", 128, 1024)
    assert overlap._two_token_pairs(rows, facts).count() * 4 < collab.item_cooccurrence(inter).count()


def test_also_bought_bounded(shop):
    inter = collab.interactions(shop.reviews)
    want = collab.also_bought(collab.fit_similarity(shop.reviews).edges, shop.products, 3)
    assert sorted(map(tuple, collab.also_bought_bounded(inter, shop.products, 3).collect())) == sorted(map(tuple, want.collect()))


def as_dict(model):
    return ({(r.product1, r.product2): (r.co_occurrence_count, round(r.similarity_score, 12)) for r in model.pairs.collect()},
            {(r.customer_id, r.product_id) for r in model.interactions.collect()},
            {r.product_id: r.product_frequency for r in model.frequency.collect()})


def test_update_equals_a_full_fit(spark, shop, tmp_path):
    reviews = shop.reviews.repartition(3)
    full = collab.fit_similarity(reviews)
    full = collab.SimilarityModel(full.interactions, full.pairs, collab.item_frequency(full.interactions))
    late = F.col("customer_id").isin("dan", "ben") | (F.col("review_date") >= "2021-06-01")
    parts = [reviews.where(~F.coalesce(late, F.lit(False))), reviews.where(late), reviews.where(late), reviews.limit(0)]
    collab.fit_similarity(parts[0]).save(str(tmp_path / "model"))
    model = collab.SimilarityModel.load(spark, str(tmp_path / "model"))
    for part in parts[1:]:      # the second repeats the first, the third is empty
        model = collab.update_similarity(model, part)
        assert as_dict(model) == as_dict(full)
    model.save(str(tmp_path / "again"))
    assert as_dict(collab.SimilarityModel.load(spark, str(tmp_path / "again"))) == as_dict(full)


def test_update_reads_the_customers_concerned(spark, tmp_path):
    reviews = catalog_from_tables(spark, SF_SMALL).reviews.cache()
    one = reviews.where("customer_id is not null").agg(F.min("customer_id")).first()[0]
    path = str(tmp_path / "model")
    collab.fit_similarity(reviews.where(F.col("customer_id") != one)).save(path)
    model = collab.SimilarityModel.load(spark, path)
    seen = {}
    write = collab.materialize

    def spy(df, name="stage"):
        out = write(df, name)
        seen.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return out

    collab.materialize = spy
    try:
        new, old = collab.new_interactions(model, reviews.where(F.col("customer_id") == one))
    finally:
        collab.materialize = write
    assert "PartitionFilters: [isnotnull(_bucket" in seen["stored"] and "#" in seen["stored"]
    assert model.interactions.where(F.col("_bucket") == F.pmod(F.xxhash64(F.lit(one)), F.lit(64))).count() < model.interactions.count() / 20
    assert old.count() == 0 and new.count() > 0
    full, got = collab.fit_similarity(reviews), collab.update_similarity(model, reviews.where(F.col("customer_id") == one))
    assert got.pairs.exceptAll(full.pairs).count() == 0 and got.pairs.count() == full.pairs.count()


def test_hot_customer_in_user_cf(spark, monkeypatch):
    """Products dealt out by parts give the result of one list."""
    monkeypatch.setattr(collab, "HOT_CUSTOMER", 4)
    monkeypatch.setattr(collab, "LIST_CHUNK", 3)
    rows = [(c, p) for c in range(30) for p in range(40) if (c * 7 + p * 3) % 5 == 0] + [(99, p) for p in range(36)]
    inter = spark.createDataFrame(rows, "customer_id bigint, product_id bigint")
    cat = spark.createDataFrame([(p, f"t{p}", "c", 4.0, 1, 1.0) for p in range(38)],
                                "product_id bigint, title string, category string, average_rating double, review_count bigint, price double")
    got = {(r.customer_id, r.product_id): (r.recommendation_score, r.user_similarity)
           for r in collab.user_cf(inter, cat, 50).collect()}
    own = defaultdict(set)
    for c, p in rows:
        own[c].add(p)
    want = {}
    for a in own:
        for p in set(range(38)) - own[a]:
            sims = [len(own[a] & own[b]) for b in own if b != a and own[a] & own[b] and p in own[b]]
            if sims:
                want[(a, p)] = (len(sims), pytest.approx(sum(sims) / len(sims)))
    assert got == want


def test_pairs_of_tokens_travel_as_lists(sets):
    rows, facts = overlap._prepare(sets, "s", "t", 128, 1024)
    plan = overlap._two_token_pairs(rows, facts)._jdf.queryExecution().executedPlan().toString()
    assert not any("t2" in x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
