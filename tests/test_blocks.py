"""Best partners by blocks against brute force, and what travels."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.functions import blocks
from shelfwise.operators import collab, overlap


@pytest.mark.parametrize("pairs", [1, 5, 30, 1 << 20])
@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("weighted", [False, True])
def test_count_equals_brute_force(pairs, same, weighted):
    rng = np.random.default_rng(pairs)
    for _ in range(30):
        rows = int(rng.integers(1, 8))
        lists = [[np.unique(rng.integers(0, 12, rng.integers(1, 8))) for _ in range(rows)] for _ in (0, 1)]
        (a, al), (b, bl) = [(np.concatenate(x), np.array([len(y) for y in x])) for x in lists]
        w = rng.integers(0, 4, len(a)) if weighted else None
        count, total, struck, at = Counter(), Counter(), set(), 0
        for left, right in zip(*lists, strict=True):
            for x in left:
                for y in right:
                    if not (same and x == y):
                        count[x, y] += 1
                        total[x, y] += w[at] if weighted else 1
                        struck |= {(x, y)} if weighted and w[at] == 0 else set()
                at += 1
        names_a, names_b, first_a, first_b, parts = blocks._count(a, al, b, bl, w, same, pairs)
        assert (a[first_a] == names_a).all() and (b[first_b] == names_b).all()
        got = [r for left, right, c, t in parts for r in zip(names_a[left], names_b[right], c, t, strict=True)]
        assert len({r[:2] for r in got}) == len(got)
        assert {tuple(r[:2]): tuple(r[2:]) for r in got} == {p: (n, total[p]) for p, n in count.items() if p not in struck}


def test_top_equals_a_sort():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 9, 50):
        left = np.sort(rng.integers(0, 6, 60))
        for score in (rng.integers(0, 5, 60), rng.integers(0, 5, 60) / 7):
            want = [i for x in np.unique(left) for i in sorted(np.flatnonzero(left == x), key=lambda i: (-score[i], i))[:n]]
            assert list(blocks._top(left, score, n)) == want


@pytest.fixture(scope="module")
def bought(spark):
    rng = np.random.default_rng(5)
    rows = {(int(c), int(p)) for c, p in zip(rng.integers(-3, 40, 500), 10 ** 10 + rng.integers(0, 30, 500) ** 2 // 30, strict=True)}
    return rows, spark.createDataFrame(sorted(rows), "customer_id bigint, product_id bigint")


@pytest.mark.parametrize("list_members, task_members", [(1 << 16, 40_000_000), (3, 90)])
def test_neighbours_and_user_cf_by_blocks(spark, bought, monkeypatch, list_members, task_members):
    """Lists cut into several and many blocks give the same; products
    excluded that nobody bought or that only others did."""
    monkeypatch.setattr(blocks, "LIST_MEMBERS", list_members)
    monkeypatch.setattr(blocks, "TASK_MEMBERS", task_members)
    rows, inter = bought
    own = defaultdict(set)
    for c, p in rows:
        own[c].add(p)
    near = {a: sorted(((-len(own[a] & own[b]), b) for b in own if b != a and own[a] & own[b]))[:7] for a in own}
    got = {tuple(r) for r in collab.neighbours(inter, 7).collect()}
    assert got == {(a, b, -c) for a, bs in near.items() for c, b in bs}
    cat = spark.createDataFrame([(p, "t", "c", 4.0, 1, 1.0) for p in {p for _, p in rows} if p % 5],
                                "product_id bigint, title string, category string, average_rating double, review_count bigint, price double")
    out = {c: set(sorted(ps)[::3]) for c, ps in own.items()}
    exclude = spark.createDataFrame([(c, p) for c, ps in out.items() for p in ps] + [(1, 5)], "customer_id bigint, product_id bigint")
    for given, without in ((None, own), (exclude, out)):
        want = {}
        for a in own:
            met = defaultdict(list)
            for c, b in near[a]:
                for p in own[b] - without[a]:
                    met[p].append(-c)
            best = sorted(((-len(x), p) for p, x in met.items() if p % 5))[:4]
            want |= {(a, p): (-s, pytest.approx(sum(met[p]) / len(met[p])), i + 1) for i, (s, p) in enumerate(best)}
        got = collab.user_cf(inter, cat, 4, 7, exclude=given).collect()
        assert {(r.customer_id, r.product_id): (r.recommendation_score, r.user_similarity, r["rank"]) for r in got} == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_list_is_unrolled_by_row(spark, bought):
    """Neighbours, fan-out and also-bought lists count in blocks, not by a row for each pair."""
    _, inter = bought
    cat = spark.createDataFrame([(10 ** 10 + p, "t", "c", 4.0, 1, 1.0) for p in range(20)],
                                "product_id bigint, title string, category string, average_rating double, review_count bigint, price double")
    asked = inter.select("customer_id").distinct().limit(3)
    for df in (collab.neighbours(inter, 5), collab.user_cf(inter, cat, 3), collab.user_cf(inter, cat, 3, persist=False, users=asked),
               collab.also_bought_all(inter, cat, 3)):
        assert _plan(df).count("MapInArrow") == 2 and "explode" not in _plan(df)


def test_lists_left_open_shuffle_no_pair(bought):
    """Without two common tokens anywhere, all lists are made by blocks."""
    _, inter = bought
    df = overlap.top_jaccard(inter, "product_id", "customer_id", 50)
    assert "MapInArrow" in _plan(df)
    want = collab.directed_edges(collab.item_jaccard(inter))
    rows = {(r.product1, r.product2): r.similarity_score for r in want.collect()}
    got = df.collect()
    assert {(r.a, r.b): r.similarity_score for r in got} == rows and len(got) == len(rows)


@pytest.mark.parametrize("list_members, task_members", [(1 << 16, 24_000_000), (3, 90)])
def test_pairs_by_blocks(bought, monkeypatch, list_members, task_members):
    monkeypatch.setattr(blocks, "LIST_MEMBERS", list_members)
    monkeypatch.setattr(blocks, "TASK_MEMBERS", task_members)
    rows, inter = bought
    own = defaultdict(set)
    for c, p in rows:
        own[p].add(c)
    df = collab.item_cooccurrence(inter)
    assert _plan(df).count("MapInArrow") == 1 and not any("m2" in x for x in _plan(df).splitlines() if "Exchange" in x)
    got = df.collect()
    assert {tuple(r) for r in got} == {(p, q, len(own[p] & own[q]), len(own[p]), len(own[q])) for p in own for q in own if p < q and own[p] & own[q]}
    assert len({(r.product1, r.product2) for r in got}) == len(got)


def test_uncatalogued_products_are_struck_without_the_edges(spark, bought):
    rows, inter = bought
    model = collab.SimilarityModel(inter, collab.item_jaccard(inter), collab.item_frequency(inter))
    for listed in (lambda p: p % 4, lambda p: True):
        cat = spark.createDataFrame([(p, "t", "c", 4.0, 1, 1.0) for p in {p for _, p in rows} if listed(p)],
                                    "product_id bigint, title string, category string, average_rating double, review_count bigint, price double")
        want = collab.also_bought(model.edges, cat, 5)
        got = collab.also_bought(model.edges, cat, 5, known=model.frequency)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "LeftSemi" not in _plan(got) and "LeftAnti" not in _plan(got)
