"""Near duplicates, embeddings, substrings and lines against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_fixtures import empty, found, messy, messy_rows, sentence  # noqa: F401

from shelfwise.llm import embedding_dedup, graph, line_dedup, simhash, substring_dedup


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def brute_components(ids, fps, bits=4):
    n = len(ids)
    c = classes_of(n, [(i, j) for i in range(n) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= bits])
    best = {}
    for i, x in zip(c, ids):
        if x is not None:
            best[i] = min(best.get(i, x), x)
    return [best.get(i) for i in c]


def test_simhash_equals_brute_force(messy):
    rows = messy_rows()
    fps = [plain_simhash(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], [f"{x:016x}" for x in fps], brute_components([r[0] for r in rows], fps)), key=repr)
    got = simhash.near_duplicates(messy).withColumn("fp", simhash.fp_hex("fp"))
    assert found(got, "doc_id", "fp", "component_id") == want


def test_fingerprint_links_with_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    fps = {0, *seeds}
    for s in seeds[:6]:
        for _ in range(40):
            fps.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), 4)
    got = dict(graph.components(edges).collect())
    c = classes_of(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert Counter(Counter(c).values()) == Counter(Counter(got.get(x, x) for x in signed).values())


def test_thresholds_use_every_unit():
    cost = np.random.default_rng(1).random((50, 4, 6)).cumsum(2)
    give, best = simhash.allocate(cost, 5)
    assert (give.sum(1) == 5).all()
    every = [u for u in np.ndindex(6, 6, 6, 6) if sum(u) == 5]
    assert np.allclose(best, [min(sum(c[i, u] for i, u in enumerate(x)) for x in every) for c in cost])


def test_one_document_of_each_group_stays(messy):
    kept = simhash.keep_representatives(messy)
    assert kept.columns == messy.columns
    rows = messy_rows()
    fps = [plain_simhash(r[1]) for r in rows]
    c = classes_of(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert kept.count() == len(set(c))
    want = {v for v in brute_components([r[0] for r in rows], fps) if v is not None}
    assert {r[0] for r in kept.select("doc_id").collect()} - {None} == want


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (203, 201), (201, 202), (203, 202), (203, 201)]
    got = dict(graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {**{i: 0 for i in range(61)}, 201: 201, 202: 201, 203: 201}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(5):
        rows += [(100 + 20 * i + j, (base[i] + rng.normal(size=16) * 0.12).tolist()) for j in range(15)]
    rows += [(300, base[0].tolist()), (301, (base[0] * 7).tolist()), (302, base[29].tolist()), (302, base[28].tolist())]
    rows += [(310, None), (311, [0.0] * 16), (312, [1.0] * 15 + [None]), (313, [float("nan")] + [1.0] * 15),
             (314, [float("inf")] + [1.0] * 15), (315, [1.0] * 4), (316, []), (None, base[3].tolist()), (None, None),
             (317, [1e200] * 16), (318, [1e-200] * 16)]
    return rows


@pytest.mark.parametrize("chunk", [2048, 8])
def test_embeddings_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    rows = vectors()
    ok = [v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    unit = [embedding_dedup.unit(np.array([v]))[0] if k else None for (_, v), k in zip(rows, ok)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if ok[i] and ok[j] and unit[i] @ unit[j] >= 0.9]
    degree = Counter(x for p in links for x in p)
    c = classes_of(len(rows), links)
    best = {}
    for i, (x, _) in zip(c, rows):
        if x is not None:
            best[i] = min(best.get(i, x), x)
    want = [(x, degree[i], best.get(c[i]), x is not None and x == best.get(c[i])) for i, (x, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    df = df.selectExpr("*", "'x' as node", "'x' as v", "1 as ok", "2 as h1", "3 as links")
    got = embedding_dedup.near_duplicates(df, reach=15 ** 0.5)
    assert found(got, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall_at_the_default_reach(spark):
    rng = np.random.default_rng(2)
    x = embedding_dedup.unit(rng.normal(size=(1500, 64)))
    other = embedding_dedup.unit(rng.normal(size=(1500, 64)))
    other = embedding_dedup.unit(other - (other * x).sum(1, keepdims=True) * x)
    near = 0.901 * x + (1 - 0.901 ** 2) ** 0.5 * other            # just above the threshold
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, near]))]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert got.where("n_links > 0").count() >= 0.99 * 3000


@pytest.mark.parametrize("dim, rank", [(64, 8), (128, 16)])
def test_embedding_recall_on_vectors_of_low_rank(spark, dim, rank):
    rng = np.random.default_rng(rank)
    low = embedding_dedup.unit(rng.normal(size=(1500, rank)))
    other = embedding_dedup.unit(rng.normal(size=(1500, rank)))
    other = embedding_dedup.unit(other - (other * low).sum(1, keepdims=True) * low)
    low = np.concatenate([low, 0.901 * low + (1 - 0.901 ** 2) ** 0.5 * other])
    x = embedding_dedup.unit(low @ np.linalg.qr(rng.normal(size=(dim, rank)))[0].T)
    links = int((x @ x.T >= 0.9).sum()) - len(x)
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                                                "vec_id bigint, embedding array<double>"))
    assert sum(r["n_links"] for r in got.collect()) >= 0.999 * links


def brute_substrings(rows, window):
    first, out = {}, []
    order = lambda i: (i is None, i)
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    late = {}
    for i, w in texts:
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if i is None:
                late.setdefault(g, []).append(w)
            elif g not in first or order(i) < order(first[g]):
                first[g] = i
    for i, w in texts:
        gone = set()
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if g in first and order(first[g]) < order(i):
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [8, 50])
def test_substrings_equal_brute_force(messy, window):
    got = substring_dedup.repeated_spans(messy, window=window)
    rows = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept_sha256"])
            for r in got.collect()]
    assert sorted(rows, key=repr) == brute_substrings(messy_rows(), window)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    for _ in range(60):
        v, window = rng.choice([1, 2, 3, 50]), rng.choice([3, 8, 13, 50])
        base = [rng.randrange(v) for _ in range(150)]
        docs = [[x for _ in range(3) for x in rng.choice([
            [rng.randrange(v)] * rng.randrange(1, 60), base[rng.randrange(100):], [rng.randrange(v) for _ in range(4)] * 9])]
            for _ in range(5)]
        words, first = substring_dedup._joined([[b"%d" % x for x in d] for d in docs])
        flat, seen = [x for d in docs for x in d], {}
        for k, a, d1, _ in zip(*(x.tolist() for x in substring_dedup.anchors(words, first, window))):
            assert seen.setdefault(tuple(flat[k:k + window]), (a, d1)) == (a, d1)
        assert len({d1 for _, d1 in seen.values()}) == len(seen)


def test_patience_alignment_is_common_and_rising():
    rng = random.Random(6)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randrange(0, 25))]
        b = [rng.randrange(12) for _ in range(rng.randrange(0, 25))]
        pairs = line_dedup.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(line_dedup.align(a, a)) == len(a)


def test_only_blocks_of_enough_words_go():
    a, b = [1, 2, 3, 9, 4], [7, 1, 2, 8, 4]
    assert line_dedup.common_blocks(a, b, [9, 5, 4, 9, 3], 8) == [1, 2]
    assert line_dedup.common_blocks(a, b, [9, 5, 4, 9, 8], 8) == [1, 2, 4]


def test_lines_of_the_later_document_go(messy):
    out = line_dedup.dedup_lines(messy)
    assert out.columns == messy.columns and out.count() == messy.count()
    before = sorted(((r[0], r[1]) for r in messy_rows()), key=repr)
    text = {}
    for r in out.collect():
        text.setdefault(r["doc_id"], []).append(r["text"])
    line = "first line of eight good words right here"
    rows = {r[0]: r[1] for r in messy_rows()}
    assert text[72] == [f"{line}\n\nlast"]          # its middle line is document 10
    assert text[73] == ["more"]                      # lines of 10 and of 72
    assert text[20] == text[21] == text[22] == [""]  # copies
    assert text[40] == [None] and text[41] == [""] and text[42] == [" \n\t "] and text[43] == ["one two"]
    assert text[50] == ["", ""]                      # a repeated row of document 6
    assert text[70] == [rows[70]] and text[31] == [rows[31]]
    assert len(before) == sum(map(len, text.values()))


def all_pairs(rows, min_words=8):
    """Every document aligned with every earlier one; distinct ids and texts."""
    code = {}
    texts = [(i, t.split("\n")) for i, t in sorted(rows)]
    coded = [[code.setdefault(x, len(code) + 1) if x.split() else 0 for x in t] for _, t in texts]
    out = {}
    for k, (i, t) in enumerate(texts):
        words = [len(x.split()) for x in t]
        gone = {x for e in range(k) for x in line_dedup.common_blocks(coded[e], coded[k], words, min_words)}
        out[i] = "\n".join(x for j, x in enumerate(t) if j not in gone)
    return out


def test_every_line_of_a_block_is_in_a_run_of_the_block():
    rng = random.Random(12)
    for _ in range(300):
        words = [rng.choice([0, 1, 3, 4, 5, 9]) for _ in range(rng.randrange(1, 14))]
        runs = line_dedup._runs(words, words, 8)
        assert len(runs) <= 2 * len(words)
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                if sum(words[i:j]) >= 8:
                    assert {k for s, e in runs if i <= s and e <= j for k in range(s, e)} == set(range(i, j))


def overlapping():
    """Blocks of short lines whose lines have other first and other previous
    holders each; moved and repeated long lines; blank lines."""
    rng = random.Random(13)
    short = [f"s{i} a b c" for i in range(12)]
    rows = [(i, f"own {i}\n{x}\nmore {i}") for i, x in enumerate(short)]                    # the first holders
    rows += [(20, "\n".join(short[:4])), (21, "x\n" + "\n".join(short[2:8]) + "\ny")]
    rows += [(30 + i, f"late {i}\n{x}\nend {i}") for i, x in enumerate(short)]               # the previous ones
    rows += [(50, "z\n" + "\n".join(short[:4]) + "\n\nw"), (51, "u\n" + "\n".join(short[1:7]) + "\nv")]
    long = [sentence(rng, 9) for _ in range(8)]
    for i in range(60, 130):
        body = [rng.choice(long + short + ["", f"only {i}"]) for _ in range(rng.randrange(2, 14))]
        rows.append((i, "\n".join([f"start {i}", *body, f"stop {i}"])))
    return rows


@pytest.mark.parametrize("early", [1, 16])
def test_lines_equal_the_alignment_of_all_pairs(spark, early):
    rows = overlapping()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = all_pairs(rows)
    assert want[50] == "z\n\nw"
    assert dict(line_dedup.dedup_lines(df, early=early).collect()) == want


def boilerplate(seed):
    """Frequent lines, often twice in a document, between lines of its own; some
    rare lines shared by two or three; equal outlines in many documents."""
    rng = random.Random(seed)
    often = [f"notice {i} of more than eight words on every page" for i in range(3)] + ["short notice", "other short one of five"]
    shapes = [[rng.choice([*often, *often[:2], "", None, None]) for _ in range(rng.randrange(3, 9))] for _ in range(7)]
    rows = []
    for i in range(110):
        body = [f"own {i} {k}" if x is None else x for k, x in enumerate(rng.choice(shapes))]
        if rng.random() < 0.4:
            body.insert(rng.randrange(len(body) + 1), f"rare {rng.randrange(30)} line shared by few documents of all")
        rows.append((i, "\n".join([f"head {i}", *body, f"foot {i}"])))
    return rows


@pytest.mark.parametrize("seed, early", [(1, 1), (2, 2), (3, 3), (4, 2)])
def test_outlines_equal_the_alignment_of_all_pairs(spark, seed, early, monkeypatch):
    reached, plain = [], line_dedup._by_outlines
    monkeypatch.setattr(line_dedup, "_by_outlines", lambda *x: reached.append(1) or plain(*x))
    rows = boilerplate(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = all_pairs(rows)
    assert dict(line_dedup.dedup_lines(df, early=early).collect()) == want
    assert reached and any(want[i] != t for i, t in rows)


def test_a_line_twice_in_every_document_makes_few_pairs(spark, monkeypatch):
    line, n = "a notice of more than eight words on every page", 3000
    rows = [(i, f"x {i}\n{line}\ny {i}\n{line}\nz {i}") for i in range(n)]
    pairs, aligned, plain, blocks = [], [], line_dedup._cut_lines, line_dedup.map_batches

    def counted(p, *rest):
        pairs.append(p.count())
        return plain(p, *rest)

    def outlines(df, fn, schema):
        if "a_cls" in df.columns:
            aligned.append(df.count())
        return blocks(df, fn, schema)

    monkeypatch.setattr(line_dedup, "_cut_lines", counted)
    monkeypatch.setattr(line_dedup, "map_batches", outlines)
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == dict(rows)                # nothing aligns the two lines of a pair
    assert sum(pairs) <= (line_dedup.EARLY + 1) * n and aligned == [1]


def test_a_frequent_line_that_its_first_holder_has_twice(spark, monkeypatch):
    line, n = "a notice of more than eight words on every page", 1100
    rows = [(0, f"a\n{line}\nb\n{line}\nc")] + [(i, f"x {i}\n{line}\ny {i}") for i in range(1, n)]
    made, plain = [], line_dedup._cut_lines

    def counted(pairs, *rest):
        made.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(line_dedup, "_cut_lines", counted)
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got[0] == rows[0][1] and got[1] == rows[1][1]
    assert all(got[i] == f"x {i}\ny {i}" for i in range(2, n))
    assert sum(made) < 2 * n                # the first holder and the first that has it once


def test_long_blocks_of_many_documents(spark):
    rng = random.Random(8)
    passage = "\n".join(sentence(rng, 12, 5000) for _ in range(6))
    rows = [(i, sentence(rng, 30, 5000) + "\n" + passage + "\n" + sentence(rng, 30, 5000)) for i in range(30)]
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got[0] == rows[0][1]
    assert all(got[i] == rows[i][1].replace("\n" + passage, "") for i in range(1, 30))


def test_edges_of_a_hub_are_split(spark, monkeypatch):
    """A third of all edges at one node, broadcast off: the joins split them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.shuffle.partitions": "24", "spark.sql.files.maxPartitionBytes": "16k",
            "spark.sql.files.openCostInBytes": "1k"}     # a split needs several map tasks
    before = {k: spark.conf.get(k, None) for k in conf}
    plans, write = [], graph.materialize

    def seen(df, name):
        counted = df.groupBy().count()
        counted.collect()
        plans.append(counted._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(graph, "materialize", seen)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.range(300_000).selectExpr("if(id % 3 = 0, if(id % 2 = 0, 5, 500000), id + 100) as u", "id + 100001 as v")
        rows = np.array(edges.collect())
        node, root = graph.local_stars(rows[:, 0], rows[:, 1])
        got = graph.components(edges).where("node <> component")
        assert {tuple(r) for r in got.collect()} == set(zip(node.tolist(), root.tolist()))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("skew=true" in p for p in plans)


def test_empty_tables(empty):
    for df in (simhash.near_duplicates(empty), simhash.keep_representatives(empty),
               substring_dedup.repeated_spans(empty), line_dedup.dedup_lines(empty)):
        assert df.count() == 0
