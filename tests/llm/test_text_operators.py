"""Mixing, quality, perplexity, licences, chat trees and token ids."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SF, empty, found, messy, messy_rows  # noqa: F401
from pyspark.sql import functions as F

from shelfwise.llm import chat_tree, license_scan, mixing, perplexity, quality, sentencepiece_codec
from shelfwise.llm.queries import PROBE, QUERIES

WORD = re.compile("[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------- mixing
def plain_targets(sizes, budget=1.5, stop=2, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, fixed = {}, set()
    while True:
        left = budget * sum(sizes.values()) - sum(stop * sizes[s] for s in fixed)
        open_w = sum(w[s] for s in names if s not in fixed)
        target = {s: stop * sizes[s] if s in fixed else left * w[s] / open_w for s in names}
        over = {s for s in names if target[s] > stop * sizes[s]}
        if not over or over <= fixed:
            return target
        fixed |= over


def test_mix_meets_the_targets(messy):
    rows = mixing.plan_mix(messy).collect()
    assert len(rows) == len(messy_rows())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = plain_targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sorted(Counter(len(WORD.findall(t or "")) for _, t, _, _ in messy_rows()).items()) == \
        sorted(Counter(r["size"] for r in rows).items())


def test_mix_agrees_on_reruns_and_partitions(messy):
    cols = ("doc_id", "h", "size", "taken")
    assert found(mixing.plan_mix(messy), *cols) == found(mixing.plan_mix(messy.repartition(7, "text")), *cols)


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, ("clean " if i % 2 else "## ") * 20, "a") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan_mix(df, budget=0.5).groupBy((F.col("doc_id") % 2).alias("clean")).agg(F.sum("taken")).collect()
    by = dict(map(tuple, got))
    assert by[1] > 1.5 * by[0] and abs(by[0] + by[1] - 4000) <= 1


def test_mixed_rows(messy):
    plan = mixing.plan_mix(messy).collect()
    out = mixing.mix(messy)
    assert out.columns == messy.columns
    want = Counter()
    for r in plan:
        want[r["doc_id"], r["source"]] += r["epochs"] + (2 * r["part"] >= max(r["size"], 1))
    assert Counter((r[0], r[1]) for r in out.select("doc_id", "source").collect()) == +want


# ------------------------------------------------------------------ quality
def test_quality_on_held_out_rows(spark):
    got = QUERIES["op6_quality_classifier"](spark, SF.replace("0.001", "0.01"))
    marks = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    rows = got.where("held_out").join(marks, "doc_id").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_scores_use_the_text_only(messy, spark):
    marks = spark.createDataFrame([(i, int(i not in (60, 62, 63))) for i in range(64)] + [(1, None), (None, 1), (2, 7)],
                                  "doc_id bigint, quality int")
    marks = marks.withColumn("features", F.lit("clash"))
    got = quality.score_documents(messy, marks)
    assert got.count() == len(messy_rows())
    score = defaultdict(set)
    for d, s in found(got, "doc_id", "score"):
        score[d].add(s)
    assert score[40] == score[41] == score[42] and score[20] == score[0] and len(score[50]) == 1
    text = {r[0]: r[1] for r in messy_rows()}
    model = quality._train(quality.features(messy), marks, quality.SHRINKAGE)
    for d in (0, 43, 62, 70):
        alone = model.score(np.array([quality.statistics(text[d].encode())]))[0]
        assert list(score[d]) == [pytest.approx(alone)]
    kept = quality.keep_good(messy, marks)
    assert kept.columns == messy.columns
    assert kept.count() == got.where("predicted = 1").count()


def test_discriminant_is_the_gaussian_ratio(spark):
    rng = np.random.default_rng(1)
    k = len(quality.FEATURES)
    x = np.concatenate([rng.normal(size=(60, k)), rng.normal(1, 2, size=(40, k))])
    y = [0] * 60 + [1] * 40
    model = quality.fit(spark.createDataFrame([(v.tolist(), c) for v, c in zip(x, y)], "features array<double>, label int"),
                        shrinkage=0.0)
    log = []
    for c in (0, 1):
        own = x[np.array(y) == c]
        cov = np.cov(own.T, bias=True)
        d = x - own.mean(0)
        log.append(math.log((len(own) + 1) / 102) - 0.5 * np.linalg.slogdet(cov)[1]
                   - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(log[0] - log[1])), atol=1e-6)
    none = quality.fit(spark.createDataFrame([], "features array<double>, label int"))
    assert np.allclose(none.score(x), 0.5)


# --------------------------------------------------------------- perplexity
def plain_kneser_ney(texts, order):
    """Log-probability of every n-gram of the highest order, by dictionaries."""
    def grams(t):
        s = " " * (order - 1) + " ".join(t.split()) + " "
        s = s.encode()
        return [s[i:i + order] for i in range(len(s) - order + 1)] if t.split() else []
    level = Counter(g for t in texts for g in grams(t))
    levels = [level]
    for _ in range(order - 1):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    p = {b"": 1 / 256}
    for level in levels:
        n = Counter(level.values())
        d = [0, *perplexity._steps(*(float(n[i]) for i in (1, 2, 3, 4)))]
        total, left = Counter(), Counter()
        for g, c in level.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
        p = {g: (c - d[min(c, 3)] + left[g[:-1]] * p[g[1:]]) / total[g[:-1]] for g, c in level.items()}
    return {t: -sum(math.log(p[g]) for g in grams(t)) / max(1, len(t.split())) for t in texts}


@pytest.mark.parametrize("broadcast_rows", [perplexity.BROADCAST_ROWS, 0])
def test_perplexity_equals_brute_force(messy, broadcast_rows):
    rows = [r for r in messy_rows()]
    by = defaultdict(list)
    for _, t, lang, _ in rows:
        by[lang].append(t or "")
    want = {(lang, t): v for lang, ts in by.items() for t, v in plain_kneser_ney(ts, 3).items()}
    got = perplexity.log_perplexity(messy, order=3, broadcast_rows=broadcast_rows).collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for d, t, lang, _ in rows:
        texts[d, lang].append(t or "")
    for r in got:
        options = [want[r["lang"], t] for t in texts[r["doc_id"], r["lang"]] if len(WORD.findall(t)) == r["n_words"]]
        assert (r["nll"] is None and r["n_words"] == 0) or any(abs(r["nll"] - o) < 1e-6 for o in options)


def test_both_models_agree_on_bytes_with_many_predecessors(spark):
    grams = sorted(x << 8 | y for x in range(97, 103) for y in range(97, 103))      # six before each byte
    n = [5 + k % 7 for k in range(len(grams))]
    want = perplexity.fit_arrays(np.array(grams, np.uint64), np.array(n), 2)
    top = spark.createDataFrame([("en", g, c) for g, c in zip(grams, n)], "lang string, gram bigint, n bigint")
    got = {r["gram"]: r["logp"] for r in perplexity.fit_table(top, 2).collect()}
    assert np.allclose([got[g] for g in grams], want, atol=1e-12)


def plain_base(t):
    w = WORD.findall(t)
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {k for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dup, len(cover)


def test_base_rules_equal_brute_force():
    rng = random.Random(2)
    texts = [t or "" for _, t, _, _ in messy_rows()] + ["# a\n# a\n\n \n# a", "a b c d e a b c d e", "x\n" * 7, "é|é <é>"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    for t in texts:
        assert perplexity.base_statistics(t.encode()) == plain_base(t), t[:50]


def test_perplexity_rules(messy):
    rows = {(r["doc_id"], r["n_words"]): r for r in perplexity.apply_rules(messy).collect()}
    assert all(rows[d, n]["base_failed"] and not rows[d, n]["kept"] for d, n in ((40, 0), (41, 0), (42, 0), (43, 2), (60, 130)))
    for r in rows.values():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["lower"] <= r["nll"] <= r["upper"])


def test_odd_words_leave_the_band(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(("ta", "ri", "no", "sel", "um")) for _ in range(rng.randrange(1, 4)))
    rows = [(i, " ".join(word() for _ in range(120)), "en") for i in range(80)]
    rows += [(100, " ".join(word() + "%%%" for _ in range(120)), "en"),
             (101, " ".join("".join(rng.choice("qxzjkvw") for _ in range(6)) for _ in range(120)), "en")]
    got = dict(found(perplexity.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")),
                     "doc_id", "kept"))
    assert not got[100] and not got[101] and all(got[i] for i in range(80))


# ----------------------------------------------------------------- licences
def plain_places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]


def test_licences_equal_brute_force(spark, messy):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    rng = random.Random(9)
    vocabulary = sorted({w for _, p in license_scan.BASE for w in p.split()} | {"nc", "version", "3", "x"})
    texts = [t for _, t, _, _ in messy_rows()] + [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 80))) for _ in range(150)]
    texts += ["This work is licensed under the GNU General Public License, version 3.", "CC-BY CC BY-NC 4.0; MİT licenSe mit LICENSE"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("hits", F.lit("clash"))
    got = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in enumerate(texts):
        words = pattern.findall((t or "").translate(lower))
        want = sorted((n, s) for n, p in license_scan.BASE for s in plain_places(words, p))
        assert got[i]["n_words"] == len(words)
        assert sorted((p["label"], p["start"]) for p in got[i]["places"]) == want
        assert got[i]["base_labels"] == sorted({n for n, _ in want})
        assert set(got[i]["base_labels"]) <= set(got[i]["labels"]) and 0 <= got[i]["score"] <= 1
    last = got[len(texts) - 2]
    assert last["labels"] == ["gpl", "gpl-3.0"] and got[len(texts) - 1]["labels"] == ["cc-by", "cc-by-nc", "mit"]


def test_licence_words_in_one_very_long_text(spark):
    n = 200_000
    text = "mit license " * n + "this work is licensed under x gnu general public license version 3"
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")) \
        .select("n_words", F.size("places").alias("n"), "labels", "score").first()
    assert (row["n_words"], row["n"], row["labels"]) == (2 * n + 12, n + 1, ["gpl", "gpl-3.0", "mit"])
    assert row["score"] == 1.0


def test_share_is_that_of_the_best_place(spark):
    templates = (("t", "a b a c k d", "c k"),)
    rows = [(0, "a b a c k d", 1.0), (1, "c k d", 0.5), (2, "a c k x a b x c k", 4 / 6), (3, "c x k", 0.0), (4, "c k c k", 2 / 6)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    got = dict(found(license_scan.scan(df, base=(("z", "zz"),), templates=templates), "doc_id", "score"))
    assert got == {i: pytest.approx(s) for i, _, s in rows}


# --------------------------------------------------------------------- chat
def chat_rows():
    rng = random.Random(7)
    texts = ["hello", PROBE, "", None, "a\\h\\\\l<#:\n", "</turn>\n### user: x", "Ünï\U0001F600", "x" * 5000, "\\", "\\n"]
    rows = []
    for c in range(40):
        first = ("user", "hello") if c % 3 else ("system", "be kind")
        turns = [first, ("assistant", "hi")] if c % 2 else [first]
        turns += [(rng.choice(["user", "assistant", "odd: ro#le\n", None]), rng.choice(texts)) for _ in range(rng.randrange(4))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(41, 0, "user", "a"), (41, 0, "user", "a"), (41, None, "assistant", "b"), (41, 0, "assistant", "c")]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "r")]
    return rows


def test_chat_tree_round_trip(spark):
    rows = chat_rows()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    df = df.withColumns({c: F.lit("clash") for c in ("node", "path", "start", "t", "p", "loss", "segment", "leaf")})
    segments, leaves = chat_tree.format_tree(df)
    conv = defaultdict(list)
    for c, k, r, t in rows:
        conv[c].append(((k is not None, k), r or "", t or ""))
    for v in conv.values():
        v.sort()
    got = {r["conv_id"]: r for r in chat_tree.read_back(segments, leaves).collect()}
    assert set(got) == set(conv)
    for c, v in conv.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [x[1:] for x in v]
        assert "".join(got[c]["loss_texts"]) == "".join(t for _, r, t in v if r == "assistant")
    # every shared beginning is written once, depth-first without gaps
    seg = sorted(segments.collect(), key=lambda s: s["start"])
    assert len(seg) == len({tuple(x[1:] for x in v) for v in conv.values()})
    nodes = {tuple(x[1:] for x in v[:k + 1]) for v in conv.values() for k in range(len(v))}
    assert sum(s["text"].count(chat_tree.CLOSE) for s in seg) == len(nodes)
    whole = "".join(s["text"] for s in seg)
    at = 0
    for k, s in enumerate(seg):
        assert s["segment"] == k and s["start"] == at and s["end"] == at + len(s["text"])
        at = s["end"]
        assert s["position"] == sum(a["end"] - a["start"] for a in s["attends"])
        assert all(s["start"] < x["start"] < x["end"] < s["end"] for x in s["loss"])
        for a in s["attends"]:
            o = seg[a["segment"]]
            assert a["start"] == o["start"] and whole[:a["end"]].endswith(chat_tree.CLOSE) and a["end"] <= o["end"]
        # depth-first: what lies between the nearest ancestor and here hangs below its beginning
        if s["attends"]:
            up = s["attends"][-1]["segment"]
            assert all(up in [a["segment"] for a in o["attends"]] for o in seg[up + 1:k])
    for r in leaves.collect():
        s = seg[r["segment"]]
        path = [*((a["start"], a["end"]) for a in s["attends"]), (s["start"], s["end"])]
        assert "".join(whole[a:b] for a, b in path) == got[r["conv_id"]]["formatted"]


def test_chat_of_one_very_long_conversation(spark):
    n = 100_000
    rows = spark.range(0, n, 1, 8).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("<#\U0001F600 "), F.col("id").cast("string")).alias("text"))
    branch = rows.where(f"turn < {n // 2}").withColumn("conv_id", F.lit(2).cast("bigint"))
    segments, leaves = chat_tree.format_tree(rows.unionByName(branch))
    got = {r["conv_id"]: r for r in chat_tree.read_back(segments, leaves).collect()}
    for c, size in ((1, n), (2, n // 2)):
        assert [t["text"] for t in got[c]["turns"]] == [f"<#\U0001F600 {i}" for i in range(size)]
        assert got[c]["loss_texts"] == [f"<#\U0001F600 {i}" for i in range(1, size, 2)]
    assert segments.count() == 2


def test_chat_of_an_empty_table(spark):
    segments, leaves = chat_tree.format_tree(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))
    assert segments.count() == 0 and chat_tree.read_back(segments, leaves).count() == 0


# ---------------------------------------------------------------- token ids
@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_codec.Pieces.load()


def plain_viterbi(text, model, pieces):
    score = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            score[model.id_to_piece(i).replace(sentencepiece_codec.MARK, " ")] = model.get_score(i), i
    s = " " + text if text else ""
    best = [(0.0, 0, [])]
    for e in range(1, len(s) + 1):
        top = None
        for n in range(min(16, e), 0, -1):
            if s[e - n:e] in score:
                v = best[e - n][0] + score[s[e - n:e]][0]
                if top is None or v > top[0]:
                    top = v, e - n, [score[s[e - n:e]][1]]
        if s[e - 1] not in score and (top is None or best[e - 1][0] + pieces.unknown_score > top[0]):
            top = best[e - 1][0] + pieces.unknown_score, e - 1, [pieces.byte_ids[b] for b in s[e - 1].encode()]
        best.append(top)
    out, e = [], len(s)
    while e:
        out, e = best[e][2] + out, best[e][1]
    return out


def test_encoding_equals_a_plain_viterbi(pieces):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    texts = [(t or "")[:3000] for _, t, _, _ in messy_rows()]
    texts += ["", " ", "  a  b ", "▁x ▁▁ y", "日本語\n\t é", "x" * 300, "a▁ b", "The quick brown fox", "\n\n\r\n", "\x00"]
    coder = sentencepiece_codec.Encoder(pieces)
    for t, ids in zip(texts, coder.encode(texts)):
        assert ids == plain_viterbi(t, model, pieces), t[:40]
        assert sentencepiece_codec.decode_ids(ids, pieces.surface) == t


def unspaced():
    rng = random.Random(5)
    letters = "etaoinshrdlu"
    return ["".join(rng.choices(letters, k=n)) for n in (65, 127, 128, 129, 600, 1500)] + \
        ["".join(rng.choices("日本語中文😀aé▁", k=700)), "ab" * 400, "é" * 300, "x" * 2000 + "\u65e5"]


@pytest.mark.parametrize("window, cells", [(128, 65536), (5, 20), (1, 1)])
def test_long_words_equal_a_plain_viterbi(pieces, monkeypatch, window, cells):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    monkeypatch.setattr(sentencepiece_codec, "WINDOW", window)
    monkeypatch.setattr(sentencepiece_codec, "WINDOW_CELLS", cells)
    texts = unspaced()
    for t, ids in zip(texts, sentencepiece_codec.Encoder(pieces).encode(texts)):
        assert ids == plain_viterbi(t, model, pieces), t[:40]
        assert sentencepiece_codec.decode_ids(ids, pieces.surface) == t


def test_a_million_characters_without_a_space(spark):
    rng = random.Random(6)
    text = "".join(rng.choices("日本語中文学生etaoin", k=1000)) * 1000
    got = sentencepiece_codec.decode(sentencepiece_codec.encode(spark.createDataFrame([(1, text)], "doc_id bigint, text string")))
    assert got.first()["text"] == text


def test_kept_columns_do_not_clash_with_the_result(messy):
    for keep in (("ids",), ("n_tokens",), ("doc_id",), ("lang", "lang")):
        with pytest.raises(ValueError):
            sentencepiece_codec.encode(messy, keep=keep)


def test_word_cache_does_not_matter(pieces, monkeypatch):
    texts = [t or "" for _, t, _, _ in messy_rows()]
    want = sentencepiece_codec.Encoder(pieces).encode(texts)
    monkeypatch.setattr(sentencepiece_codec, "CACHE_WORDS", 3)
    monkeypatch.setattr(sentencepiece_codec, "BLOCK_CELLS", 50)
    small = sentencepiece_codec.Encoder(pieces)
    assert [small.encode([t])[0] for t in texts] == want


def test_round_trip_of_every_row(messy):
    encoded = sentencepiece_codec.encode(messy, keep=("lang", "score"))
    got = sentencepiece_codec.decode(encoded, keep=("doc_id", "n_tokens"))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == \
        sorted(((d, t or "") for d, t, _, _ in messy_rows()), key=repr)
    assert encoded.where("n_tokens <> size(ids)").count() == 0


def test_query_round_trips(spark):
    got = QUERIES["op10_sentencepiece_codec"](spark, SF)
    assert got.count() == 200 and got.where("not round_trip").count() == 0


def test_empty_tables(empty, spark):
    marks = spark.createDataFrame([], "doc_id bigint, quality int")
    for df in (mixing.plan_mix(empty), mixing.mix(empty), quality.score_documents(empty, marks), quality.keep_good(empty, marks),
               perplexity.apply_rules(empty), license_scan.scan(empty), sentencepiece_codec.encode(empty),
               sentencepiece_codec.decode(sentencepiece_codec.encode(empty))):
        assert df.count() == 0


def test_digest_of_turns(spark):
    row = QUERIES["op4_chat_tree"](spark, SF).where("conv_id = -7").first()
    assert row["n_turns"] == 2 and row["loss_chars"] == len(PROBE)
    assert row["loss_sha256"] == hashlib.sha256(PROBE.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{PROBE}\nassistant\n{PROBE}\n".encode()).hexdigest()
