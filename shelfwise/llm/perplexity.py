"""Quality rules with an n-gram language model: perplexity bands.

A modified Kneser-Ney model over the bytes of the words, one for each
language, is counted by Spark over every document (Chen and Goodman, "An
empirical study of smoothing techniques for language modeling", 1998): raw
counts for the highest order, numbers of distinct left extensions for the
lower ones, three discounts for each order from the counts of counts. Every
n-gram that occurs gets one log-probability.

The model is read in sorted hash arrays, n-grams packed into 64-bit keys
beside their log-probabilities, sent to the tasks while it has at most
``BROADCAST_ROWS`` n-grams. A larger model stays a table, made by joins on
contexts and suffixes, and the n-grams of the documents join it. Both ways
give the same perplexities.

The perplexity is the usual one of a word: the log-probability of all bytes
of a text divided by its number of words. (Of a byte it would say less: a
word with ``###`` behind it costs more, but its bytes not.) A document is
rejected when its log-perplexity lies outside the band of its language: the
median of all documents, plus or minus a share of it and a multiple of the
sampling error of a text of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix64, texts_of

ORDER = 5
BROADCAST_ROWS = 4_000_000      # 64 MB of keys and log-probabilities
CHUNK = 1 << 20                 # bytes of text packed into n-grams at once
MERGE = 2_000_000               # counts that a task holds before it adds them up
SYMBOLS = b"#*$%&|<>"
WIDTH, ERRORS = 0.08, 5.0       # half a band: a share of its centre, and sampling errors
GRID = 1000                     # steps of log-perplexity for exact medians from counts

_U = np.uint64
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


# ----------------------------------------------------------------- base rules
def base_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    symbols = int(_IS_SYMBOL[raw].sum())
    if not n:
        return 0, 0, symbols, 0, 0
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((joined & 0xC0) != 0x80).sum())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if n >= 10 or len(set(words)) < n:
        h = np.fromiter(map(hash, words), np.int64, n).view(_U)
        if n >= 5:
            w = mix64(h)
            key = w[: n - 4].copy()
            for k in range(1, 5):
                key = mix64(key * _U(3) + w[k: n - 4 + k])
            order = np.argsort(key, kind="stable")
            same = key[order[1:]] == key[order[:-1]]
            twice = np.zeros(len(key), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            cover = np.zeros(n + 1, np.int64)
            at = np.nonzero(twice)[0]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + 5, -1)
            repeat = int((np.cumsum(cover[:n]) > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeat


# ---------------------------------------------------------------- n-gram keys
def _stream(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the texts one after another, and how many each has:
    one for every byte of its words joined by single spaces, and the end.
    A text starts after order - 1 spaces."""
    pad = b" " * (order - 1)
    parts = [b" ".join(t.split()) for t in texts]
    parts = [pad + p + b" " if p else b"" for p in parts]
    length = np.array([len(p) for p in parts], np.int64)
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(_U)
    if not len(raw):
        return raw, length
    key = np.zeros(len(raw) - order + 1, _U)
    for k in range(order):
        key = (key << _U(8)) | raw[k: len(key) + k]
    count = np.maximum(length - (order - 1), 0)
    start = np.cumsum(length) - length
    keep = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return key[keep], count


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` bytes; one longer text alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _languages(column: pa.Array) -> dict:
    """Rows of each language (None is one)."""
    rows: dict = {}
    for i, x in enumerate(column.to_pylist()):
        rows.setdefault(x, []).append(i)
    return rows


def count_ngrams(docs: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` over all documents. A task adds up its own counts
    first and writes them out whenever they pass a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def merge() -> int:
            for x, parts in held.items():
                grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                held[x] = [(grams, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64))]
            return sum(len(parts[0][1]) for parts in held.values())

        def out():
            merge()
            for x, ((grams, n),) in held.items():
                yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(n), pa.string()),
                                                  "gram": grams.view(np.int64), "n": n})
            held.clear()

        size = 0
        for b in batches:
            texts = texts_of(b.column(1))
            for x, rows in _languages(b.column(0)).items():
                own = [texts[i] for i in rows]
                for i, j in _chunks(own):
                    grams, n = np.unique(_stream(own[i:j], order)[0], return_counts=True)
                    if len(grams):
                        held.setdefault(x, []).append((grams, n))
                        size += len(grams)
                    if size > MERGE:
                        size = merge()
                        if size > MERGE // 2:
                            yield from out()
                            size = 0
        yield from out()

    counts = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")) \
        .mapInArrow(run, "lang string, gram bigint, n bigint")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ the model
def _steps(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Discounts of the counts 1, 2 and 3 or more, from the counts of
    counts; kept inside (0, count) where these are too few."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = ((1 - 2 * y * n2 / n1 if n1 else 0.5, 0.95), (2 - 3 * y * n3 / n2 if n2 else 1.0, 1.9),
           (3 - 4 * y * n4 / n3 if n3 else 1.5, 2.85))
    return tuple(min(max(v, 0.05), cap) for v, cap in raw)


def fit_arrays(grams: np.ndarray, n: np.ndarray, order: int) -> np.ndarray:
    """Log-probabilities of the n-grams of one language, sorted by key:
    interpolated modified Kneser-Ney."""
    levels = [(grams, n)]
    for k in range(order - 1, 0, -1):       # distinct left extensions
        levels.insert(0, np.unique(levels[0][0] & _U((1 << 8 * k) - 1), return_counts=True))
    lower = None
    for k, (keys, count) in enumerate(levels, start=1):
        steps = _steps(*np.bincount(count[count <= 4], minlength=5)[1:5].astype(float))
        d = np.array([0.0, *steps])[np.minimum(count, 3)]
        at = np.concatenate([[0], np.nonzero(np.diff(keys >> _U(8)))[0] + 1])
        size = np.diff(np.append(at, len(keys)))
        total = np.repeat(np.add.reduceat(count, at).astype(float), size)
        back = np.repeat(np.add.reduceat(d, at), size) / total
        below = 1 / 256 if lower is None else lower[1][np.searchsorted(lower[0], keys & _U((1 << 8 * (k - 1)) - 1))]
        lower = keys, (count - d) / total + back * below
    return np.log(lower[1])


def _discounts(counts: DataFrame) -> Column:
    """The discount of a count, by language, from the counts of counts."""
    rows = counts.where("n <= 4").groupBy("lang").pivot("n", [1, 2, 3, 4]).count().na.fill(0).collect()

    def by_count(*c: int) -> Column:
        steps = _steps(*(float(x) for x in c))
        return F.when(F.col("n") == 1, steps[0]).when(F.col("n") == 2, steps[1]).otherwise(steps[2])

    out = by_count(0, 0, 0, 0)      # a language without such counts has no row
    for lang, *c in rows:       # one row for each language
        out = F.when(F.col("lang").eqNullSafe(F.lit(lang)), by_count(*c)).otherwise(out)
    return out


def fit_table(top: DataFrame, order: int) -> DataFrame:
    """``fit_arrays`` as Spark joins, for models of any size: ``top(lang,
    gram, n)`` -> ``(lang, gram, logp)``."""
    levels = [top]
    for k in range(order - 1, 0, -1):       # distinct left extensions
        shorter = F.col("gram").bitwiseAND((1 << 8 * k) - 1)
        levels.insert(0, materialize(levels[0].groupBy("lang", shorter.alias("gram"))
                                     .agg(F.count(F.lit(1)).alias("n")), "ngrams"))
    model = None
    for k, level in enumerate(levels, start=1):
        level = level.withColumn("d", _discounts(level))
        context = level.groupBy(F.col("lang").alias("c_lang"), F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").cast("double").alias("total"), F.sum("d").alias("left"))
        c = level.join(context, F.col("lang").eqNullSafe(F.col("c_lang"))
                       & (F.shiftright("gram", 8) == F.col("context"))) \
            .select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"),
                    (F.col("left") / F.col("total")).alias("back"))
        if model is None:
            p = c.select("lang", "gram", (F.col("own") + F.col("back") / 256).alias("p"))
        else:
            low = model.select(F.col("lang").alias("l_lang"), F.col("gram").alias("l_gram"), F.col("p").alias("l_p"))
            p = c.join(low, F.col("lang").eqNullSafe(F.col("l_lang"))
                       & (F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1) == F.col("l_gram"))) \
                .select("lang", "gram", (F.col("own") + F.col("back") * F.col("l_p")).alias("p"))
        model = materialize(p, "model")
    return model.select("lang", "gram", F.log("p").alias("logp"))


# -------------------------------------------------------------------- scoring
_BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _statistics(docs: DataFrame, arrays: dict | None, order: int, text: str, lang: str, id: str) -> DataFrame:
    """Base statistics of every row and n_grams; with ``arrays`` also logp,
    the sum of the log-probabilities."""
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            texts = texts_of(b.column(3))
            base = np.array([base_statistics(t) for t in texts], np.int64)
            n = np.array([len(b" ".join(t.split())) + 1 if m else 0 for t, m in zip(texts, base[:, 0])], np.int64)
            logp_of = np.zeros(len(texts))
            for x, rows in _languages(b.column(2)).items() if arrays is not None else ():
                if x not in arrays:
                    continue
                keys, logp = arrays[x]
                for i, j in _chunks([texts[r] for r in rows]):
                    grams, count = _stream([texts[r] for r in rows[i:j]], order)
                    p = np.concatenate([[0.0], logp[np.minimum(np.searchsorted(keys, grams), len(keys) - 1)]])
                    ends, upto = np.cumsum(count), np.cumsum(p)
                    logp_of[rows[i:j]] = upto[ends] - upto[ends - count]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": b.column(0), "h": b.column(1), "lang": b.column(2)}
                | {c.split()[0]: base[:, i] for i, c in enumerate(_BASE.split(", "))}
                | {"n_grams": n, "logp": logp_of})

    return docs.select(F.col(f"`{id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("h"),
                       F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, h bigint, lang string, {_BASE}, n_grams bigint, logp double")


def _by_join(docs: DataFrame, model: DataFrame, order: int, text: str, lang: str) -> DataFrame:
    """``(t_lang, t_h, mean)`` by language and text: the mean log-probability
    of its n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
                grams, n = np.unique(_stream([t], order)[0], return_counts=True)
                if len(grams):
                    yield pa.RecordBatch.from_pydict({"t_lang": pa.array([lang] * len(n), pa.string()),
                                                      "t_h": np.full(len(n), h), "t_gram": grams.view(np.int64),
                                                      "t_n": n.astype(np.int64)})

    texts = docs.select(F.col(f"`{lang}`").alias("lang"), F.xxhash64(f"`{text}`").alias("h"),
                        F.col(f"`{text}`").alias("text"))
    rows = texts.mapInArrow(run, "t_lang string, t_h bigint, t_gram bigint, t_n bigint")
    return rows.join(model, F.col("t_lang").eqNullSafe(F.col("lang")) & (F.col("t_gram") == F.col("gram"))) \
        .groupBy("t_lang", "t_h").agg((F.sum(F.col("t_n") * F.col("logp")) / F.sum("t_n")).alias("mean"))


def log_perplexity(docs: DataFrame, order: int = ORDER, broadcast_rows: int = BROADCAST_ROWS, text: str = "text",
                   lang: str = "lang", id: str = "doc_id") -> DataFrame:
    """Base statistics of every row and ``nll``, the negative log-probability
    of its text under the model of all of ``docs`` for each word; null for a
    text without words."""
    counts = materialize(count_ngrams(docs, order, text, lang), "ngrams")
    if counts.count() <= broadcast_rows:
        arrays = {}
        got = counts.toArrow()
        for x in got.column("lang").unique().to_pylist():
            own = got.filter(pa.compute.equal(got["lang"], x) if x is not None else pa.compute.is_null(got["lang"]))
            keys, n = own["gram"].to_numpy().view(_U), own["n"].to_numpy()
            by = np.argsort(keys)
            arrays[x] = keys[by], fit_arrays(keys[by], n[by], order)
        del got
        shared = docs.sparkSession.sparkContext.broadcast(arrays)
        out = _statistics(docs, _Shared(shared), order, text, lang, id)
    else:
        base = materialize(_statistics(docs, None, order, text, lang, id).drop("logp"), "base")
        out = base.join(_by_join(docs, fit_table(counts, order), order, text, lang),
                        F.col("lang").eqNullSafe(F.col("t_lang")) & (F.col("h") == F.col("t_h")), "left") \
            .withColumn("logp", F.col("mean") * F.col("n_grams")).drop("t_lang", "t_h", "mean")
    return out.withColumn("nll", F.when(F.col("n_words") > 0, -F.col("logp") / F.col("n_words"))).drop("logp")


class _Shared:
    """A broadcast dictionary, read on first use inside a task."""

    def __init__(self, shared):
        self.shared = shared

    def __contains__(self, x):
        return x in self.shared.value

    def __getitem__(self, x):
        return self.shared.value[x]


def _median(rows: DataFrame, value: Column, grid: int = GRID) -> DataFrame:
    """``(m_lang, median)`` of a value in [0, inf) by language, exact to one
    step of the grid: counts by step, then a running sum over the steps."""
    steps = rows.groupBy("lang", F.floor(value * grid).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("lang")
    upto = F.sum("n").over(by.orderBy("step"))
    return steps.select("lang", "step", upto.alias("upto"), F.sum("n").over(by).alias("all")) \
        .where(F.col("upto") * 2 >= F.col("all")).groupBy("lang").agg((F.min("step") / grid).alias("median")) \
        .select(F.col("lang").alias("m_lang"), "median")


def bands(scored: DataFrame) -> DataFrame:
    """``(b_lang, centre, sd)`` of every language, from all documents that
    pass the base rules: the median of nll, and the standard deviation of one
    word as 1.4826 times the median of ``|nll - centre| * sqrt(n_words)``."""
    ok = scored.where(~F.col("base_failed") & F.col("nll").isNotNull()).select("lang", "nll", "n_words")
    # written, so that the joins see its size: a row for each language
    centre = materialize(_median(ok, F.col("nll")), "centre")
    far = ok.join(centre, F.col("lang").eqNullSafe(F.col("m_lang")))
    far = far.select("lang", (F.abs(F.col("nll") - F.col("median")) * F.sqrt("n_words")).alias("far"))
    sd = _median(far, F.col("far"), GRID // 10).select(F.col("m_lang").alias("s_lang"), (F.col("median") * 1.4826).alias("sd"))
    return centre.join(sd, F.col("m_lang").eqNullSafe(F.col("s_lang"))) \
        .select(F.col("m_lang").alias("b_lang"), F.col("median").alias("centre"), "sd")


def apply_rules(docs: DataFrame, order: int = ORDER, width: float = WIDTH, errors: float = ERRORS,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Base statistics and verdict of every row of ``docs``.

    Returns ``(doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, nll, lower, upper, kept)``. base_failed:
    under 10 words, or over 20 % of the words in repeated 5-word windows.
    kept: not base_failed and nll (log-perplexity of a word) within the
    band of the row's language. Null and empty texts have no
    words and fail; a null language is a language of its own; where no
    document of a language passes the base rules there is no band and none
    is needed. Repeated rows get equal verdicts and count each in the model.
    An empty table gives no rows; other columns are ignored.
    """
    scored = log_perplexity(docs, order, broadcast_rows)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = materialize(scored.withColumn("base_failed", failed), "scored")
    band = materialize(bands(scored), "bands")
    out = scored.join(band, F.col("lang").eqNullSafe(F.col("b_lang")), "left")
    half = width * F.col("centre") + errors * F.col("sd") / F.sqrt(F.greatest("n_words", F.lit(1)))
    out = out.withColumn("lower", F.col("centre") - half).withColumn("upper", F.col("centre") + half)
    return out.select("doc_id", "lang", *[c.split()[0] for c in _BASE.split(", ")], "base_failed", "nll", "lower", "upper",
                      F.coalesce(~F.col("base_failed") & F.col("nll").between(F.col("lower"), F.col("upper")),
                                 F.lit(False)).alias("kept"))
