"""Substring dedup: long word sequences that an earlier document has.

A window is ``window`` consecutive words. Every word covered by a window that
also starts in a document with a smaller id is marked for removal, as spans.

Method (recompression, Jez, "Recompression: a simple and powerful technique
for word equations", 2016):

1. Rounds over the word sequence give names to maximal runs of equal symbols
   and to pairs of a left and a right symbol (a symbol's side is a bit of its
   name). A name is a hash of what it stands for, so equal runs and pairs get
   the same name in every document and a round needs no dictionary join.
   Beside each symbol stands the range of words its naming depended on. Inside
   equal substrings the symbols whose range lies inside are the same.
2. Each window has an anchor: among the last round's symbols that its own
   words determine, one of the longest (the one with the smallest hash); long
   symbols are seldom shared by chance), with all words that its name
   depended on. Equal windows have equal anchors.
   (Windows inside periodic text may determine none; their own hash is the
   anchor.) Spark groups the anchors of all documents; a repeat can only be
   where an anchor occurs in two of them.
3. In the documents with shared anchors the windows at those anchors are
   verified: a 128-bit hash of all words, grouped by Spark, gives the first
   document of each window.

Equal texts are one document for all this; later copies go whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, texts_of

WINDOW = 50
ROUNDS = 6
LONGEST = 12            # words of a symbol that still grows
CHUNK_WORDS = 200_000   # words parsed at once (one longer text alone)
_U = np.uint64


def _tag(*x: int) -> np.uint64:
    return _U(xxhash.xxh64_intdigest(repr(x)))


# ------------------------------------------------------------ recompression
def recompress(words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS, longest: int = LONGEST):
    """Name runs and pairs for some rounds. ``words`` are word hashes of
    texts one after another, ``first`` marks the first word of each. Returns
    (name, start, end, lo, hi) of the symbols: they stand for words
    [start, end) and their names depend on words [lo, hi) only. A range that
    reaches over the end of its text is never inside a window."""
    n = len(words)
    name, head = words.copy(), first.copy()
    st = np.arange(n)
    en, lo, hi = st + 1, st.copy(), st + 1
    for r in range(rounds):
        # runs
        same = (name[1:] == name[:-1]) & ~head[1:]
        if same.any():
            at = np.nonzero(np.concatenate([[True], ~same]))[0]
            k = np.diff(np.append(at, len(name)))
            end = at + k - 1
            run = mix64(name[at] + k.astype(_U) * _tag(r, "run"))
            name = np.where(k > 1, run, name[at])
            head, st, lo, en, hi = head[at], st[at], lo[at], en[end], hi[end]
        tail = np.append(head[1:], True)
        # a run must be known to end: its neighbour differs, mostly in the nearest word
        left, right = np.append(lo[:1], lo[:-1]), np.append(hi[1:], hi[-1:])
        near = words[np.maximum(st - 1, 0)] != words[en - 1]
        new_lo = np.where(head | near, np.minimum(lo, st - 1), left)
        near = words[np.minimum(en, n - 1)] != words[st]
        hi = np.where(tail | near, np.maximum(hi, en + 1), right)
        lo = new_lo
        # pairs
        side = (mix64(name + _tag(r, "side")) & _U(1)).astype(np.int8)
        side[en - st > longest] = 2
        pair = np.append((side[:-1] == 0) & (side[1:] == 1) & ~head[1:], False)
        second = np.append(False, pair[:-1])
        left, right = np.append(lo[:1], lo[:-1]), np.append(hi[1:], hi[-1:])
        new_lo = np.where((side == 1) & ~second, np.where(head, st - 1, left), lo)
        new_hi = np.where((side == 0) & ~pair, np.where(tail, en + 1, right), hi)
        both = mix64(mix64(name[:-1] + _tag(r, "left")) + name[1:]) if len(name) > 1 else name[:0]
        name = np.where(pair, np.append(both, _U(0)), name)
        en = np.where(pair, np.append(en[1:], 0), en)
        new_hi = np.where(pair, np.append(np.maximum(hi[:-1], hi[1:]), 0), new_hi)
        keep = ~second
        name, head, st, en, lo, hi = name[keep], head[keep], st[keep], en[keep], new_lo[keep], new_hi[keep]
    return name, st, en, lo, hi


def window_hashes(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every ``window`` consecutive words,
    by doubling."""
    out = []
    for seed in (1, 2):
        part, have, at, got = mix64(words + _tag(seed)), 1, 0, None
        while True:
            if window & have:
                tail = part[at:]
                got = tail if got is None else mix64(got[: len(tail)] * _tag(seed, "join") + tail[: len(got)])
                got = got[: len(words) - at - have + 1]
                at += have
            if at == window:
                break
            part = mix64(part[:-have] * _tag(seed, have) + part[have:])
            have *= 2
        out.append(got)
    return out[0], out[1]


def _range_hashes(words: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hashes of words[lo:hi], from sums with falling powers."""
    base = int(_tag("base")) | 1
    falling = np.full(len(words), pow(base, -1, 1 << 64), _U)
    rising = np.full(len(words) + 1, base, _U)
    falling[:1], rising[0] = 1, 1
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix64(words) * np.cumprod(falling))])
    return mix64((sums[hi] - sums[lo]) * np.cumprod(rising)[lo])


def anchors(words: np.ndarray, first: np.ndarray, window: int, rounds: int = ROUNDS):
    """For every window: (start, anchor, hash, second hash)."""
    n = len(words)
    starts = np.nonzero(first)[0]
    ends = np.append(starts[1:], n)
    text_end = np.repeat(ends, ends - starts)
    i = np.nonzero(np.arange(n) + window <= text_end)[0]
    if not len(i):
        none = np.empty(0, _U)
        return i, none, none, none
    d1, d2 = window_hashes(words, window)
    name, st, en, lo, hi = recompress(words, first, rounds)
    a = np.searchsorted(lo, i, "left")
    b = np.searchsorted(hi, i + window, "right")
    out = mix64(d1[i] + _tag("window"))
    inside = b > a
    # Every window with this symbol as anchor holds the words that its name
    # depends on, so these go into the anchor: fewer are shared by chance.
    name = mix64(name + _range_hashes(words, np.maximum(lo, 0), np.minimum(hi, n)))
    # least of the symbols a..b-1, by length downwards and hash: two overlapping powers of two
    length = np.minimum(en - st, 255).astype(_U)
    level, size = ((_U(255) - length) << _U(56)) | (name >> _U(8)), b - a
    width = 1
    while inside.any():
        own = inside & (size >= width) & (size < 2 * width)
        if own.any():
            out[own] = np.minimum(level[a[own]], level[b[own] - width])
        if not (size >= 2 * width).any():
            break
        level = np.minimum(level[: len(level) - width], level[width:])
        width *= 2
    return i, out, d1[i], d2[i]


# ----------------------------------------------------------------- batches
def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(_U)


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[int], list[list[bytes]], np.ndarray, np.ndarray]]:
    """(rows, words of each, all word hashes, first marks); texts without
    words are left out."""
    rows, cut, total = [], [], 0
    for k, t in enumerate(texts):
        w = t.split()
        if rows and total + len(w) > CHUNK_WORDS:
            yield rows, cut, *_joined(cut)
            rows, cut, total = [], [], 0
        if w:
            rows.append(k)
            cut.append(w)
            total += len(w)
    if rows:
        yield rows, cut, *_joined(cut)


def _joined(cut: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in cut])
    first = np.zeros(size.sum(), bool)
    first[np.cumsum(size) - size] = True
    return np.concatenate([_word_hashes(w) for w in cut]), first


def _owner(first: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Number of the text of each position."""
    return (np.cumsum(first) - 1)[i]


def _lists(owner: np.ndarray, value: np.ndarray, n: int, kind) -> pa.Array:
    """One list for each of n texts; owner is sorted."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(value, kind))


def _order(id: Column, text: Column) -> Column:
    """Ids as they are; null ids after all others, by text hash. (Ids have
    to be below 2**62.)"""
    late = F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62)
    return F.coalesce(id.cast("bigint"), late)


def _parse(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b.column(2))
            n, sha = [0] * len(texts), [hashlib.sha256(b"").hexdigest()] * len(texts)
            names: list = [[]] * len(texts)
            for rows, cut, words, first in _chunks(texts):
                i, a, _, _ = anchors(words, first, window, rounds)
                owner = _owner(first, i)
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (owner[1:] != owner[:-1])
                a, owner = a[new].view(np.int64), owner[new]
                at = np.searchsorted(owner, np.arange(len(rows) + 1))
                for k, (row, w) in enumerate(zip(rows, cut)):
                    n[row], sha[row] = len(w), hashlib.sha256(b" ".join(w)).hexdigest()
                    names[row] = a[at[k]:at[k + 1]]
            flat = np.concatenate([np.asarray(x, np.int64) for x in names]) if names else np.empty(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in names])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sha), pa.ListArray.from_arrays(offsets, flat)],
                names=["doc_id", "o", "n_words", "sha", "names"])
    return run


def _verify(window: int, rounds: int):
    """Windows of a text at its shared anchors, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, o = texts_of(b.column(1)), b.column(0).to_numpy(zero_copy_only=False)
            shared = b.column(2)
            for rows, _, words, first in _chunks(texts):
                i, a, d1, d2 = anchors(words, first, window, rounds)
                owner = _owner(first, i)
                at = np.searchsorted(owner, np.arange(len(rows) + 1))
                for k, row in enumerate(rows):
                    s = slice(at[k], at[k + 1])
                    hit = np.isin(a[s].view(np.int64), np.array(shared[row].as_py(), np.int64))
                    x, where = np.unique(d1[s][hit], return_index=True)
                    if len(x):
                        yield pa.RecordBatch.from_pydict({"d1": x.view(np.int64), "d2": d2[s][hit][where].view(np.int64),
                                                          "o": np.full(len(x), o[row])})
    return run


def _cut(window: int):
    """Spans of the covered words, and the digest of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict = {"o": [], "sha": [], "spans": [], "kept_sha256": []}
            for o, t, repeated in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2)):
                words = t.split()
                if len(words) < window:
                    continue
                d1, _ = window_hashes(_word_hashes(words), window)
                at = np.nonzero(np.isin(d1.view(np.int64), np.array(repeated.as_py(), np.int64)))[0]
                cover = np.zeros(len(words) + 1, np.int64)
                cover[at] += 1
                cover[at + window] -= 1
                gone = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
                edge = np.nonzero(gone[1:] != gone[:-1])[0]
                out["o"].append(o)
                out["sha"].append(hashlib.sha256(b" ".join(words)).hexdigest())
                out["spans"].append([{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())])
                out["kept_sha256"].append(hashlib.sha256(
                    b" ".join([w for w, g in zip(words, gone[1:].tolist()) if not g])).hexdigest())
            if out["o"]:
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(out["o"], pa.int64()), pa.array(out["sha"]),
                                                  pa.array(out["spans"], span), pa.array(out["kept_sha256"])],
                                                 names=list(out))
    return run


# -------------------------------------------------------------------- Spark
def repeated_spans(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, text: str = "text",
                   id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, spans, kept_sha256)`` for every row of ``docs``.

    spans are the [start, end) word ranges covered by a window whose words
    also start in a document with a smaller id, judged on the input;
    kept_sha256 is the digest of the other words, joined by single spaces.
    Null and empty texts have no words and the digest of nothing. Rows that
    repeat an id are judged each by itself (its own id is not smaller). Null
    ids come after all others, in the order of their texts' hashes. An empty
    table gives no rows; other columns are ignored.
    """
    t = F.col(f"`{text}`")
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(f"`{id}`").alias("doc_id"), _order(F.col(f"`{id}`"), t).alias("o"), t.alias("text"))
    parsed = materialize(rows.mapInArrow(
        _parse(window, rounds), f"doc_id {kind}, o bigint, n_words bigint, sha string, names array<bigint>"), "parsed")
    firsts = materialize(parsed.groupBy(F.col("sha").alias("f_sha")).agg(F.min("o").alias("first")), "firsts")
    named = parsed.select("o", F.explode("names").alias("name"))
    shared = materialize(named.groupBy(F.col("name").alias("s_name")).agg(F.min("o").alias("a"), F.max("o").alias("b"))
                         .where("a < b").select("s_name"), "shared")
    lists = named.join(shared, F.col("name") == F.col("s_name")).groupBy(F.col("o").alias("l_o")) \
        .agg(F.collect_set("name").alias("names"))     # at most the anchors of one text
    lists = materialize(lists.join(firsts, F.col("l_o") == F.col("first"), "left_semi"), "lists")
    found = materialize(rows.select("o", "text").join(lists, F.col("o") == F.col("l_o")).select("o", "text", "names"),
                        "found")
    windows = materialize(found.mapInArrow(_verify(window, rounds), "d1 bigint, d2 bigint, o bigint"), "windows")
    earliest = materialize(windows.groupBy(F.col("d1").alias("e1"), F.col("d2").alias("e2"))
                           .agg(F.min("o").alias("first"), F.max("o").alias("last")).where("first < last")
                           .select("e1", "e2", "first"), "earliest")
    repeats = windows.join(earliest, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))) \
        .where(F.col("o") > F.col("first")).groupBy(F.col("o").alias("r_o")).agg(F.collect_set("d1").alias("repeated"))
    cut = found.select("o", "text").join(repeats, F.col("o") == F.col("r_o")).select("o", "text", "repeated") \
        .mapInArrow(_cut(window), "o bigint, sha string, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")
    cut = materialize(cut.dropDuplicates(["o", "sha"])
                      .select(F.col("o").alias("c_o"), F.col("sha").alias("c_sha"), "spans", "kept_sha256"), "cut")
    copy = (F.col("o") > F.col("first")) & (F.col("n_words") >= window)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    return parsed.drop("names").join(firsts, F.col("sha") == F.col("f_sha")) \
        .join(cut, (F.col("o") == F.col("c_o")) & (F.col("sha") == F.col("c_sha")), "left") \
        .select("doc_id", "n_words", F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
                F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
