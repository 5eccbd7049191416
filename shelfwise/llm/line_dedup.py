"""Line dedup by pairwise alignment of overlapping documents.

Documents are aligned with patience diff, and the aligned common blocks of
enough words are deleted from the later document (documents are ordered by
doc_id). The result is that of aligning each document with every earlier one,
but only pairs that can still change it are aligned. They are found through
runs: the shortest run of lines that reaches ``min_words`` forwards and
backwards from each line. Every line of a block lies in a run inside the
block, so both documents hold that run.

1. A document is aligned with the first holder of each of its runs and the
   first one that holds the run exactly once, however frequent the run is.
2. Runs that still have a line not deleted: with the first ``EARLY`` holders.
3. Runs that still have one, so runs of more holders: of the documents that
   hold such runs, those that share a rare line (at most ``EARLY`` of them have
   it) are aligned as they are. All others can share frequent lines only, so
   their alignment is that of their outlines: the frequent and blank lines, with
   everything between them as one gap. Each pair of different outlines is
   aligned once, whatever number of documents has them.

Steps 1 and 2 and the rare lines give pairs by the number of lines, not by the
square of a group. A line that stands twice in each of many documents, where
nothing aligns it, costs one alignment for each pair of different outlines
that hold it. Later exact copies of a text need no alignment: the whole text is
one common block. Texts are told apart by 128 bits.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, pack_rows, texts_of, unpack_rows

MIN_WORDS = 8       # words of the smallest block that is deleted
EARLY = 16          # holders of a run that are tried before all


# ------------------------------------------------------------ patience diff
def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first number, whose second
    numbers rise (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        at = bisect_left(tops, y)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(y)
            piles.append(k)
        else:
            tops[at], piles[at] = y, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: pairs (i, j) with ``a[i] == b[j]``, both rising. Equal
    ends of a range are matched first, then the lines that are unique in both
    sides, and so on between them."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        at_b = {x: k for k, x in enumerate(b[j:j_end], j) if in_b[x] == 1}
        unique = [(k, at_b[x]) for k, x in enumerate(a[i:i_end], i) if in_a[x] == 1 and x in at_b]
        anchors = _longest_rising(unique)
        for x, y in anchors:
            todo.append((i, x, j, y))
            out.append((x, y))
            i, j = x + 1, y + 1
        if anchors:
            todo.append((i, i_end, j, j_end))
    return sorted(out)


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[int]:
    """Lines of ``b`` inside aligned blocks of at least ``min_words`` words.
    A block is a run of lines that follow each other on both sides."""
    out: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*align(a, b), (-1, -1)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= min_words:
                out += block
            block = []
        block.append(j)
        last = i, j
    return out


# -------------------------------------------------------------------- Spark
def text_lines(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(key, h, lines, words)`` of every row: hashes of the lines between
    line feeds (0 for one without a word) and their numbers of words."""
    t = F.col(f"`{text}`")
    rows = docs.select(_key(F.col(f"`{id}`"), t).alias("key"), t.alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        lines, words = [], []
        for t in texts_of(b.column(1)):
            own = t.split(b"\n")
            n = [len(x.split()) for x in own]
            words.append(n)
            lines.append([(xxhash.xxh64_intdigest(x) | 1) - (1 << 63) if k else 0 for x, k in zip(own, n)])
        return {"key": b.column(0), "lines": pa.array(lines, pa.list_(pa.int64())),
                "words": pa.array(words, pa.list_(pa.int32()))}

    out = map_batches(rows, run, f"key {kind}, lines array<bigint>, words array<int>")
    return out.select("key", F.col("key.h").alias("h"), "lines", "words")


def _text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _key(id: Column, text: Column) -> Column:
    """Order and identity of a document: null ids last, then text hash."""
    return F.struct(id.isNull().alias("no_id"), id.alias("doc_id"), _text_hash(text).alias("h"))


def _runs(lines: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Runs (start, end) of lines that reach ``min_words`` and do so no more
    without their last line, or no more without their first."""
    out, end, n = set(), 0, 0
    for start in range(len(lines)):         # forwards from each line
        while end < len(lines) and n < min_words:
            n, end = n + words[end], end + 1
        if n < min_words:
            break
        out.add((start, end))
        n -= words[start]
    start, n = 0, 0
    for end in range(1, len(lines) + 1):    # backwards from each line
        n += words[end - 1]
        while start < end and n - words[start] >= min_words:
            n, start = n - words[start], start + 1
        if n >= min_words:
            out.add((start, end))
    return sorted(out)


def text_runs(texts: DataFrame, min_words: int) -> DataFrame:
    """``(key, run, start, end, once)``: hashes of the runs of lines, and
    whether the text holds the run once."""
    rows = texts.select("key", "lines", "words")
    kind = rows.schema["key"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        runs = []
        for x, w in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            raw = array("q", x).tobytes()
            own = [(xxhash.xxh64_intdigest(raw[8 * i:8 * j]) - (1 << 63), i, j) for i, j in _runs(x, w, min_words)]
            n = Counter(h for h, _, _ in own)
            runs.append([{"run": h, "start": i, "end": j, "once": n[h] == 1} for h, i, j in own])
        return {"key": b.column(0), "runs": pa.array(runs, pa.list_(pa.struct(
            [("run", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("once", pa.bool_())])))}

    out = map_batches(rows, run, f"key {kind}, runs array<struct<run: bigint, start: int, end: int, once: boolean>>")
    return out.select("key", F.explode("runs").alias("r")).select("key", "r.*")


def _cut_lines(pairs: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """``(key, cut)`` of the documents b that lose lines to their pairs (a, b)."""
    both = pairs.join(texts.select(F.col("key").alias("a_key"), F.col("lines").alias("a_lines")),
                      F.col("a") == F.col("a_key")) \
        .select("b", "a_lines").join(texts.select("key", "lines", "words"), F.col("b") == F.col("key")) \
        .select("key", "a_lines", "lines", "words")
    kind = both.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [common_blocks(x, y, w, min_words) for x, y, w in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            some = pa.array([bool(c) for c in cut])
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.list_(pa.int32()))], names=["key", "cut"])
            yield out.filter(some)

    return both.mapInArrow(run, f"key {kind}, cut array<int>") \
        .select("key", F.explode("cut").alias("line")).groupBy("key").agg(F.collect_set("line").alias("cut"))


def _standing(held: DataFrame, cuts: DataFrame) -> DataFrame:
    """``held(key, run, start, end)`` without the runs whose lines all go."""
    own = held.groupBy("key").agg(F.collect_list(F.struct("run", "start", "end")).alias("runs"))
    rows = own.join(cuts.select(F.col("key").alias("c_key"), "cut"), F.col("key") == F.col("c_key"), "left") \
        .select("key", "runs", "cut")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("key", "runs")}

    def run(b: pa.RecordBatch) -> dict:
        runs = []
        for own, cut in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            gone = set(cut or ())
            runs.append([r for r in own if not all(k in gone for k in range(r["start"], r["end"]))])
        return {"key": b.column(0), "runs": pa.array(runs, b.column(1).type)}

    out = map_batches(rows, run, f"key {kinds['key']}, runs {kinds['runs']}")
    return out.select("key", F.explode("runs").alias("r")).select("key", "r.*")


GAP = 1 << 64       # added to a place for a gap in an outline: equal to no line, nor to a gap of the other side


def _by_outlines(left: DataFrame, holders: DataFrame, texts: DataFrame, min_words: int,
                 early: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) that share a rare line, to be aligned, and the cuts
    ``(key, cut)`` of all other pairs, from their outlines. ``left(key, run)`` are
    the documents with standing runs, ``holders(a, h_run)`` all that hold these."""
    members = holders.select(F.col("a").alias("m_key")).distinct()
    docs = materialize(texts.join(members, F.col("key") == F.col("m_key"), "left_semi").select("key", "lines", "words"), "members")
    each = materialize(docs.select("key", F.explode(F.array_distinct("lines")).alias("line")).where("line <> 0"), "each")
    count = materialize(each.groupBy(F.col("line").alias("n_line")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "line-counts")
    rare = materialize(each.join(count.where(F.col("n") <= early), F.col("line") == F.col("n_line")).select("key", "line"), "rare")
    later = left.select(F.col("key").alias("l_key")).distinct()
    b_side = rare.join(later, F.col("key") == F.col("l_key"), "left_semi").select(F.col("key").alias("b"), F.col("line").alias("b_line"))
    partners = materialize(rare.select(F.col("key").alias("a"), "line")
                           .join(b_side, (F.col("line") == F.col("b_line")) & (F.col("a") < F.col("b"))).select("a", "b").distinct(),
                           "partners")

    # outlines: which lines of a document are frequent comes back as their places
    often = each.join(count.where(F.col("n") > early), F.col("line") == F.col("n_line")) \
        .groupBy(F.col("key").alias("o_key")).agg(F.collect_list("line").alias("often"))
    rows = docs.join(often, F.col("key") == F.col("o_key"), "left").select("key", "lines", "words", "often")
    kind = rows.schema["key"].dataType.simpleString()

    def outline(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"cls": [], "tokens": [], "sizes": [], "places": []}
        for lines, words, often in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
            keep, tokens, sizes, places = {0, *(often or ())}, [], [], []
            for k, (x, n) in enumerate(zip(lines, words)):
                if x in keep:
                    tokens.append(x)
                elif tokens and tokens[-1] is None:
                    continue
                else:
                    tokens.append(None)
                sizes.append(n if tokens[-1] is not None else 0)
                places.append(k)
            raw = array("q", [z for t, n in zip(tokens, sizes) for z in ((0, 0, -1) if t is None else (1, t, n))]).tobytes()
            for c, v in zip(out, (xxhash.xxh128_hexdigest(raw), tokens, sizes, places)):
                out[c].append(v)
        return {"key": b.column(0), "cls": pa.array(out["cls"]), "tokens": pa.array(out["tokens"], pa.list_(pa.int64())),
                "sizes": pa.array(out["sizes"], pa.list_(pa.int32())), "places": pa.array(out["places"], pa.list_(pa.int32()))}

    made = materialize(map_batches(rows, outline, f"key {kind}, cls string, tokens array<bigint>, sizes array<int>, places array<int>"),
                       "outlines")
    classes = materialize(made.groupBy("cls").agg(F.min("key").alias("low"), F.any_value("tokens").alias("tokens"),
                                                  F.any_value("sizes").alias("sizes")), "classes")
    of = made.select(F.col("key").alias("c_key"), "cls")
    by_run = lambda df, key: df.join(of, F.col(key) == F.col("c_key"))
    a = by_run(holders, "a").groupBy(F.col("cls").alias("a_cls"), "h_run").agg(F.min("a").alias("a_low"))
    b = by_run(left, "key").groupBy(F.col("cls").alias("b_cls"), "run").agg(F.max("key").alias("b_high"))
    pairs = a.join(b, (F.col("h_run") == F.col("run")) & (F.col("a_low") < F.col("b_high"))).select("a_cls", "b_cls").distinct()
    side = lambda x: classes.select(F.col("cls").alias(f"{x}_c"), F.col("tokens").alias(f"{x}_tokens"),
                                    F.col("sizes").alias(f"{x}_sizes"), F.col("low").alias(f"{x}_low"))
    pairs = pairs.join(side("a"), F.col("a_cls") == F.col("a_c")).join(side("b"), F.col("b_cls") == F.col("b_c")) \
        .select("a_cls", "b_cls", "a_low", "a_tokens", "b_tokens", "b_sizes")

    def run(b: pa.RecordBatch) -> dict:
        cut = []
        for x, y, w in zip(*(b.column(i).to_pylist() for i in (3, 4, 5))):
            x = [GAP + 2 * k if t is None else t for k, t in enumerate(x)]
            y = [GAP + 2 * k + 1 if t is None else t for k, t in enumerate(y)]
            cut.append(common_blocks(x, y, w, min_words))
        return {"a_cls": b.column(0), "b_cls": b.column(1), "low": b.column(2), "at": pa.array(cut, pa.list_(pa.int32()))}

    found = materialize(map_batches(pairs, run, f"a_cls string, b_cls string, low {kind}, at array<int>").where(F.size("at") > 0),
                        "outline-cuts")
    # which documents of b's outline have an earlier one of a's that shares no rare line with them
    mine = by_run(later, "l_key").select(F.col("l_key").alias("b"), "cls")
    cand = found.join(mine, F.col("b_cls") == F.col("cls")).where(F.col("low") < F.col("b")).select("a_cls", "b", "low", "at")
    near = partners.join(of, F.col("a") == F.col("c_key")).groupBy(F.col("cls").alias("p_cls"), F.col("b").alias("p_b")) \
        .agg(F.count(F.lit(1)).alias("n"))
    cand = materialize(cand.join(near, (F.col("a_cls") == F.col("p_cls")) & (F.col("b") == F.col("p_b")), "left")
                       .select("a_cls", "b", "at", F.coalesce("n", F.lit(0)).alias("n")), "candidates")
    good = cand.where("n = 0").select("b", "at")
    most = cand.agg(F.max("n")).first()[0] or 0
    if most:        # of n + 1 earlier ones, one is no partner
        first = made.withColumn("rank", F.row_number().over(Window.partitionBy("cls").orderBy("key"))) \
            .where(F.col("rank") <= most + 1).select(F.col("cls").alias("f_cls"), F.col("key").alias("f_key"), "rank")
        seen = cand.where("n > 0").join(first, (F.col("a_cls") == F.col("f_cls")) & (F.col("rank") <= F.col("n") + 1)
                                        & (F.col("f_key") < F.col("b")))
        seen = seen.join(partners.select(F.col("a").alias("q_a"), F.col("b").alias("q_b")),
                         (F.col("f_key") == F.col("q_a")) & (F.col("b") == F.col("q_b")), "left_anti")
        good = good.unionByName(seen.select("b", "at"))
    cut = good.select("b", F.explode("at").alias("i")).distinct() \
        .join(made.select(F.col("key").alias("m_key"), "places"), F.col("b") == F.col("m_key")) \
        .select(F.col("b").alias("key"), F.expr("places[i]").alias("line"))
    return partners, cut.groupBy("key").agg(F.collect_set("line").alias("cut"))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, early: int = EARLY, text: str = "text",
                   id: str = "doc_id") -> DataFrame:
    """``(key, whole, cut)`` of the documents that lose lines: key as in
    ``_key``, whole if all lines go, else cut with the numbers of the lines."""
    rows = materialize(text_lines(docs, text, id).dropDuplicates(["key"]), "lines")
    texts = materialize(rows.groupBy("h").agg(F.min("key").alias("key"), F.first("lines").alias("lines"),
                                              F.first("words").alias("words")), "texts")
    runs = materialize(text_runs(texts, min_words), "runs")
    shared = materialize(runs.groupBy(F.col("run").alias("s_run"))
                         .agg(F.min("key").alias("first"), F.max("key").alias("last"),
                              F.min(F.when(F.col("once"), F.col("key"))).alias("single"))
                         .where("first < last").drop("last"), "shared")
    held = materialize(runs.join(shared, F.col("run") == F.col("s_run"))
                       .select("key", "run", "start", "end", "first", "single"), "held")

    def anew(pairs: DataFrame, done: list[DataFrame]) -> DataFrame:
        for x in done:
            pairs = pairs.join(x.select(F.col("a").alias("x_a"), F.col("b").alias("x_b")),
                               (F.col("a") == F.col("x_a")) & (F.col("b") == F.col("x_b")), "left_anti")
        return materialize(pairs, "pairs")

    ahead = [held.where(F.col("key") > F.col(c)).select(F.col(c).alias("a"), F.col("key").alias("b"))
             for c in ("first", "single")]
    done = [anew(ahead[0].unionByName(ahead[1]).distinct(), [])]
    cuts = materialize(_cut_lines(done[0], texts, min_words), "cuts")
    left = held.where(F.col("key") > F.col("first")).select("key", "run", "start", "end")
    holders = held.select(F.col("key").alias("a"), F.col("run").alias("h_run")).distinct()

    def add(old: DataFrame, new: DataFrame) -> DataFrame:
        more = old.unionByName(new).select("key", F.explode("cut").alias("line"))
        return materialize(more.groupBy("key").agg(F.collect_set("line").alias("cut")), "cuts")

    def holding(left: DataFrame) -> DataFrame:
        return holders.join(left.select(F.col("run").alias("w_run")).distinct(), F.col("h_run") == F.col("w_run"), "left_semi") \
            .select("a", "h_run")

    left = materialize(_standing(left, cuts), "standing")
    if not left.isEmpty():
        # first of parts, then of all, so that no task ranks all holders of a run
        some = holding(left).withColumn("part", F.pmod(F.xxhash64("a"), F.lit(32)))
        for by in (["h_run", "part"], ["h_run"]):
            some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("a"))).where(F.col("rank") <= early)
        wanted = materialize(some.select("a", "h_run"), "holders")
        pairs = left.select(F.col("key").alias("b"), "run").distinct() \
            .join(wanted, (F.col("run") == F.col("h_run")) & (F.col("a") < F.col("b"))).select("a", "b").distinct()
        done.append(anew(pairs, done))
        cuts = add(cuts, _cut_lines(done[-1], texts, min_words))
        sizes = materialize(holding(left).groupBy("h_run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > early)
                            .select(F.col("h_run").alias("n_run")), "sizes")
        left = _standing(left, cuts).join(sizes, F.col("run") == F.col("n_run"), "left_semi")
        left = materialize(left, "standing")
    if not left.isEmpty():
        wanted = materialize(holding(left), "holders")
        partners, more = _by_outlines(left.select("key", "run").distinct(), wanted, texts, min_words, early)
        cuts = add(cuts, _cut_lines(anew(partners, done), texts, min_words).unionByName(more))
    first = texts.select(F.col("h").alias("t_h"), F.col("key").alias("t_key"))
    copies = rows.join(first, F.col("h") == F.col("t_h")).where(F.col("key") != F.col("t_key")) \
        .where(F.aggregate("words", F.lit(0), lambda a, x: a + x) >= min_words) \
        .select("key", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("cut"))
    return cuts.select("key", F.lit(False).alias("whole"), "cut").unionByName(copies)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, early: int = EARLY, text: str = "text", id: str = "doc_id",
                report: bool = False) -> DataFrame:
    """``docs`` with the common blocks deleted from ``text``; all columns and
    rows stay. With ``report`` a row is ``(doc_id, n_lines, n_cut, text)``.

    Null and empty texts stay as they are; a text whose lines all go is
    empty. Rows that repeat an id and its text count as one document and are
    all changed alike; rows that repeat an id with another text are documents
    of their own, ordered by text hash. Null ids come after all others.
    """
    cuts = materialize(repeated_lines(docs, min_words, early, text, id), "cuts")
    t = F.col(f"`{text}`")
    rows = pack_rows(docs, _id=F.col(f"`{id}`"), _h=_text_hash(t), _text=t)
    cuts = cuts.select(F.col("key.doc_id").alias("c_id"), F.col("key.h").alias("c_h"), "whole", "cut")
    rows = rows.join(cuts, F.col("_id").eqNullSafe(F.col("c_id")) & (F.col("_h") == F.col("c_h")), "left")
    kept = F.array_join(F.filter(F.split("_text", "\n", -1), lambda x, i: ~F.array_contains("cut", i)), "\n")
    new = F.when(F.col("whole").isNull(), F.col("_text")).when(F.col("whole"), F.lit("")).otherwise(kept)
    if report:
        n = F.size(F.split(F.coalesce("_text", F.lit("")), "\n", -1)).cast("bigint")
        return rows.select(F.col("_id").alias("doc_id"), n.alias("n_lines"),
                           F.when(F.col("whole").isNull(), 0).when(F.col("whole"), n).otherwise(F.size("cut"))
                           .cast("bigint").alias("n_cut"), new.alias("text"))
    return unpack_rows(rows.withColumn("_row", F.col("_row").withField(text, new)))
