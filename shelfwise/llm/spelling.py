"""Spelling variants: words one edit apart, by k-d trees over letter counts.

A word is a point of its letter counts. One replaced letter takes one from a
coordinate and adds one to another (L1 distance two, one step down, one up);
one inserted letter adds one (L1 distance one). So near words of one length
lie within one step down and one up of each other, and the longer word of a
pair of lengths within one step up of the shorter.

1. For each length a k-d tree is fitted on a bounded sample of the words
   (``SAMPLE`` letter-count vectors, smallest hashes first). It only cuts the
   space into cells; every word is placed.
2. Every word goes to its home cell, to the other cells of its length that
   one step down and one up can reach (later ones only, so a pair meets
   once), and to the cells of the next length that one step up can reach.
   The box of a cell is pruned as soon as its borders need a second step.
3. Inside a cell a k-d search of the same kind narrows visitors down to small
   boxes of residents, distances are taken there, and the letters of each
   candidate pair are compared in order.
4. Only (word, near words counted, best near word) leaves a cell.

A cell that holds more than ``HOT`` residents (words of the same letters are one
point, which no tree can cut) is not sent to one task: its words are joined by
the word with one place left out, a key that few words share.

Defined results: null texts hold no words; a null ``doc_id`` counts as an empty
one in the checksum of a slip; documents repeated are counted again; empty
tables give no rows. Words are kept as Latin-1 bytes, whose order is that of
the code points. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LEAF = 2048         # words of a cell, as far as the tree has leaves
LEAVES = 4096       # most cells of a length
SAMPLE = 1 << 15    # words that the trees are fitted on
HOT = 1 << 15       # residents of a cell that one task compares
BLOCK = 1 << 18     # distances taken at once
FREE, NEVER = -1, -2

_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")   # a-z, U+00C0..U+00FF in UTF-8
# one coordinate for each letter: a-z, then U+00C0..U+00FF
_AXIS = np.zeros(256, np.int64)
_AXIS[97:123] = np.arange(26)
_AXIS[192:256] = np.arange(26, 90)
AXES = 90


def count_words(documents: DataFrame, slip: int | None = None, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``(word, n)`` of the runs of letters of all texts, A-Z lower-cased;
    ``word`` in Latin-1 bytes. With ``slip`` the run of a document whose
    h = crc32("<doc_id>:<run>") it divides loses its code point h % length.
    Words are counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(b"%s:" % ("" if doc is None else str(doc)).encode())
                for run, n in Counter(_RUN.findall(text.lower())).items():
                    h = zlib.crc32(run, start)
                    word = run if run.isascii() else run.decode().encode("latin-1")
                    if slip and h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= min_length:
                        words[word] += n
            if len(words) > 400_000:
                yield _batch(words)
                words.clear()
        if words:
            yield _batch(words)

    parts = documents.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _batch(words: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())],
                                      ["word", "n"])


def letters(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of one length as a matrix of bytes, and their letter counts."""
    chars = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)
    flat = (np.arange(len(words))[:, None] * AXES + _AXIS[chars]).ravel()
    return chars, np.bincount(flat, minlength=len(words) * AXES).reshape(len(words), AXES).astype(np.int32)


def _best_cut(points: np.ndarray) -> tuple[int, int, int]:
    """(points on the smaller side, axis, threshold) of the most even cut."""
    best = (0, 0, 0)
    for t in range(int(points.max(initial=0))):
        right = (points > t).sum(0)
        even = np.minimum(right, len(points) - right)
        axis = int(even.argmax())
        best = max(best, (int(even[axis]), -axis, -t))
        if t >= 3 and best[0]:
            break       # most counts are small; higher cuts are hardly evener
    return best[0], -best[1], -best[2]


def grow_tree(points: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """Nodes (axis, threshold, left, right) of a k-d tree; a negative child
    is the cell -1 - child. The largest part is cut until ``leaves`` stand."""
    nodes: list[tuple[int, int, int, int]] = []
    parts = [(points, -1, 0)]       # points, node above, side
    while len(parts) < leaves:
        at = max(range(len(parts)), key=lambda i: len(parts[i][0]))
        own, above, side = parts[at]
        least, axis, t = _best_cut(own) if len(own) > 1 else (0, 0, 0)
        if not least:
            break
        if above >= 0:
            n = list(nodes[above])
            n[2 + side] = len(nodes)
            nodes[above] = tuple(n)
        high = own[:, axis] > t
        parts[at] = (own[~high], len(nodes), 0)
        parts.append((own[high], len(nodes), 1))
        nodes.append((axis, t, 0, 0))
    for cell, (_, above, side) in enumerate(parts):
        if above >= 0:
            n = list(nodes[above])
            n[2 + side] = -1 - cell
            nodes[above] = tuple(n)
    return nodes


def _sides(points, rows, up, down, axis, t):
    """Rows that can be left (at most t) and right of a cut, with the steps
    they take: a row beyond the border crosses it with its free step."""
    x = points[rows, axis] + (up == axis) - (down == axis)
    stay, cross = x <= t, (x == t + 1) & (down == FREE)
    left = (np.concatenate([rows[stay], rows[cross]]), np.concatenate([up[stay], up[cross]]),
            np.concatenate([down[stay], np.full(cross.sum(), axis)]))
    stay, cross = x > t, (x == t) & (up == FREE)
    right = (np.concatenate([rows[stay], rows[cross]]), np.concatenate([up[stay], np.full(cross.sum(), axis)]),
             np.concatenate([down[stay], down[cross]]))
    return left, right


def cells_of(points: np.ndarray, nodes: list, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for every cell of the tree that a row can reach with the
    steps it has (``FREE`` or ``NEVER``)."""
    rows = np.arange(len(points))
    if not nodes:
        return rows, np.zeros(len(rows), np.int64)
    found, todo = [], [(0, rows, np.full(len(rows), up), np.full(len(rows), down))]
    while todo:
        node, r, u, d = todo.pop()
        if not len(r):
            continue
        if node < 0:
            found.append((r, np.full(len(r), -1 - node)))
            continue
        axis, t, *kids = nodes[node]
        for kid, (r2, u2, d2) in zip(kids, _sides(points, r, u, d, axis, t)):
            todo.append((kid, r2, u2, d2))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_points(own: np.ndarray, other: np.ndarray, down: int, square: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of own, row of other) whose squared distance is ``square``:
    2 for a letter replaced (one step each way), 1 for a letter added. Both
    sides go down a k-d tree of ``own`` until a box is small."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    own_f, other_f = own.astype(np.float32), other.astype(np.float32)
    own_s, other_s = (own_f ** 2).sum(1), (other_f ** 2).sum(1)
    n = len(other)
    todo = [(np.arange(len(own)), np.arange(n), np.full(n, FREE), np.full(n, down))]
    while todo:
        mine, rows, u, d = todo.pop()
        if not len(mine) or not len(rows):
            continue
        least, axis, t = _best_cut(own[mine]) if len(mine) > 32 and len(mine) * len(rows) > BLOCK // 4 else (0, 0, 0)
        if least:
            high = own[mine, axis] > t
            for part, (r2, u2, d2) in zip((mine[~high], mine[high]), _sides(other, rows, u, d, axis, t)):
                todo.append((part, r2, u2, d2))
            continue
        step = max(1, BLOCK // len(mine))
        for k in range(0, len(rows), step):
            r = rows[k:k + step]
            dist = own_s[mine][:, None] + other_s[r][None, :] - 2 * (own_f[mine] @ other_f[r].T)
            a, b = np.nonzero(np.abs(dist - square) < 0.5)
            out.append((mine[a], r[b]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _one_added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether leaving one letter out of a row of ``a`` gives that of ``b``."""
    n = b.shape[1]
    same, late = a[:, :n] == b, a[:, 1:] == b
    head = np.where(same.all(1), n, (~same).argmax(1))
    tail = np.where(late.all(1), n, (~late[:, ::-1]).argmax(1))
    return head + tail >= n


def _by_gap(a: list[bytes], b: list[bytes]) -> Iterator[tuple[int, int]]:
    """Near pairs of two lists, one letter replaced or left out of ``a``, in
    steps linear in the lists: words that share a gapped form are near."""
    gaps: dict = {}
    same = len(a[0]) == len(b[0])
    for j, w in enumerate(b):
        for key in {(i, w[:i] + w[i + 1:]) for i in range(len(w))} if same else (w,):
            gaps.setdefault(key, []).append(j)
    for i, w in enumerate(a):
        forms = ((k, w[:k] + w[k + 1:]) for k in range(len(w))) if same else {w[:k] + w[k + 1:] for k in range(len(w))}
        for key in forms:
            for j in gaps.get(key, ()):
                if w != b[j]:
                    yield i, j


def _groups(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different points, rows ordered by point, and where each point starts."""
    view = np.ascontiguousarray(points).view([("", points.dtype)] * points.shape[1]).ravel()
    _, first, inverse, counts = np.unique(view, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(inverse, kind="stable")
    return points[first], order, np.concatenate([[0], np.cumsum(counts)])


def near_words(own: list[bytes], other: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of near words, one of each list; the words of a list have
    one length, those of ``other`` the same or one less."""
    none = np.zeros(0, np.int64)
    if not own or not other:
        return none, none
    la, lb = len(own[0]), len(other[0])
    a_chars, a_pts = letters(own, la)
    b_chars, b_pts = letters(other, lb)
    used = np.flatnonzero((a_pts.any(0)) | (b_pts.any(0)))
    a_pts, a_order, a_at = _groups(a_pts[:, used])
    b_pts, b_order, b_at = _groups(b_pts[:, used])
    u, v = near_points(a_pts, b_pts, FREE, 2) if la == lb else near_points(a_pts, b_pts, NEVER, 1)
    na, nb = np.diff(a_at)[u], np.diff(b_at)[v]
    check = _one_replaced if la == lb else _one_added
    found_a, found_b = [none], [none]
    big = na * nb > 1 << 16
    for x, y in zip(u[big], v[big]):
        rows_a, rows_b = a_order[a_at[x]:a_at[x + 1]], b_order[b_at[y]:b_at[y + 1]]
        got = list(_by_gap([own[i] for i in rows_a], [other[j] for j in rows_b]))
        if got:
            found_a.append(rows_a[[i for i, _ in got]])
            found_b.append(rows_b[[j for _, j in got]])
    u, v, na, nb = u[~big], v[~big], na[~big], nb[~big]
    ends = np.cumsum(na * nb)
    width = max(1, (1 << 24) // max(la, 1))
    lo = 0
    while lo < len(u):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + width, "right")))
        sizes = (na * nb)[lo:hi]
        pair = np.repeat(np.arange(lo, hi), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i = a_order[a_at[u[pair]] + at // nb[pair]]
        j = b_order[b_at[v[pair]] + at % nb[pair]]
        step = max(1, (1 << 25) // max(la, 1))
        for k in range(0, len(i), step):
            ok = check(a_chars[i[k:k + step]], b_chars[j[k:k + step]])
            found_a.append(i[k:k + step][ok])
            found_b.append(j[k:k + step][ok])
        lo = hi
    return np.concatenate(found_a), np.concatenate(found_b)


def _best_of(words: list[bytes], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict:
    """For each word of a pair: near words counted, and the commonest of
    them (the smallest of equally common ones)."""
    mine, near = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -n[near], mine))
    mine, near = mine[order], near[order]
    ids, first, counts = np.unique(mine, return_index=True, return_counts=True)
    return {"word": pa.array([words[i] for i in ids], pa.binary()), "n": pa.nulls(len(ids), pa.int64()),
            "n_near": pa.array(counts, pa.int64()), "best_n": pa.array(n[near[first]], pa.int64()),
            "best": pa.array([words[i] for i in near[first]], pa.binary())}


_PART = "word binary, n bigint, n_near bigint, best_n bigint, best binary"


def _compare_cell(cell: pa.Table) -> pa.Table:
    """All near pairs of a cell of which one word at least is at home."""
    kind = np.asarray(cell.column("kind").to_pylist(), np.int64)
    words, n = cell.column("word").to_pylist(), np.asarray(cell.column("n").to_pylist(), np.int64)
    home, guest, short = (np.flatnonzero(kind == k) for k in range(3))
    rows = np.concatenate([home, guest])
    pick = lambda at: [words[i] for i in at]
    a, b = near_words(pick(home), pick(rows))
    a, b = home[a], rows[b]
    once = (kind[b] == 1) | (a < b)
    sa, sb = near_words(pick(home), pick(short))
    a, b = np.concatenate([a[once], home[sa]]), np.concatenate([b[once], short[sb]])
    return pa.table(_best_of(words, n, a, b))


def _fit(words: DataFrame) -> dict[int, list]:
    """Trees of the lengths that have more words than a cell should hold,
    on a sample of at most ``SAMPLE`` letter-count vectors."""
    length = F.length("word")
    sizes = {r["l"]: r["c"] for r in words.groupBy(length.alias("l")).count().withColumnRenamed("count", "c")
             .where(F.col("c") > LEAF).collect()}
    if not sizes:
        return {}

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = b.column(0).to_pylist()
            vectors = [letters([w], len(w))[1][0].clip(max=65535).astype("<u2").tobytes() for w in got]
            yield pa.RecordBatch.from_arrays([pa.array([len(w) for w in got], pa.int32()),
                                              pa.array(vectors, pa.binary())], ["l", "v"])

    sample = words.where(length.isin(list(sizes))).orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word")
    at: dict[int, list] = {}
    for r in sample.mapInArrow(points, "l int, v binary").collect():
        at.setdefault(r["l"], []).append(np.frombuffer(r["v"], "<u2").astype(np.int32))
    return {k: grow_tree(np.array(v), min(LEAVES, -(-sizes[k] // LEAF))) for k, v in at.items()}


def _route(words: DataFrame, trees: dict[int, list]) -> DataFrame:
    """``(len, cell, kind, word, n)``: kind 0 at home, 1 from an earlier cell
    of its length, 2 from the length below."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, n = b.column(0).to_pylist(), np.asarray(b.column(1).to_pylist(), np.int64)
            size = np.array([len(w) for w in own])
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                length = int(length)
                for k in range(0, len(at), max(1, (1 << 24) // max(length, AXES))):
                    some = at[k:k + max(1, (1 << 24) // max(length, AXES))]
                    pts = letters([own[i] for i in some], length)[1]
                    home = np.zeros(len(some), np.int64)
                    r, c = cells_of(pts, trees.get(length, []), NEVER, NEVER)
                    home[r] = c
                    r1, c1 = cells_of(pts, trees.get(length, []), FREE, FREE)
                    late = c1 > home[r1]
                    r2, c2 = cells_of(pts, trees.get(length + 1, []), FREE, NEVER)
                    rows = some[np.concatenate([r, r1[late], r2])]
                    kinds = np.repeat([0, 1, 2], [len(r), late.sum(), len(r2)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(length + (kinds == 2), pa.int32()),
                        pa.array(np.concatenate([c, c1[late], c2]), pa.int32()), pa.array(kinds, pa.int32()),
                        pa.array([own[i] for i in rows], pa.binary()), pa.array(n[rows], pa.int64())],
                        ["len", "cell", "kind", "word", "n"])

    return words.select("word", "n").mapInArrow(place, "len int, cell int, kind int, word binary, n bigint")


def _hot_pairs(rows: DataFrame) -> DataFrame:
    """Near pairs of hot cells by a join on the word with a place left out."""
    gap = lambda i: F.concat(F.substring("word", F.lit(1), i - 1),
                             F.substring("word", i + 1, F.length("word")))
    places = F.sequence(F.lit(1), F.length("word"))
    here = [F.col(x) for x in ("len", "cell", "kind", "word", "n")]
    same = rows.where("kind < 2").select(*here, F.explode(F.transform(
        places, lambda i: F.struct(i.alias("at"), gap(i).alias("form")))).alias("g"))
    longer = rows.where("kind = 0").select(*here, F.explode(F.array_distinct(F.transform(places, gap))).alias("form"))
    key = ["len", "cell", "g"]
    a = same.select(*key, F.col("kind").alias("ka"), F.col("word").alias("a"), F.col("n").alias("na"))
    b = same.select(*key, F.col("kind").alias("kb"), F.col("word").alias("b"), F.col("n").alias("nb"))
    pairs = a.join(b, key).where("a < b and (ka = 0 or kb = 0)").select("a", "na", "b", "nb")
    short = rows.where("kind = 2").select("len", "cell", F.col("word").alias("form"), F.col("n").alias("nb"))
    pairs = pairs.unionByName(longer.join(short, ["len", "cell", "form"]).select(
        F.col("word").alias("a"), F.col("n").alias("na"), F.col("form").alias("b"), "nb"))
    return pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("nb").alias("best_n"), F.col("b").alias("best")),
        F.struct(F.col("b").alias("word"), F.col("na").alias("best_n"), F.col("a").alias("best"))))) \
        .select("word", F.lit(None).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("n_near"), "best_n", "best")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, by pointer doubling: each form
    is at least twice as common, so chains are short."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        on = links.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        step = materialize(links.join(on, F.col("root") == F.col("_w"), "left")
                           .select("word", F.coalesce("_next", "root").alias("root"),
                                   F.col("_next").isNotNull().alias("moved")), "links")
        links = step.drop("moved")
        if step.where("moved").isEmpty():
            return links


def spelling_variants(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``words(word, n)`` (Latin-1 bytes, each once) -> ``word`` string, ``n``,
    ``n_near`` (words one edit apart), ``form`` (the commonest of them where it
    is at least twice as common, else null), ``form_n`` and ``root`` (the last
    word reached by following forms)."""
    words = materialize(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    routed = materialize(_route(words, _fit(words)), "routed")
    sizes = routed.groupBy("len", "cell").agg(F.count(F.when(F.col("kind") == 0, 1)).alias("homes"))
    sizes = materialize(sizes, "cells")
    few, many = routed, None
    if not sizes.where(F.col("homes") > hot).isEmpty():
        marked = routed.join(sizes, ["len", "cell"])
        few, many = marked.where(F.col("homes") <= hot).drop("homes"), marked.where(F.col("homes") > hot).drop("homes")
    n = min(max(1, sizes.count()), max(8, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = few.repartition(n, "len", "cell").groupBy("len", "cell").applyInArrow(_compare_cell, _PART)
    if many is not None:
        found = found.unionByName(_hot_pairs(materialize(many, "hot")))
    nil = [F.lit(None).cast(t).alias(x) for x, t in (("n_near", "bigint"), ("best_n", "bigint"), ("best", "binary"))]
    best = found.unionByName(words.select("word", "n", *nil)).groupBy("word").agg(
        F.max("n").alias("n"), F.coalesce(F.sum("n_near"), F.lit(0)).alias("n_near"),
        F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best")))).alias("b"))
    has = -F.col("b.m") >= 2 * F.col("n")
    table = materialize(best.select("word", "n", "n_near", F.when(has, F.col("b.best")).alias("form"),
                                    F.when(has, -F.col("b.m")).alias("form_n")), "near")
    roots = _roots(table.where("form is not null")).withColumnRenamed("word", "_w")
    text = lambda c: F.decode(c, "ISO-8859-1")
    return table.join(roots, F.col("word") == F.col("_w"), "left").select(
        text("word").alias("word"), "n", "n_near", text("form").alias("form"), "form_n",
        text(F.coalesce("root", "word")).alias("root"))
