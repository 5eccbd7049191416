"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``max_bits`` differing bits are linked; components of
links are groups. Method (Qin et al., "GPH: Similarity Search in Hamming
Space", 2018):

1. Bits that are correlated over the corpus are grouped together: first
   into eight bytes, then bytes into a few partitions. The number of
   partitions is the one with the least estimated cost.
2. Two fingerprints within ``d`` bits must agree to within ``T_i`` bits in
   some partition ``i`` whenever ``sum(T_i + 1) = d + 1`` (``T_i = -1`` skips
   a partition). Each fingerprint gets its own thresholds by dynamic
   programming on the estimated number of candidates, from the frequency of
   byte values over the whole corpus (8 x 256 counts, whatever its size).
3. A fingerprint is stored under its value in every partition and probes the
   values within ``T_i`` bits of its own. Rows meet on (partition, value) and
   are verified by an exact bit count.

Equal fingerprints are one class from the start. Inside a bucket the links
found are turned into stars at once, so large groups of near copies emit a
row for each member, not for each pair. A bucket with more than ``CHUNK``
stored fingerprints is split and its probes go to each part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, pack_rows, texts_of, unpack_rows
from .graph import components, local_stars

CHUNK = 8192            # stored fingerprints of one bucket that one task compares with its probes
PAIRS = 2_000_000       # candidate pairs verified at once
LAYOUTS = ((4, 4), (3, 3, 2), (2, 2, 2, 2))   # bytes in each partition
PROBE_COST, CANDIDATE_COST = 1.0, 0.02  # a shuffled row against a verified candidate


# ------------------------------------------------------------ fingerprints
def simhash(text: bytes, shingle: int = 4, block: int = 1 << 18) -> int:
    """The 64-bit fingerprint of one text (see ``fingerprints``)."""
    words = text.lower().split()        # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    h, votes = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, n, block):
        got = b"".join([h(line[s:e], 42) for s, e in zip(starts[i:i + block], ends[i:i + block])])
        votes += np.unpackbits(np.frombuffer(got, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp)`` for every row: fp is the signed 64-bit SimHash of the
    word shingles. A null or empty text has fingerprint zero; a text of fewer
    than ``shingle`` words is one shingle. Repeated rows stay repeated."""
    kind = docs.schema[id].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        fp = np.array([simhash(t, shingle) for t in texts_of(b.column(1))], np.uint64).view(np.int64)
        return {"doc_id": b.column(0), "fp": fp}

    return map_batches(docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), run,
                       f"doc_id {kind}, fp bigint")


# ---------------------------------------------------------- corpus statistics
def _bits(fp: np.ndarray) -> np.ndarray:
    """Bits of fingerprints, most significant first: n x 64."""
    return np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _bytes(fp: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The eight bytes made of the bits in ``order``: n x 8."""
    return np.packbits(_bits(fp)[:, order], axis=1)


def _summed(classes: DataFrame, count, size: int) -> np.ndarray:
    """Sum over all rows of a vector of counts of fixed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += count(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_pydict({"i": at.astype(np.int32), "n": total[at]})

    out = np.zeros(size, np.int64)
    rows = classes.select("fp").mapInArrow(run, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n"))
    for i, n in rows.collect():         # at most ``size`` rows
        out[i] = n
    return out


def group_bits(joint: np.ndarray, n: int) -> np.ndarray:
    """An order of the 64 bits in which each eight are a group of correlated
    bits and similar groups are neighbours."""
    p = np.diag(joint) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    while left:
        free = sorted(left)
        sub = corr[np.ix_(free, free)]
        group = [free[int(np.argmax(sub.max(1)))]]
        while len(group) < 8:
            rest = [x for x in free if x not in group]
            group.append(rest[int(np.argmax(corr[np.ix_(rest, group)].sum(1)))])
        groups.append(group)
        left -= set(group)
    order = [groups.pop(0)]
    while groups:
        k = int(np.argmax([corr[np.ix_(order[-1], g)].mean() for g in groups]))
        order.append(groups.pop(k))
    return np.array(order).ravel()


_POP = np.array([bin(x).count("1") for x in range(256)])
_FAR = _POP[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


def byte_shares(hist: np.ndarray, n: int, d: int) -> np.ndarray:
    """share[s, v, t]: part of the corpus whose byte s is at distance t of v."""
    return np.stack([[(hist[s] / max(n, 1)) @ (_FAR == t).T for t in range(d + 1)] for s in range(8)]) \
        .transpose(0, 2, 1)


def _ball(bits: int, r: int) -> int:
    from math import comb
    return sum(comb(bits, t) for t in range(r + 1))


def _costs(share: np.ndarray, values: np.ndarray, layout, n: int, d: int) -> np.ndarray:
    """cost[q, i, u]: expected cost of giving u units (radius u - 1) to
    partition i for the query with these byte values."""
    out = np.zeros((len(values), len(layout), d + 2))
    s = 0
    for i, k in enumerate(layout):
        dist = share[s, values[:, s]]
        for x in range(s + 1, s + k):
            more = share[x, values[:, x]]
            dist = np.stack([sum(dist[:, a] * more[:, t - a] for a in range(t + 1)) for t in range(d + 1)], axis=1)
        s += k
        out[:, i, 1:] = CANDIDATE_COST * n * np.cumsum(dist, axis=1)
        out[:, i, 1:] += PROBE_COST * np.array([_ball(8 * k, r) for r in range(d + 1)])
    return out


def allocate(cost: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Dynamic programming over the partitions: units given to each, with
    ``units`` in all, at the least total cost. Returns (allocation, cost)."""
    n, m, _ = cost.shape
    best = cost[:, 0, : units + 1].copy()
    took = np.zeros((n, m, units + 1), np.int8)
    took[:, 0] = np.arange(units + 1)
    for i in range(1, m):
        new = np.full_like(best, np.inf)
        for s in range(units + 1):
            options = np.stack([best[:, s - u] + cost[:, i, u] for u in range(s + 1)], axis=1)
            took[:, i, s] = options.argmin(1)
            new[:, s] = options.min(1)
        best = new
    give, left, rows = np.zeros((n, m), np.int8), np.full(n, units), np.arange(n)
    for i in range(m - 1, -1, -1):
        give[:, i] = took[rows, i, left]
        left = left - give[:, i]
    return give, best[:, units]


def choose_layout(hist: np.ndarray, n: int, d: int) -> tuple:
    """The layout with the least expected cost for a fingerprint of the
    corpus, from the same byte frequencies."""
    share = byte_shares(hist, n, d)
    mean = np.einsum("sv,svt->st", hist / max(n, 1), share)[:, None, :]
    cost = {x: float(allocate(_costs(mean, np.zeros((1, 8), int), x, n, d), d + 1)[1][0])
            for x in LAYOUTS if len(x) <= d + 1}
    return min(cost, key=cost.get)


# ------------------------------------------------------------ probe and verify
def _masks(bits: int, r: int) -> np.ndarray:
    """Every change of 1 to r of the low ``bits`` bits."""
    return np.array([sum(1 << x for x in c) for t in range(1, r + 1) for c in combinations(range(bits), t)],
                    np.uint64)


def _keys(byte: np.ndarray, layout) -> list[np.ndarray]:
    """The value of each partition."""
    out, s = [], 0
    for k in layout:
        v = np.zeros(len(byte), np.uint64)
        for x in range(s, s + k):
            v = (v << np.uint64(8)) | byte[:, x]
        out.append(v)
        s += k
    return out


def verify(index: np.ndarray, first: np.ndarray, count: np.ndarray, probes: np.ndarray, d: int) \
        -> tuple[np.ndarray, np.ndarray]:
    """Compare probe i with ``index[first[i]:first[i] + count[i]]``; the links
    within d bits as stars."""
    us, vs = [], []
    upto = np.cumsum(count)
    at = 0
    while at < len(probes):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        c = count[at:end]
        start = np.repeat(first[at:end] - (np.cumsum(c) - c), c)
        a, b = np.repeat(probes[at:end], c), index[start + np.arange(len(start))]
        x = a ^ b
        hit = (np.bitwise_count(x) <= d) & (x != 0)
        u, v = local_stars(a[hit].view(np.int64), b[hit].view(np.int64))
        us.append(u)
        vs.append(v)
        at = end
    return local_stars(np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, np.int64),) * 2


def _meet(d: int):
    """Over rows sorted by (key, part), stored rows before mere probes:
    compare within each run. Only the stored rows of a run that goes on in
    the next batch are kept, at most about ``CHUNK`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            key, part = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            fp = b.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            role = b.column(3).to_numpy(zero_copy_only=False)
            if held is not None:
                key, part, fp, role = (np.concatenate(x) for x in zip(held, (key, part, fp, role)))
            run_of = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (part[1:] != part[:-1]))])
            stored = (role & 1) == 1
            index, owner = fp[stored], run_of[stored]
            probe = (role & 2) == 2
            mine = run_of[probe]
            first = np.searchsorted(owner, mine, "left")
            count = np.searchsorted(owner, mine, "right") - first
            u, v = verify(index, first, count, fp[probe], d)
            if len(u):
                yield pa.RecordBatch.from_pydict({"u": u, "v": v})
            last = stored & (run_of == run_of[-1])
            # once mere probes come, all stored rows of the run have met
            held = key[last], part[last], fp[last], role[last] & 1 if role[-1] == 2 else role[last]

    return run


def links(classes: DataFrame, max_bits: int = 4) -> DataFrame:
    """``classes(fp)``, distinct -> edges ``(u, v)`` with the reachability of
    all pairs within ``max_bits`` bits."""
    spark, d = classes.sparkSession, max_bits
    n = classes.count()
    joint = _summed(classes, lambda x: (lambda b: (b.T @ b).astype(np.int64).ravel())(_bits(x).astype(np.float64)),
                    4096).reshape(64, 64)
    order = group_bits(joint, n)
    hist = _summed(classes, lambda x: np.concatenate([np.bincount(c, minlength=256) for c in _bytes(x, order).T]),
                   2048).reshape(8, 256)
    layout = choose_layout(hist, n, d)
    share = byte_shares(hist, n, d)

    def stored(b: pa.RecordBatch) -> dict:
        byte = _bytes(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), order)
        return {"key": np.concatenate([(np.uint64(i << 40) | v).view(np.int64)
                                       for i, v in enumerate(_keys(byte, layout))])}

    hot = map_batches(classes, stored, "key bigint").groupBy("key").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > CHUNK).select(F.col("key").alias("hot"), F.ceil(F.col("n") / CHUNK).alias("parts"))
    hot = materialize(hot, "hot")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = {}
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                fp = b.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                if not len(fp):
                    continue
                byte = _bytes(fp, order)
                give, _ = allocate(_costs(share, byte, layout, n, d), d + 1)
                ks, fs, rs = [], [], []
                for i, value in enumerate(_keys(byte, layout)):
                    tag = np.uint64(i << 40)
                    ks.append(tag | value)
                    fs.append(fp)
                    rs.append(np.where(give[:, i] > 0, 3, 1).astype(np.int8))
                    for u in range(2, d + 2):
                        sel = give[:, i] == u
                        if sel.any():
                            m = masks.setdefault((i, u), _masks(8 * layout[i], u - 1))
                            ks.append((tag | (value[sel][:, None] ^ m[None, :])).ravel())
                            fs.append(np.repeat(fp[sel], len(m)))
                            rs.append(np.full(int(sel.sum()) * len(m), 2, np.int8))
                yield pa.RecordBatch.from_pydict({"key": np.concatenate(ks).view(np.int64),
                                                  "fp": np.concatenate(fs).view(np.int64),
                                                  "role": np.concatenate(rs)})

    sigs = classes.select("fp").mapInArrow(rows, "key bigint, fp bigint, role tinyint")
    if hot.isEmpty():
        sigs = sigs.withColumn("part", F.lit(0))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        sigs = sigs.join(hot, F.col("key") == F.col("hot"), "left") \
            .withColumn("own", F.when(F.col("parts").isNull(), 0).otherwise(own)) \
            .withColumn("part", F.explode(F.when(F.col("parts").isNull() | (F.col("role") == 1), F.array("own"))
                                          .otherwise(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))) \
            .withColumn("role", F.when(F.col("part") == F.col("own"), F.col("role")).otherwise(F.lit(2))
                        .cast("tinyint"))
    met = sigs.select("key", "part", "fp", "role").repartition("key", "part") \
        .sortWithinPartitions("key", "part", (F.col("role") == 2))
    return met.mapInArrow(_meet(d), "u bigint, v bigint")


def _grouped(docs: DataFrame, shingle: int, max_bits: int, text: str, id: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and for each distinct fingerprint the best
    row key (smallest id, nulls last; then text hash) of its component."""
    keyed = docs.select(F.struct(F.col(f"`{id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("h")).alias("key"),
                        F.col(f"`{text}`").alias("text"))
    fps = materialize(fingerprints(keyed, shingle, "text", "key").select("doc_id.*", "fp"), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h"))
                                                .alias("rep")), "classes")
    comp = materialize(components(links(classes.select("fp"), max_bits)), "components")
    labelled = classes.join(comp, F.col("fp") == F.col("node"), "left") \
        .select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    best = labelled.groupBy("component").agg(F.min("rep").alias("best"))
    return fps, materialize(labelled.join(best, "component").select(F.col("fp").alias("_fp"), "best"), "classes")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text", id: str = "doc_id") \
        -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``; component_id
    is the smallest id among the rows reachable through fingerprints that
    differ in at most ``max_bits`` bits (the row itself included).

    Null and empty texts have fingerprint zero and link like any other. Rows
    that repeat an id each get their own row and fingerprint. A null id is no
    candidate for the smallest id: a component of null ids only has a null
    component_id. An empty table gives no rows; other columns are ignored.
    """
    fps, named = _grouped(docs, shingle, max_bits, text, id)
    return fps.join(named, F.col("fp") == F.col("_fp")) \
        .select("doc_id", "fp", F.col("best.doc_id").alias("component_id"))


def fp_hex(fp) -> Column:
    """A signed fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_representatives(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each group of
    near duplicates: the one with the smallest doc_id, null ids last. Of rows
    that repeat this doc_id and its text, one stays."""
    _, named = _grouped(docs, shingle, max_bits, "text", "doc_id")
    winners = named.select("best.doc_id", "best.h").distinct()
    rows = pack_rows(docs, _id=F.col("doc_id"), _h=F.xxhash64("text"))
    one = rows.join(winners, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("h")))
    return unpack_rows(one.groupBy("_id", "_h").agg(F.first("_row").alias("_row")))
