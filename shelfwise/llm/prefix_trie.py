"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns (role, text). It is cut into blocks of
``BLOCK`` turns. A turn has two 64-bit hashes of its position and content; a
block's digest is the exclusive or of its turns' hashes, a prefix's digest
that of all turns in it, so digests are added up in any order, in parts, and
a conversation of any length needs no sequential pass. Equal digests (128
bits) and equal depths stand for equal prefixes.

1. Conversations are grouped by (digest before the block, digest after it):
   one row for each different block in its place, with its member counts.
   Copies meet here, partially aggregated before the shuffle.
2. Where all who go on after a block boundary share the same next block, its
   turns are nodes with the block's members: nothing is compared. Only where
   siblings diverge inside a block are the different blocks (not the
   conversations) cut into turns and grouped by the digest after each turn.
3. Sums over subtrees need no walk up the tree. The smallest member of a node
   owns it; a conversation owns a suffix of its path. So the turns below a node
   are what its members own, and the leaves below it are the leaves owned by
   its members: two sums over members, by the same two steps.

Defined results: null role and text are empty; turns go by ``turn`` (null
first), equal ones by a hash of their content; repeated rows are repeated
turns. Rows with a null ``conv_id`` belong to no conversation and are left out.
An empty table has no nodes, not even a root. Extra columns are ignored.

Scale: the window over a conversation sees one row for each ``BLOCK * SUPER``
turns, every other group is bounded or partially aggregated. Ids of a node's
ending conversations are sorted by range, joined to pieces of ``PIECE`` ids and
hashed piece by piece, so the group of a very common conversation is never
held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import running_count
from .common import materialize

BLOCK = 8       # turns of a block
SUPER = 256     # blocks whose digests are summed up in one window
PIECE = 4096    # ids hashed as one piece


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, h1, h2, size)``: every turn with its position from 0,
    two hashes of its content and the code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit("second"), text, role).alias("h2"), F.length(text).cast("bigint").alias("size"))
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    return running_count(turns, ["conv_id"], order, out="pos").select("conv_id", "pos", "h1", "h2", "size")


def share_heads(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations on shared first turns: conversation c takes the
    first h turns of conversation c - c % family, then its own after its
    first h; h = crc32(decimal c) % most. Returns the rebuilt turns and all
    conversation ids (a rebuilt conversation may have no turn)."""
    ids = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conv-ids")
    heads = turns.where(F.col("pos") < most - 1).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "size"))).alias("head"))
    base = F.col("conv_id") - F.col("conv_id") % family
    taken = materialize(
        ids.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
                   .cast("int").alias("h"))
        .join(heads, "base", "left")
        .select("conv_id", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1),
                                        F.col("h")).alias("head")), "conv-heads")
    own = turns.join(taken.select("conv_id", "h", F.size("head").alias("n_head")), "conv_id") \
        .where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"), "h1", "h2", "size")
    return own.unionByName(taken.select("conv_id", F.inline("head"))), ids.select("conv_id")


def _blocks(turns: DataFrame) -> DataFrame:
    """One row for each conversation and block: digests before (p1, p2) and
    after (q1, q2), code points before it, its turns in order."""
    where = F.struct(F.col("pos").alias("pos"), F.xxhash64("pos", "h1", "h2").alias("x1"),
                     F.xxhash64("h2", "pos", "h1").alias("x2"), F.col("size").alias("size"))
    rows = turns.select("conv_id", F.floor(F.col("pos") / BLOCK).cast("bigint").alias("k"), where.alias("t"))
    rows = materialize(rows.groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list("t")).alias("ts"), F.expr("bit_xor(t.x1)").alias("b1"),
        F.expr("bit_xor(t.x2)").alias("b2"), F.sum("t.size").alias("b_size")), "blocks")
    rows = rows.withColumn("s", F.floor(F.col("k") / SUPER))
    before = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    supers = rows.groupBy("conv_id", "s").agg(F.expr("bit_xor(b1)").alias("b1"), F.expr("bit_xor(b2)").alias("b2"),
                                              F.sum("b_size").alias("b_size"))
    total = Window.partitionBy("conv_id")
    supers = materialize(supers.select(
        "conv_id", "s", _running("bit_xor", "b1", before).alias("s1"), _running("bit_xor", "b2", before).alias("s2"),
        _running("sum", "b_size", before).alias("s_size"), F.sum("b_size").over(total).alias("total"),
        (F.max("s").over(total) == F.col("s")).alias("s_last")), "supers")
    upto = Window.partitionBy("conv_id", "s").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("s_last") & (F.max("k").over(Window.partitionBy("conv_id", "s")) == F.col("k"))
    q = rows.join(supers, ["conv_id", "s"]).select(
        "conv_id", "k", "ts", "total", "b1", "b2", "b_size",
        _running("bit_xor", "b1", upto).bitwiseXOR(F.col("s1")).alias("q1"),
        _running("bit_xor", "b2", upto).bitwiseXOR(F.col("s2")).alias("q2"),
        (_running("sum", "b_size", upto) + F.col("s_size")).alias("q_size"), last.cast("bigint").alias("ends"))
    return q.select("conv_id", "k", "ts", "total", "ends", F.col("q1").bitwiseXOR(F.col("b1")).alias("p1"),
                    F.col("q2").bitwiseXOR(F.col("b2")).alias("p2"), "q1", "q2",
                    (F.col("q_size") - F.col("b_size")).alias("before"))


def _running(fn: str, col: str, window) -> Column:
    return F.coalesce(F.call_function(fn, F.col(col)).over(window), F.lit(0).cast("bigint"))


def _turn_rows(blocks: DataFrame, *cols: str) -> DataFrame:
    """The turns of different blocks as node rows: depth, digests of the
    prefix (r1, r2) and of its parent (u1, u2), code points before the turn."""
    first = F.struct(F.col("p1").alias("r1"), F.col("p2").alias("r2"), F.col("before").alias("upto"))
    path = F.aggregate("ts", F.array(first), lambda a, t: F.concat(a, F.array(F.struct(
        F.element_at(a, -1)["r1"].bitwiseXOR(t["x1"]).alias("r1"), F.element_at(a, -1)["r2"].bitwiseXOR(t["x2"]).alias("r2"),
        (F.element_at(a, -1)["upto"] + t["size"]).alias("upto")))))
    rows = blocks.select("*", path.alias("path")).select("*", F.posexplode("ts").alias("j", "t"))
    return rows.select(
        (F.col("t.pos") + 1).alias("depth"), F.expr("path[j + 1].r1").alias("r1"), F.expr("path[j + 1].r2").alias("r2"),
        F.expr("path[j].r1").alias("u1"), F.expr("path[j].r2").alias("u2"), F.expr("path[j].upto").alias("before"),
        F.col("t.size").alias("size"), (F.col("j") + 1 == F.size("ts")).alias("tail"), *cols)


def _piece_lists(ends: DataFrame) -> DataFrame:
    """``(depth, r1, r2, ends_sha256)`` of the conversations ending at a node:
    ids sorted by range, joined to pieces, then hashed in order."""
    key = ["depth", "r1", "r2"]
    n = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def flush():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))
                ids.clear()

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        types, names = [pa.int64()] * 4 + [pa.string()], [*key, "first", "ids"]
        for b in batches:
            for d, r1, r2, c in zip(*(x.to_pylist() for x in b.columns)):
                if (d, r1, r2) != node or len(ids) >= PIECE:
                    flush()
                    node = (d, r1, r2)
                    if len(out) >= 512:
                        yield packed()
                        out.clear()
                ids.append(c)
        flush()
        if out:
            yield packed()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            out = []
            for d, r1, r2, _, ids in zip(*(x.to_pylist() for x in b.columns)):
                if (d, r1, r2) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (d, r1, r2), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*key, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], [*key, "ends_sha256"])

    ranged = ends.select(*key, "conv_id").repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    made = ranged.mapInArrow(pieces, "depth bigint, r1 bigint, r2 bigint, first bigint, ids string")
    return made.repartition(n, *key).sortWithinPartitions(*key, "first") \
        .mapInArrow(digests, "depth bigint, r1 bigint, r2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Nodes of the prefix trie of ``turns(conv_id, pos, h1, h2, size)``, as
    made by :func:`turn_digests`; ``ids(conv_id)`` names all conversations
    where some may have no turn.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (sum over the subtree of (members - 1) x code points of
    the node's last text), ``n_ends`` and ``ends_sha256`` (of the ids of
    the conversations that end there), ``node`` and ``parent`` (hex digests).
    """
    key = ["depth", "r1", "r2"]
    everyone = turns.select("conv_id").distinct() if ids is None else ids.distinct()
    cb = materialize(_blocks(turns), "conv-blocks")

    # one row for each different block in its place
    place = ["k", "p1", "p2", "q1", "q2"]
    blocks = cb.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n"), F.sum("ends").alias("ends"), F.min(F.struct("conv_id", "total")).alias("m"),
        F.sum("total").alias("total"), F.any_value("ts").alias("ts"), F.any_value("before").alias("before"))
    blocks = materialize(blocks, "different-blocks")
    forks = blocks.groupBy("k", "p1", "p2").agg(F.count(F.lit(1)).alias("ways"))
    blocks = materialize(blocks.join(materialize(forks, "forks"), ["k", "p1", "p2"]), "placed-blocks")

    def cut(of: DataFrame, sums: dict[str, Column], *cols: str) -> DataFrame:
        """Node rows: from single ways as they are, else grouped by digest."""
        rows = _turn_rows(of, "ways", *cols)
        rows = rows.withColumn("ends", F.when(F.col("tail"), F.col("ends")).otherwise(0)) if "ends" in cols else rows
        keep = [*key, *sums]
        return rows.where("ways = 1").select(*keep).unionByName(
            rows.where("ways > 1").groupBy(*key).agg(*[c.alias(x) for x, c in sums.items()]).select(*keep))

    any_of = {x: F.any_value(x) for x in ("u1", "u2", "before", "size")}
    nodes = materialize(cut(blocks, any_of | {"n": F.sum("n"), "ends": F.sum("ends"), "m": F.min("m"),
                                              "total": F.sum("total")}, "n", "ends", "m", "total"), "nodes")

    # what a conversation owns: code points of its nodes, and whether its end is a leaf
    owned = materialize(nodes.groupBy(F.col("m.conv_id").alias("conv_id")).agg(
        F.sum("size").alias("own"), F.sum((F.col("ends") == F.col("n")).cast("bigint")).alias("leaf")), "owned")
    totals = cb.where("ends = 1").select("conv_id", "total")
    sums = cb.join(owned, "conv_id", "left").groupBy(*place).agg(
        F.sum(F.coalesce("own", F.lit(0))).alias("own"), F.sum(F.coalesce("leaf", F.lit(0))).alias("leaf"))
    sums = blocks.select(*place, "ts", "before", "ways").join(materialize(sums, "block-sums"), place)
    sums = cut(sums, {"own": F.sum("own"), "leaf": F.sum("leaf")}, "own", "leaf")

    # the root, then one grouping of node rows, their sums and their children
    root = everyone.join(totals, "conv_id", "left").join(owned, "conv_id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total").isNull().cast("bigint")).alias("ends"),
        F.min(F.struct("conv_id", F.coalesce("total", F.lit(0)).alias("total"))).alias("m"),
        F.sum(F.coalesce("total", F.lit(0))).alias("total"), F.sum(F.coalesce("own", F.lit(0))).alias("own"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("leaf")).where("n > 0")
    zero = [F.lit(0).cast("bigint").alias(x) for x in key]
    nil = lambda **types: [F.lit(None).cast(t).alias(x) for x, t in types.items()]
    pair = nodes.schema["m"].dataType
    facts = nil(u1="bigint", u2="bigint", before="bigint", size="bigint", n="bigint", ends="bigint") \
        + [F.lit(None).cast(pair).alias("m")] + nil(total="bigint")
    cols = [*key, "u1", "u2", "before", "size", "n", "ends", "m", "total", "own", "leaf", "child"]
    rows = nodes.select("*", *nil(own="bigint", leaf="bigint", child="bigint")).select(*cols)
    rows = rows.unionByName(sums.select(*key, *facts, "own", "leaf", *nil(child="bigint")).select(*cols))
    rows = rows.unionByName(nodes.select((F.col("depth") - 1).alias("depth"), F.col("u1").alias("r1"),
                                         F.col("u2").alias("r2"), *facts, *nil(own="bigint", leaf="bigint"),
                                         F.lit(1).cast("bigint").alias("child")).select(*cols))
    rows = rows.unionByName(root.select(*zero, *nil(u1="bigint", u2="bigint"), F.lit(0).cast("bigint").alias("before"),
                                        F.lit(0).cast("bigint").alias("size"), "n", "ends",
                                        F.col("m").cast(pair).alias("m"), "total", "own", "leaf",
                                        *nil(child="bigint")).select(*cols))
    most = [F.max(x).alias(x) for x in ("u1", "u2", "before", "size", "n", "ends", "m", "total", "own", "leaf")]
    full = materialize(rows.groupBy(*key).agg(*most, F.coalesce(F.sum("child"), F.lit(0)).alias("n_children")), "full")

    # turns below a node are what its members own; its smallest member owns the node and all after it
    smallest = owned.select(F.col("conv_id").alias("_c"), F.col("own").alias("m_own"))
    up = full.select((F.col("depth") + 1).alias("depth"), F.col("r1").alias("u1"), F.col("r2").alias("u2"),
                     F.col("m.conv_id").alias("parent_conv_id"))
    end_key = [F.coalesce(c, F.lit(0).cast("bigint")) for c in ("depth", "r1", "r2")]
    tip = cb.where("ends = 1").select("conv_id", (F.col("k") * BLOCK + F.size("ts")).alias("depth"),
                                      F.col("q1").alias("r1"), F.col("q2").alias("r2"))
    tips = everyone.join(tip, "conv_id", "left").select("conv_id", *[c.alias(x) for c, x in zip(end_key, key)])
    out = full.join(smallest, F.col("m.conv_id") == F.col("_c"), "left") \
        .join(up, ["depth", "u1", "u2"], "left").join(_piece_lists(tips), key, "left")
    saved = (F.col("total") - F.col("own") - (F.col("n") - 1) * F.col("before") + F.coalesce("m_own", F.lit(0))
             - F.col("m.total"))
    # a childless root is the only leaf of its tree, though nobody owns it
    leaves = F.when((F.col("depth") == 0) & (F.col("n_children") == 0), F.lit(1)).otherwise(F.col("leaf"))
    hexed = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    return out.select(
        F.col("m.conv_id").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        leaves.cast("bigint").alias("n_leaves"), saved.cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), F.col("ends").alias("n_ends"),
        hexed("r1", "r2").alias("node"), hexed("u1", "u2").alias("parent"))
