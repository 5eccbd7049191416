"""Chat formatting in a prefix tree.

Conversations that begin with the same turns share the nodes of a tree: a
node is a turn after one certain sequence of turns. Sorted by the keys of
their nodes, the conversations follow each other depth-first, and each adds
the turns that no earlier one has: its segment. So shared turns are written
once, and all segments form one sequence (in code points). Beside a segment
stand what training needs to use the shared text: the position id of its
first code point (as if the conversation stood alone), the intervals of the
sequence that are its ancestors, which it attends to beside itself, and the
spans under the loss mask.

No tree has to be in one task: conversations are range-sorted, lengths
prefix-summed and node owners found by Spark. Turns stay rows until their
segment is written: keys and offsets are running sums over a conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import running_count
from .common import materialize

# Template: "### " role ": " text "</turn>" line feed. Escapes leave no "#"
# and no "<" in a role or text, and no ":" or line feed in a role.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
TEXT_ESCAPES = (("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n"))
LOSS_ROLE = "assistant"
BLOCK_BITS = 10         # spans are read from blocks of 2^10 code points


def _replaced(col: Column, pairs) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, col)


def escape(col: Column, pairs=TEXT_ESCAPES) -> Column:
    return _replaced(col, (("\\", "\\\\"), *pairs))


def unescape(col: Column, pairs=TEXT_ESCAPES) -> Column:
    """Inverse of ``escape``: between doubled backslashes every backslash
    starts one of the pairs."""
    parts = F.transform(F.split(col, r"\\\\", -1), lambda p: _replaced(p, [(b, a) for a, b in pairs]))
    return F.array_join(parts, "\\")


def _formatted(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role, ROLE_ESCAPES), F.lit(COLON), escape(text), F.lit(CLOSE))


def turn_nodes(turns: DataFrame) -> DataFrame:
    """``(cid, nul, pos, role, text, k1, k2, chars, upto)``: every turn with
    its conversation (nul: the id is null), its position from 0, the key of
    its node (two exclusive ors of digests of the turns up to it, each with
    its position), the code points of the formatted turn and of all up to it.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    kind = turns.schema["conv_id"].dataType
    rows = turns.select(F.coalesce("conv_id", F.lit(0).cast(kind)).alias("cid"), F.col("conv_id").isNull().alias("nul"),
                        "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("cid", "nul").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("pos", F.row_number().over(order) - 1) \
        .withColumns({"x1": F.xxhash64("pos", "role", "text"), "x2": F.xxhash64(F.lit("second"), "text", "role", "pos"),
                      "chars": F.length(_formatted(F.col("role"), F.col("text"))).cast("bigint")})
    return rows.select("cid", "nul", "pos", "role", "text", F.bit_xor("x1").over(upto).alias("k1"),
                       F.bit_xor("x2").over(upto).alias("k2"), "chars", F.sum("chars").over(upto).alias("upto"))


def format_tree(turns: DataFrame, loss_role: str = LOSS_ROLE) -> tuple[DataFrame, DataFrame]:
    """``turns(conv_id, turn, role, text)`` -> (segments, leaves).

    segments: ``(segment, text, start, end, position, attends, loss)``, one
    row for each different conversation: segment is its number in
    depth-first order, text its formatted turns that no earlier segment has,
    [start, end) their place in the sequence, position the position id of
    their start, attends the ``(segment, start, end)`` intervals of the
    turns before them, each the beginning of an earlier segment, and loss
    the spans of the sequence under the loss mask (the escaped texts of
    ``loss_role``; empty texts have none). leaves: ``(conv_id, segment)``.

    A conversation's turns go by turn (null first), then role, then text;
    repeated rows are turns of their own; a null role or text is empty. Rows
    with a null conv_id are one conversation. Other columns are ignored and
    an empty table gives no rows. Work is linear in the turns, however long a
    conversation is; the keys of its turns (32 bytes each) and the text of
    its segment must fit one row. Nodes are told apart by 128 bits.
    """
    keyed = materialize(turn_nodes(turns), "turns")
    conv = keyed.groupBy("cid", "nul").agg(F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "chars"))).alias("path"))
    conv = materialize(conv.withColumn("leaf", F.element_at("path", -1)), "paths")
    paths = conv.groupBy("leaf").agg(F.first("path").alias("path"), F.min(F.struct("nul", "cid")).alias("rep"))
    paths = materialize(running_count(paths, [], [F.col("path")], out="segment"), "paths")
    conv_id = F.when(~F.col("nul"), F.col("cid")).alias("conv_id")
    leaves = materialize(conv.select(conv_id, F.col("leaf").alias("c_leaf"))
                         .join(paths.select("leaf", "segment"), F.col("c_leaf") == F.col("leaf"))
                         .select("conv_id", "segment"), "leaves")
    each = materialize(paths.select("segment", F.inline("path")), "nodes")
    owner = materialize(each.groupBy("pos", "k1", "k2").agg(F.min("segment").alias("owner")), "owners")
    parts = materialize(each.join(owner, ["pos", "k1", "k2"]).groupBy("segment", "owner")
                        .agg(F.min("pos").alias("depth"), F.sum("chars").alias("chars")), "parts")
    own = parts.where("segment = owner").select(F.col("segment").alias("p_segment"), "depth", "chars")
    placed = materialize(running_count(own, [], [F.col("p_segment")], flag=F.col("chars"), out="start"), "placed")
    above = parts.where("segment <> owner").select(F.col("segment").alias("of"), "owner", F.col("depth").alias("at"),
                                                   F.col("chars").alias("taken")) \
        .join(placed.select("p_segment", "start"), F.col("owner") == F.col("p_segment")) \
        .groupBy("of").agg(F.sort_array(F.collect_list(F.struct("at", "owner", "start", "taken"))).alias("up"))
    attends = F.transform("up", lambda x: F.struct(x["owner"].alias("segment"), x["start"].alias("start"),
                                                   (x["start"] + x["taken"]).alias("end")))
    none = F.array().cast("array<struct<segment:bigint,start:bigint,end:bigint>>")
    places = materialize(
        paths.select("segment", "rep").join(placed, F.col("segment") == F.col("p_segment"))
        .join(above, F.col("segment") == F.col("of"), "left")
        .select("segment", F.col("rep.cid").alias("r_cid"), F.col("rep.nul").alias("r_nul"), "depth", "start",
                (F.col("start") + F.col("chars")).alias("end"),
                F.coalesce(F.aggregate("up", F.lit(0).cast("bigint"), lambda s, x: s + x["taken"]), F.lit(0))
                .alias("position"), F.coalesce(attends, none).alias("attends")), "places")
    # the text of a segment: the turns of one of its conversations that are its own
    begin = F.col("start") - F.col("position") + F.col("upto") - len(CLOSE)
    size = F.length(escape(F.col("text")))
    span = F.when((F.col("role") == loss_role) & (F.col("text") != ""),
                  F.struct((begin - size).alias("start"), begin.alias("end")))
    texts = keyed.join(places.select("segment", "r_cid", "r_nul", "depth", "start", "position"),
                       (F.col("cid") == F.col("r_cid")) & (F.col("nul") == F.col("r_nul")) & (F.col("pos") >= F.col("depth"))) \
        .select("cid", "nul", F.col("segment").alias("t_segment"),
                F.struct("pos", _formatted(F.col("role"), F.col("text")).alias("text"), span.alias("span")).alias("t")) \
        .groupBy("cid", "nul").agg(F.first("t_segment").alias("t_segment"), F.sort_array(F.collect_list("t")).alias("ts"))
    loss = F.filter(F.transform("ts", lambda t: t["span"]), lambda x: x.isNotNull())
    texts = texts.select("t_segment", F.array_join(F.transform("ts", lambda t: t["text"]), "").alias("text"),
                         loss.alias("loss"))
    segments = places.join(texts, F.col("segment") == F.col("t_segment")) \
        .select("segment", "text", "start", "end", "position", "attends", "loss")
    return materialize(segments, "segments"), leaves


def _spans_of(text: Column, spans: Column) -> Column:
    """The texts of spans (from 0) of a text. It is cut into blocks first, so
    that a span far from its start does not read all that stands before."""
    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % (1 << BLOCK_BITS)), F.lit(0))

    def one(held: Column, x: Column) -> Column:
        first, last = F.shiftright(x["start"], BLOCK_BITS), F.shiftright(x["end"] - 1, BLOCK_BITS)
        near = F.array_join(F.slice(held, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return near.substr((x["start"] - F.shiftleft(first, BLOCK_BITS) + 1).cast("int"), (x["end"] - x["start"]).cast("int"))

    # a lambda over an array of one holds the blocks, so they are cut once
    return F.flatten(F.transform(F.array(blocks), lambda held: F.transform(spans, lambda x: one(held, x))))


def read_back(segments: DataFrame, leaves: DataFrame) -> DataFrame:
    """``(conv_id, formatted, turns array<struct<role, text>>, loss_texts
    array<string>)`` of every conversation, from the written tree alone: the
    intervals that its segment attends to and the segment itself, in order;
    loss_texts are the unescaped texts under the mask."""
    last = leaves.join(segments.select(F.col("segment").alias("l_segment"), "start", "end", "attends"),
                       F.col("segment") == F.col("l_segment"))
    seen = last.select("conv_id", F.explode(F.concat("attends", F.array(F.struct("segment", "start", "end")))).alias("seen"))
    parts = seen.join(segments.select("segment", "start", "text", "loss"), F.col("seen.segment") == F.col("segment"))
    spans = F.transform(F.filter("loss", lambda x: x["end"] <= F.col("seen.end")), lambda x: F.struct(
        (x["start"] - F.col("start")).alias("start"), (x["end"] - F.col("start")).alias("end")))
    masked = F.transform(_spans_of(F.col("text"), spans), lambda x: unescape(x))
    text = F.col("text").substr(F.lit(1), (F.col("seen.end") - F.col("start")).cast("int"))
    conv = parts.select("conv_id", F.struct(F.col("start").alias("at"), text.alias("text"), masked.alias("masked")).alias("p")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    formatted = F.array_join(F.transform("p", lambda x: x["text"]), "")
    raw = F.filter(F.split("formatted", CLOSE, -1), lambda x: x != "")
    turn = lambda x: F.struct(
        unescape(F.substring_index(x.substr(F.lit(len(OPEN) + 1), F.length(x)), COLON, 1), ROLE_ESCAPES).alias("role"),
        unescape(x.substr(F.locate(COLON, x) + len(COLON), F.length(x))).alias("text"))
    return conv.select("conv_id", formatted.alias("formatted"),
                       F.flatten(F.transform("p", lambda x: x["masked"])).alias("loss_texts")) \
        .select("conv_id", "formatted", F.transform(raw, turn).alias("turns"), "loss_texts")
