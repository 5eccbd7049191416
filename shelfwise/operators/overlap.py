"""Top-n overlapping sets without the table of all overlapping pairs.

A table ``(set, token)`` of distinct rows holds sets: the customers of a product,
or the products of a customer. For every set the ``n`` best others are wanted,
by Jaccard similarity or by common tokens. Most overlapping pairs share one
token only, and rarely reach a list. So they are not made:

1. *Two tokens.* Small sets (at most ``small`` tokens) are joined on pairs of
   their rare tokens (held by at most ``heavy`` sets). Only sets that share two
   tokens meet. Two sets with c common rare tokens meet c(c-1)/2 times, which
   gives c: the sets are not read again.
2. *Thresholds.* The n-th best score found so far is a lower bound for the list
   of a set.
3. *The rest, by bounds.* A pair that step 1 cannot have found shares at most one
   rare token and the heavy tokens that both hold; a pair with a large set at
   most the smaller set. Pairs are joined on a token only where the score
   that this allows reaches the threshold; then all their tokens are counted.
   For common tokens, sets that share one token rank by id, so a set
   needs such partners only up to an id that the smallest holders of its
   tokens bound.

Results equal those of the full pair table, ties included. Hot tokens are joined
in chunks (every chunk of one side with every chunk of the other), and groups
of two tokens hold at most ``heavy`` sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import best_partners, whole_ids
from ..functions.columns import order_by, top_n_per_group
from ..functions.skew import DEFAULT_CHUNK, PAIRS_PER_TASK, grid_join, narrow_types
from ..session import materialize

SMALL = 128     # tokens of a set that is joined on pairs of tokens
HEAVY = 1024    # sets that hold a rare token at most
LOWEST = 8      # smallest holders of a token that bound an id


def _prepare(df: DataFrame, set_col: str, token_col: str, small: int, heavy: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(s, tok, rare)`` and the facts of every set: size ``f``, heavy
    tokens ``h`` (and which, of small sets)."""
    rows = materialize(df.select(F.col(set_col).alias("s"), F.col(token_col).alias("tok"), F.lit(True).alias("rare")), "sets")
    hot = materialize(rows.groupBy("tok").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > heavy), "heavy")
    if not hot.isEmpty():
        rows = materialize(rows.join(hot, "tok", "left").select("s", "tok", F.col("d").isNull().alias("rare")), "marked")
    facts = rows.groupBy("s").agg(F.count(F.lit(1)).alias("f"), F.count(F.when(~F.col("rare"), 1)).alias("h"))
    return rows, materialize(facts.withColumn("small", F.col("f") <= small), "facts")


def _two_token_pairs(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``(a, b, c)``, a < b: small sets that share two rare tokens or more, and
    the number of tokens they share, heavy ones included."""
    some = facts.where("small and f - h > 1")
    made = some.agg(F.sum((F.col("f") - F.col("h")) * (F.col("f") - F.col("h") - 1) / 2)).first()[0] or 0.0
    # adaptive execution sizes partitions by bytes read; these tasks make far more rows than they read
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(made / PAIRS_PER_TASK * 4) + 1)
    held = rows.where("rare").join(some.select("s"), "s", "left_semi").select("s", "tok")
    kinds = narrow_types(held, ["s", "tok"])        # the smallest types that hold the ids
    held = held.select(*[F.col(x).cast(kinds[x]).alias(x) for x in ("s", "tok")])
    lists = held.repartition(parts, "s").groupBy("s").agg(F.sort_array(F.collect_list("tok")).alias("toks"))
    at = lists.select("s", "toks", F.posexplode("toks").alias("i", "t1"))
    # the tokens after t1 travel as one list; t1 is rare, so a task gets few lists of one token
    sent = at.where(F.col("i") + 1 < F.size("toks")).select("s", "t1", F.slice("toks", F.col("i") + 2, F.size("toks")).alias("t2s"))
    two = sent.repartition(parts, "t1").select("s", "t1", F.explode("t2s").alias("t2"))
    meet = two.groupBy("t1", "t2").agg(F.sort_array(F.collect_list("s")).alias("ss"))
    meet = meet.where(F.size("ss") > 1).select("ss", F.posexplode("ss").alias("i", "a"))
    pairs = meet.select("a", F.explode(F.slice("ss", F.col("i") + 2, F.size("ss"))).alias("b")) \
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"))
    c = F.round((1 + F.sqrt(1 + 8 * F.col("m"))) / 2).cast("bigint")
    own = rows.schema["s"].dataType
    return pairs.select(F.col("a").cast(own).alias("a"), F.col("b").cast(own).alias("b"), c.alias("c"))


def _with_heavy(pairs: DataFrame, rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Add the sizes of both sets, and to c the heavy tokens both hold."""
    has = rows.where("not rare").join(facts.where("small").select("s"), "s", "left_semi") \
        .groupBy("s").agg(F.collect_list("tok").alias("hv"))
    full = facts.select("s", "f").join(has, "s", "left")
    a, b = full.toDF("a", "fa", "va"), full.toDF("b", "fb", "vb")
    shared = F.coalesce(F.size(F.array_intersect("va", "vb")), F.lit(0))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "fa", "fb", F.when(
        F.col("va").isNull() | F.col("vb").isNull(), F.col("c")).otherwise(F.col("c") + shared).alias("c"))


def _meet_on_tokens(left: DataFrame, right: DataFrame, rows: DataFrame, cond: Column,
                    chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``(a, b, c)`` for pairs of ``left(a, tok, ...)`` and ``right(b, tok, ...)``
    that share a token and satisfy ``cond``: common tokens counted."""
    met = grid_join(left, right, "tok", "a", "b", rows, chunk).where((F.col("a") != F.col("b")) & cond)
    found = F.col("small") & (F.col("r") > 1)      # small sets with two common rare tokens have met before
    return met.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("c"), F.any_value("fa").alias("fa"), F.any_value("fb").alias("fb"),
        F.count(F.when(F.col("rare"), 1)).alias("r"), F.any_value(F.col("sa") & F.col("sb")).alias("small")) \
        .where(~found).select("a", "b", "c", "fa", "fb")


def _both_ways(pairs: DataFrame) -> DataFrame:
    turn = F.array(F.struct("a", "b", "fa", "fb", "c"),
                   F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("fb").alias("fa"),
                            F.col("fa").alias("fb"), "c"))
    return pairs.select(F.inline(turn))


def _at_most() -> Column:
    """Most common tokens of a pair that two rare tokens have not joined."""
    least = F.least("fa", "fb")
    return F.when(F.col("sa") & F.col("sb"), F.least(1 + F.least("ha", "hb"), least)).otherwise(least)


def top_jaccard(df: DataFrame, set_col: str, token_col: str, n: int, eligible: DataFrame | None = None,
                small: int = SMALL, heavy: int = HEAVY, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """For every set the ``n`` others with the highest Jaccard similarity (above
    zero; ties by set) -> ``(a, b, c, similarity_score, rank)``. Only sets in
    ``eligible(<set_col>)`` stand in lists."""
    rows, facts = _prepare(df, set_col, token_col, small, heavy)
    ok = None if eligible is None else eligible.select(F.col(set_col).alias("b")).distinct()
    score = F.col("c") / (F.col("fa") + F.col("fb") - F.col("c"))
    best = order_by(("similarity_score", "desc"), ("b", "asc"))

    def ranked(pairs):
        return top_n_per_group(pairs.withColumn("similarity_score", score), ["a"], n, best)

    found = _both_ways(_with_heavy(_two_token_pairs(rows, facts), rows, facts))
    found = found if ok is None else found.join(ok, "b", "left_semi")
    found = materialize(ranked(found), "two-tokens")
    least = materialize(found.where(F.col("rank") == n).select("a", F.col("similarity_score").alias("t")), "least")

    fact = lambda x: facts.toDF(*[x if c == "s" else c[0] + x for c in facts.columns])
    need = fact("a").join(least, "a", "left").withColumn("t", F.coalesce("t", F.lit(0.0)))
    # what the best partner could reach: a set of few tokens, or the smallest large set
    large = facts.where("not small").agg(F.min("f")).first()[0]
    reach = F.least(1 + F.col("ha"), F.col("fa")) / F.col("fa")
    reach = reach if large is None else F.greatest(reach, F.col("fa") / F.lit(large))
    need = materialize(need.where(~F.col("sa") | (reach >= F.col("t"))), "open")
    left = rows.select(F.col("s").alias("a"), "tok", "rare").join(need, "a")
    right = rows.select(F.col("s").alias("b"), "tok").join(fact("b"), "b")
    right = right if ok is None else right.join(ok, "b", "left_semi")
    if whole_ids(rows, "s"):
        if need.isEmpty():
            return found.select("a", "b", "c", "similarity_score", "rank")
        asking = materialize(left.select("tok", "a", "fa"), "asking")
        met = asking.select("tok").distinct()
        met = materialize(right.select("tok", "b", "fb").join(met, "tok", "left_semi"), "met")
        rest = best_partners(asking, met, "tok", "a", "b", n, "jaccard", "fa", "fb", same=True)
        # a list left open is made anew from all its pairs
        done = found.join(need.select("a"), "a", "left_anti")
        return done.select("a", "b", "c", "similarity_score", "rank").unionByName(rest)
    u = _at_most()
    rest = _meet_on_tokens(left, right, rows, u / (F.col("fa") + F.col("fb") - u) >= F.col("t"), chunk)
    return ranked(found.select("a", "b", "c", "fa", "fb").unionByName(rest)).select("a", "b", "c", "similarity_score", "rank")


def top_common(df: DataFrame, set_col: str, token_col: str, n: int, small: int = SMALL, heavy: int = HEAVY,
               chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """For every set the ``n`` others with most common tokens (ties by set)
    -> ``(a, b, c, rank)``."""
    rows, facts = _prepare(df, set_col, token_col, small, heavy)
    best = order_by(("c", "desc"), ("b", "asc"))
    found = _both_ways(_with_heavy(_two_token_pairs(rows, facts), rows, facts))
    found = materialize(top_n_per_group(found, ["a"], n, best), "two-tokens")
    least = materialize(found.where(F.col("rank") == n).select("a", F.col("c").alias("t")), "least")

    # sets whose list is not full: an id that n smallest holders of some of its tokens do not pass
    lowest = materialize(top_n_per_group(rows.select("s", "tok"), ["tok"], LOWEST, order_by(("s", "asc")), "_r")
                         .select("tok", F.col("s").alias("b")), "lowest")
    open_ = rows.select(F.col("s").alias("a"), "tok").join(least, "a", "left_anti")
    some = top_n_per_group(open_, ["a"], small, order_by(("tok", "asc")), "_r")
    near = some.join(lowest, "tok").where(F.col("a") != F.col("b")).groupBy("a").agg(
        F.sort_array(F.collect_set("b")).alias("bs"))
    last = near.where(F.size("bs") >= n).select("a", F.element_at("bs", n).alias("upto"))

    fact = lambda x: facts.toDF(*[x if c == "s" else c[0] + x for c in facts.columns])
    need = fact("a").join(least, "a", "left").join(materialize(last, "last"), "a", "left")
    need = need.withColumn("t", F.coalesce("t", F.lit(0)))
    any_large = not facts.where("not small").isEmpty()
    need = need.where((F.col("t") < 2) | ~F.col("sa") | (F.col("ha") + 1 >= F.col("t")) | F.lit(any_large))
    left = rows.select(F.col("s").alias("a"), "tok", "rare").join(materialize(need, "open"), "a")
    right = rows.select(F.col("s").alias("b"), "tok").join(fact("b"), "b")
    u = _at_most()
    by_count = u >= F.greatest(F.col("t"), F.lit(2))
    by_id = (F.col("t") < 2) & (F.col("upto").isNull() | (F.col("b") <= F.col("upto")))
    rest = _meet_on_tokens(left, right, rows, by_count | by_id, chunk)
    every = found.select("a", "b", "c").unionByName(rest.select("a", "b", "c"))
    return top_n_per_group(every, ["a"], n, best).select("a", "b", "c", "rank")
