"""Licence scans over a positional rare-token index. Native operations only.

Each text becomes postings: (position, word) of the few words that occur in a
licence template. Document frequencies of those words over the whole corpus
order each template's key words by rarity. A template is looked up by its
rarest key word: its positions give the places where the template could
start, the postings of the other words are intersected with them, moved by
their relative positions, and the place counts when the mandatory key phrase
stands there word for word. A text that lacks one key word is never probed.
Work grows in proportion to a text's postings, however long the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# (label, phrase): the whole phrase is mandatory.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# (label, template, mandatory key phrase within it)
TEMPLATES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
MIN_SHARE = 0.5     # of a template's words that must stand in place, beside its key phrase
_BITS = 10          # a posting is position * 1024 + word number


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def postings(docs: DataFrame, vocabulary: list[str], text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, hits, present)``: hits are the codes of the words
    of the vocabulary in their order, present the numbers of these words."""
    if len(vocabulary) >= 1 << _BITS:
        raise ValueError("too many template words")
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(WORD), F.lit(0))
    number = F.create_map(*[F.lit(x) for i, w in enumerate(vocabulary) for x in (w, i)])
    found = F.filter(F.transform("words", lambda w, i: F.when(w.isin(*vocabulary), F.struct(i.alias("i"), w.alias("w")))),
                     lambda x: x.isNotNull())
    hits = F.transform(found, lambda x: F.shiftleft(x["i"].cast("bigint"), _BITS) + F.element_at(number, x["w"]))
    return docs.select(F.col(f"`{id}`").alias("doc_id"), words.alias("words")) \
        .select("doc_id", F.size("words").cast("bigint").alias("n_words"), hits.alias("hits")) \
        .withColumn("present", F.array_distinct(F.transform("hits", lambda h: h.bitwiseAND((1 << _BITS) - 1))))


def _starts(word: int, offset: int) -> Column:
    """Where something would start that has this word at this offset."""
    return F.transform(F.filter("hits", lambda h: h.bitwiseAND((1 << _BITS) - 1) == word),
                       lambda h: F.shiftright(h, _BITS) - offset)


def _labelled(name: str):
    return lambda s: F.struct(F.lit(name).alias("label"), s.alias("start"))


def _places(template: list[int], phrase: list[int], rarity: dict[int, int]) -> Column:
    """Starts of the template where its key phrase stands whole: the starts
    by its rarest word, intersected with those by each other word."""
    at = next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)
    by = sorted(range(len(phrase)), key=lambda o: (rarity[phrase[o]], phrase[o], o))
    verified = reduce(F.array_intersect, [_starts(phrase[o], at + o) for o in by])
    present = _all([F.array_contains("present", F.lit(w).cast("bigint")) for w in sorted(set(phrase))])
    return F.when(present, F.array_distinct(verified)).otherwise(F.array().cast("array<bigint>"))


def _share(places: str, template: list[int]) -> Column:
    """The largest share of the template's words that stand in place at one
    of the places: the longest run of equal starts among those by all its
    words. 0 without a place."""
    by_words = F.sort_array(F.concat(*[F.array_intersect(places, _starts(w, o)) for o, w in enumerate(template)]))
    step = lambda acc, s: F.struct(
        s.alias("start"), F.when(acc["start"] == s, acc["run"] + 1).otherwise(1).alias("run"),
        F.greatest(acc["top"], F.when(acc["start"] == s, acc["run"] + 1).otherwise(1)).alias("top"))
    none = F.struct(F.lit(None).cast("bigint").alias("start"), F.lit(0).alias("run"), F.lit(0).alias("top"))
    return F.when(F.size(places) > 0, F.aggregate(by_words, none, step, lambda acc: acc["top"]) / len(template)) \
        .otherwise(0.0)


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES, min_share: float = MIN_SHARE, text: str = "text",
         id: str = "doc_id") -> DataFrame:
    """Licences of every row of ``docs``.

    Returns ``(doc_id, n_words, places, base_labels, template_labels,
    labels, score)``: places are (label, start) of every place of a base
    phrase, labels distinct and sorted arrays, score the largest share of a
    template's words in place (1 where a base phrase stands, 0 where nothing
    does). Null and empty texts have no words, places or labels and score 0;
    very long texts are scanned whole, in linear time.
    Rows are scanned one by one, so repeated ids and null ids stay as they
    are; other columns are ignored.
    """
    lists = [(name, t.split(), p.split()) for name, t, p in [(n, p, p) for n, p in base] + list(templates)]
    vocabulary = sorted({w for _, t, _ in lists for w in t})
    number = {w: i for i, w in enumerate(vocabulary)}
    index = materialize(postings(docs, vocabulary, text, id), "postings")
    rarity = dict.fromkeys(range(len(vocabulary)), 0)
    rarity.update({int(w): n for w, n in index.select(F.explode("present").alias("w")).groupBy("w")
                   .agg(F.count(F.lit(1))).collect()})      # a row for each template word at most
    coded = [(name, [number[w] for w in t], [number[w] for w in p]) for name, t, p in lists]
    cols = {f"p{k}": _places(t, p, rarity) for k, (_, t, p) in enumerate(coded)}
    out = index.where(F.size("hits") > 0).withColumns(cols)
    k0 = len(base)
    places = F.concat(*[F.transform(f"p{k}", _labelled(coded[k][0])) for k in range(k0)])
    out = out.withColumns({f"s{k}": _share(f"p{k}", coded[k][1]) for k in range(k0, len(coded))})
    own = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(coded[k][0])) for k in range(k0)]),
                   lambda x: x.isNotNull())
    more = F.filter(F.array(*[F.when(F.col(f"s{k}") >= min_share, F.lit(coded[k][0]))
                              for k in range(k0, len(coded))]), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    out = out.select("doc_id", "n_words", places.alias("places"), F.array_sort(F.array_distinct(own)).alias("base_labels"),
                     F.array_sort(F.array_distinct(more)).alias("template_labels"),
                     F.greatest(F.when(F.size(own) > 0, 1.0).otherwise(0.0),
                                *[F.col(f"s{k}") for k in range(k0, len(coded))]).alias("score"))
    rest = index.where(F.size("hits") == 0).select(
        "doc_id", "n_words", F.array().cast("array<struct<label:string,start:bigint>>").alias("places"),
        none.alias("base_labels"), none.alias("template_labels"), F.lit(0.0).alias("score"))
    return out.unionByName(rest).withColumn(
        "labels", F.array_sort(F.array_union("base_labels", "template_labels")))
