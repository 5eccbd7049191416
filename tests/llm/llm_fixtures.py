"""Rows shared by the tests of the corpus operators."""
import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

# Names that the operators use inside; as extra columns they must not matter.
CLASHING = ("key", "h", "fp", "o", "size", "line", "_row", "_id", "taken", "names", "component", "score", "node", "cut",
            "first", "rank", "start", "sha", "rep", "n_words")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def messy_rows():
    """(doc_id, text, lang, source): nulls everywhere, empty and long texts,
    copies, near copies, repeated rows and ids, periodic texts."""
    rng = random.Random(11)
    base = [sentence(rng, rng.randrange(20, 120)) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20 + i, base[i], "en", "s0") for i in range(3)]                       # copies
    rows += [(30 + i, base[3] + f" tail{i}", "de", "s1") for i in range(4)]         # near copies
    rows += [(40, None, "en", "s0"), (41, "", None, "s1"), (42, " \n\t ", "en", None), (43, "one two", "en", "s2")]
    rows += [(None, base[5], "en", "s0"), (None, "lonely text without a number", None, None), (None, None, None, None)]
    rows += [(50, base[6], "en", "s1")] * 2                                         # a repeated row
    rows += [(51, base[7], "en", "s1"), (51, base[8], "en", "s1")]                  # a repeated id
    rows += [(60, "a " * 130, "en", "s2"), (61, "a " * 90 + base[9], "en", "s2"), (62, "x y z " * 40, "en", "s2"),
             (63, "y z x " * 50 + "end", "en", "s2")]
    rows += [(70, sentence(rng, 30000), "en", "s0")]                                # a long one
    rows += [(71, "Ünïcode ▁ mark\x00 \U0001F600 MIT license\nGNU General Public License v3\nline", "fr", "s\U00010000")]
    rows += [(72, "first line of eight good words right here\n\n" + base[10] + "\nlast", "en", "s1"),
             (73, "first line of eight good words right here\n" + base[10] + "\nmore", "en", "s1")]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    df = spark.createDataFrame(messy_rows(), "doc_id bigint, text string, lang string, source string").repartition(3)
    df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


def found(df, *cols):
    return sorted(((tuple(r[c] for c in cols)) for r in df.select(*cols).collect()), key=repr)
