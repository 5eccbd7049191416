"""The stored catalogue returns what the plain searches return, and reads less."""
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfwise.operators import search
from shelfwise.operators.stored_catalog import StoredCatalog
from shelfwise.sources.testdata import catalog_from_tables

SCHEMA = "product_id bigint, title string, category string, price double, average_rating double, review_count bigint, sales_rank bigint"


def rows():
    rng = random.Random(2)
    words = ["Kettle", "kett", "aaaa", "tin ROBOT", "é", "", "x", "ab", "zé\U0001F600z", "banana"]
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))), rng.choice("AB"),
            round(rng.uniform(0, 50), 2), float(rng.randrange(0, 6)), rng.randrange(0, 9), rng.randrange(1, 40))
           for i in range(400)]
    out += [(1000 + i, "hot title", "A", 9.99, 4.0, 3, 7) for i in range(300)]      # equal products
    out += [(2000, None, "A", None, None, None, None), (2001, "aa", None, None, 4.0, 1, None), (2002, "y" * 20000 + "end", "B", 1.0, 1.0, 1, 1),
            (2003, "", "B", 2.0, 2.0, 2, 2), (5, "again kettle", "A", 1.0, 1.0, 1, 3)]
    return out


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()
    return df, StoredCatalog.write(df, str(tmp_path_factory.mktemp("stored") / "c"))


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("term", ["", "k", "é", "ab", "ett", "kett", "ETTLE K", "aaaaa", "anana", "nanab", "\U0001F600z", "yyyyend", "none such"])
def test_titles(both, term):
    df, stored = both
    same(stored.title_search(term), df.where(F.lower("title").contains(term.lower())).select(*df.columns))
    same(stored.search_by_title(term, 7), search.search_by_title(df, term, 7))


@pytest.mark.parametrize("low, high", [(0, 1000), (9.99, 9.99), (49, 50), (60, 70), (-5, 0.5)])
def test_prices(both, low, high):
    df, stored = both
    same(stored.price_range_search(low, high), search.price_range_search(df, low, high))
    same(stored.products_by_price_range(low, high, 9), search.products_by_price_range(df, low, high, 9))


@pytest.mark.parametrize("given", [{}, {"category": "A", "min_rating": 4}, {"max_price": 3.5, "max_salesrank": 8}, {"min_reviews": 0},
                                   {"min_rating": 5, "min_reviews": 8, "max_salesrank": 2, "max_price": 1.0}, {"max_salesrank": 0}])
def test_filters(both, given):
    df, stored = both
    same(stored.complex_query(**given), search.complex_query(df, **given))


def test_empty_catalogue(spark, tmp_path):
    stored = StoredCatalog.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "c"))
    assert stored.title_search("abc").count() == stored.price_range_search(0, 9).count() == stored.complex_query().count() == 0


def read_bytes(spark, df):
    """Bytes of the files that a query opens (metric of its scans)."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i).metrics() for i in range(leaves.size())]
        return sum(m.apply("filesSize").value() for m in found if m.contains("filesSize"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_less_is_read(spark, tmp_path):
    products = catalog_from_tables(spark, SF_SMALL.replace("0.001", "0.1")).products
    stored = StoredCatalog.write(products, str(tmp_path / "c"))
    whole = read_bytes(spark, stored.products)
    assert 0 < read_bytes(spark, stored.price_range_search(901, 903)) < whole / 1.5
    assert 0 < read_bytes(spark, stored.complex_query(min_rating=4.5, max_price=950.0, min_reviews=40)) < whole / 2
    grams = read_bytes(spark, spark.read.parquet(f"{stored.path}/grams"))
    assert 0 < read_bytes(spark, stored.matches("widget")) < grams / 4
