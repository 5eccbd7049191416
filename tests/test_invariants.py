"""Invariants from the test strategy: partitioning never changes a result,
ingest accounts for every line, recommendations exclude owned items."""

import pytest

from conftest import SF_SMALL
from shelfwise.catalog import Catalog
from shelfwise.operators import collab, recommend, search
from shelfwise.sources import json_catalog
from shelfwise.sources.testdata import catalog_from_tables, json_lines_from_part


@pytest.fixture(scope="module")
def small(spark):
    return catalog_from_tables(spark, SF_SMALL)


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("parts", [1, 7])
def test_results_do_not_depend_on_partitioning(spark, small, parts):
    other = Catalog(small.products.repartition(parts), small.reviews.repartition(parts))
    checks = [
        lambda c: search.similar_in_band(c.products, 5),
        lambda c: recommend.content_based(c.products, c.reviews, 5),
        lambda c: recommend.similar_products(c.products, 5),
        lambda c: collab.also_bought(collab.directed_edges(collab.item_jaccard(collab.interactions(c.reviews))),
                                     c.products, 5),
    ]
    for make in checks:
        assert _rows(make(small)) == _rows(make(other))


def test_ingest_accounts_for_every_line(spark):
    lines = json_lines_from_part(spark, SF_SMALL)
    parsed = json_catalog.parse_catalog_lines(lines)
    total = lines.count()
    counts = {r.status: r.lines for r in json_catalog.ingest_counts(parsed).collect()}
    assert sum(counts.values()) == total
    accepted = json_catalog.accepted(parsed).count()
    quarantined = json_catalog.quarantine(parsed).count()
    assert accepted + quarantined + counts.get("blank", 0) == total


def test_recommendations_never_owned(small):
    inter = collab.interactions(small.reviews)
    recs = collab.user_cf(inter, small.products, 10)
    assert recs.join(inter, ["customer_id", "product_id"], "left_semi").count() == 0
    unseen = recommend.content_based(small.products, small.reviews, 10, exclude_seen=True)
    assert unseen.join(inter, ["customer_id", "product_id"], "left_semi").count() == 0
