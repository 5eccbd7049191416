import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.catalog import Catalog  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

PRODUCTS_SCHEMA = ("product_id string, title string, category string, sales_rank bigint, "
                   "similar_products array<string>, review_count bigint, average_rating double, price double")
REVIEWS_SCHEMA = ("product_id string, customer_id string, rating double, review_date date, "
                  "total_votes bigint, helpful_votes bigint")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="shelfwise-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def _day(s):
    import datetime
    return datetime.date.fromisoformat(s)


# A small shop with ties, NULLs, ids that are not in the catalogue, a customer
# who reviews a product twice and reviews without a customer or a rating.
PRODUCTS = [
    ("K-10", "Copper kettle", "Kitchen", 40, ["K-12", "G-30", "missing-1"], 6, 4.6, 31.0),
    ("K-11", "Copper pan", "Kitchen", 40, [], 2, 4.6, 18.5),
    ("K-12", "Glass jar", "Kitchen", 900, ["K-10", "K-10"], 0, 3.1, 4.0),
    ("K-13", None, "Kitchen", 2500000, None, 1, None, None),
    ("G-30", "Garden hose", "Garden", 15, ["G-31"], 14, 4.2, 22.0),
    ("G-31", "Seed KETTLE", "Garden", 310, ["missing-2"], 14, 3.9, 7.25),
    ("G-32", "Rake", "Garden", 310, [], 3, 4.9, 15.0),
    ("T-50", "Tin robot", None, 120000, ["T-50", "K-10"], 9, 2.0, 12.0),
    ("T-51", "Wooden train", "Toys", 1000000, [], 5, 4.0, 12.0),
]
REVIEWS = [
    ("K-10", "ada", 5.0, _day("2021-03-01"), 4, 4), ("K-10", "ben", 4.0, _day("2021-03-02"), 0, 0),
    ("K-10", "ada", 2.0, _day("2021-06-01"), 1, 0), ("K-11", "ada", 3.0, _day("2021-01-15"), 2, 1),
    ("G-30", "ben", 5.0, _day("2021-05-05"), 7, 2), ("G-30", "cleo", 4.0, _day("2021-05-05"), 3, 3),
    ("G-31", "cleo", 1.0, _day("2021-04-30"), 0, 0), ("G-32", "dan", 5.0, _day("2020-12-31"), 1, 1),
    ("T-51", "dan", 3.0, _day("2021-02-02"), 9, 4), ("K-10", "dan", None, _day("2021-02-03"), 0, 0),
    ("T-50", None, 4.0, _day("2021-02-04"), 2, 2), ("gone-9", "cleo", 2.0, _day("2021-04-01"), 1, 0),
]


@pytest.fixture(scope="session")
def shop(spark):
    return Catalog(spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA), spark.createDataFrame(REVIEWS, REVIEWS_SCHEMA))


def owned():
    """Plain interactions: products of each customer."""
    out = {}
    for p, c, *_ in REVIEWS:
        if p is not None and c is not None:
            out.setdefault(c, set()).add(p)
    return out


def ids(df, order="rank"):
    return [r["product_id"] for r in df.orderBy(order).collect()]


def best(key, where=lambda p: True, n=None):
    """Plain top n of the products: ids in the order of ``key``."""
    return [p[0] for p in sorted(filter(where, PRODUCTS), key=key)][:n]


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
