"""Every entry checks its arguments; catalogues of rows at hand."""
import pytest

from shelfwise import schemas
from shelfwise.catalog import Catalog
from shelfwise.operators import collab, recommend, search


@pytest.mark.parametrize("n", [0, -3])
def test_entries_refuse_lists_without_length(shop, n):
    p, r = shop.products, shop.reviews
    inter = collab.interactions(r)
    calls = [lambda: recommend.popularity(p, n=n), lambda: recommend.popularity_per_category(p, n), lambda: recommend.content_based(p, r, n),
             lambda: recommend.content_based_for(p, r, "ada", n), lambda: recommend.hybrid(p, r, n=n), lambda: recommend.similar_products(p, n),
             lambda: collab.also_bought_bounded(inter, p, n), lambda: collab.also_bought_for(inter, p, "K-10", n),
             lambda: collab.popular_by_interactions(inter, p, n), lambda: collab.user_cf(inter, p, n),
             lambda: collab.recommend_for_users(inter, p, r.select("customer_id"), n), lambda: search.top_products(p, n=n)]
    for call in calls:
        with pytest.raises(ValueError, match="n must be positive"):
            call()
    with pytest.raises(ValueError, match="category"):
        recommend.popularity(p, 7)


def test_catalogue_of_rows(spark):
    none = Catalog.from_rows(spark)
    assert none.products.schema == schemas.PRODUCTS and none.products.count() == none.reviews.count() == 0
    assert search.best_sellers(none.products, "Book").count() == 0
    row = {f.name: None for f in schemas.REVIEWS} | {"product_id": "P", "customer_id": "U", "rating": 4.0}
    one = Catalog.from_rows(spark, reviews=[row], products=[("P",) + (None,) * (len(schemas.PRODUCTS) - 1)])
    assert collab.interactions(one.reviews).count() == one.products.count() == 1
    with pytest.raises(Exception):
        Catalog.from_rows(spark, reviews=[row | {"rating": "good"}])
