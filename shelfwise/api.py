"""Application facade: the reference's public entry points
as methods over one catalogue. Single-key methods return lazy DataFrames
that read what the key needs and start no job. ``evaluate`` and ``fit`` write
intermediate tables when called."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .catalog import Catalog
from .operators import collab, evaluate, recommend, search


class Shelf:
    """Catalogue queries, recommenders and evaluation over ``catalog``."""

    def __init__(self, catalog: Catalog):
        self.catalog = catalog
        self.interactions = collab.interactions(catalog.reviews)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Shelf":
        """``initialize_data``: open a catalogue saved with ``Catalog.save``."""
        return Shelf(Catalog.load(spark, path))

    def fit(self) -> collab.SimilarityModel:
        """The whole item-item model, written to the shared folder; keep or
        ``save`` it to answer many products."""
        return collab.fit_similarity(self.catalog.reviews)

    # -- catalogue ------------------------------------------------------
    def search(self, query_type: str, **kwargs) -> DataFrame:
        return search.search(self.catalog.products, query_type, self.catalog.reviews, **kwargs)

    def category_stats(self) -> DataFrame:
        return search.category_stats(self.catalog.products)

    def product_details(self, product_id) -> DataFrame:
        return search.product_info(self.catalog.products, self.catalog.reviews, product_id)

    def user_history(self, user_id) -> DataFrame:
        return search.user_review_history(self.catalog.products, self.catalog.reviews, user_id)

    def system_info(self) -> DataFrame:
        return search.dataset_info(self.catalog.products, self.catalog.reviews)

    def copurchasers(self, user_id, product_id) -> DataFrame:
        spark = self.catalog.reviews.sparkSession
        r = self.catalog.reviews.schema
        pair = spark.createDataFrame(
            [(user_id, product_id)],
            f"customer_id {r['customer_id'].dataType.simpleString()}, "
            f"product_id {r['product_id'].dataType.simpleString()}")
        return search.copurchasers(self.catalog.reviews, pair).select("copurchasers")

    def similar_in_band(self, product_id, n: int = 10) -> DataFrame:
        spark = self.catalog.products.sparkSession
        t = spark.createDataFrame(
            [(product_id,)], "product_id " + self.catalog.products.schema["product_id"].dataType.simpleString())
        return search.similar_in_band(self.catalog.products, n, targets=t).drop("target_id")

    # -- recommenders ---------------------------------------------------
    def recommendations(self, user_id=None, product_id=None, n: int = 10) -> DataFrame:
        return recommend.get_recommendations(self.catalog.products, self.catalog.reviews, user_id, product_id, n)

    def collaborative(self, user_id=None, product_id=None, n: int = 10) -> DataFrame:
        return collab.get_collaborative_recommendations(self.interactions, self.catalog.products, user_id, product_id, n)

    def also_bought(self, product_id, n: int = 10) -> DataFrame:
        return collab.also_bought_for(self.interactions, self.catalog.products, product_id, n)

    def user_similarity(self, user1, user2) -> DataFrame:
        spark = self.catalog.reviews.sparkSession
        t = self.interactions.schema["customer_id"].dataType.simpleString()
        pair = spark.createDataFrame([(user1, user2)], f"customer1 {t}, customer2 {t}")
        return collab.user_jaccard_pairs(self.interactions, pair).select("similarity")

    # -- evaluation -----------------------------------------------------
    def evaluate(self, test_ratio: float = 0.2, k: int = 10) -> DataFrame:
        return evaluate.evaluate_user_cf(self.interactions, self.catalog.products, test_ratio, k)
