"""The two base tables every query runs on."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .schemas import PRODUCTS, REVIEWS


@dataclass(frozen=True)
class Catalog:
    """Immutable pair of base tables: ``products`` and ``reviews``."""

    products: DataFrame
    reviews: DataFrame

    @staticmethod
    def from_rows(spark: SparkSession, products: Iterable = (), reviews: Iterable = (),
                  products_schema: StructType | str = PRODUCTS, reviews_schema: StructType | str = REVIEWS) -> "Catalog":
        """A catalogue of rows at hand (tuples or dicts in the order or with
        the names of the schemas). The schemas are given, never guessed, so
        no rows make empty tables; values of another type raise."""
        return Catalog(spark.createDataFrame(list(products), products_schema),
                       spark.createDataFrame(list(reviews), reviews_schema))

    def save(self, path: str, mode: str = "overwrite") -> None:
        """Persist both tables as Parquet under ``path``."""
        self.products.write.mode(mode).parquet(f"{path}/products")
        self.reviews.write.mode(mode).parquet(f"{path}/reviews")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Catalog":
        return Catalog(spark.read.parquet(f"{path}/products"),
                       spark.read.parquet(f"{path}/reviews"))
