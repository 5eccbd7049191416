"""A stored catalogue that answers searches without scanning all of it.

Layout under one folder:

* ``products`` -- the product table in folders ``_part=k``. A product's part is
  made of the first bits of its quantiles of the ``CLUSTER`` columns, interleaved
  (Z-order); files are sorted by the further bits, so row groups cover narrow
  ranges of every column at once.
* ``parts`` -- smallest and largest value of each of these columns in every
  part, a row for each. A range filter names its parts before any file is opened;
  the usual pushed-down filter then skips row groups.
* ``grams`` -- the titles' letter sequences: lower-cased trigrams with all their
  positions, and single letters and pairs with their first one, in folders by a
  hash of the sequence. A row carries the product's rank and part.

A term of three letters or more is found by its trigrams: a title holds the
term at p where it holds each trigram at p + its place in the term, so
counting the trigrams that agree on a start is the exact test, and no title is
read. Shorter terms are sequences of their own. Only the products found are
fetched, from their parts. Results equal those of ``operators.search``.

Nulls: a null title holds no term; null values of a clustering column go to
the last quantile, and no range filter matches them. Sales ranks and ids
may repeat. An empty catalogue is stored and searched like any other.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.columns import order_by, top_n
from ..session import materialize
from . import search

CLUSTER = ("price", "average_rating", "review_count", "sales_rank")
LEVELS = 4              # bits of a quantile; the first of each make the part
PART_BITS = 1
GRAM_FOLDERS = 64
ROW_GROUP = 1 << 20     # bytes of a row group, small enough to be skipped
ROWS_PER_FILE = 2_000_000


def _quantile_bits(products: DataFrame) -> dict[str, Column]:
    """The quantile (0 to 2^LEVELS - 1) of each clustering column."""
    steps = [(i + 1) / 2 ** LEVELS for i in range(2 ** LEVELS - 1)]
    cuts = products.agg(*[F.percentile_approx(c, steps, 10_000).alias(c) for c in CLUSTER]).first()
    out = {}
    for c in CLUSTER:
        above = sum([F.when(F.col(c) > F.lit(x), 1).otherwise(0) for x in cuts[c] or []], F.lit(0))
        out[c] = F.when(F.col(c).isNull(), 2 ** LEVELS - 1).otherwise(above)
    return out


def _interleaved(bits: dict[str, Column], first: int, last: int) -> Column:
    """Bits ``first`` to ``last`` (from the highest) of all columns in turn."""
    z = F.lit(0)
    for k in range(first, last):
        for c in CLUSTER:
            z = z * 2 + F.shiftright(bits[c].cast("int"), LEVELS - 1 - k).bitwiseAND(F.lit(1))
    return z.cast("int")


def _gram_rows(products: DataFrame) -> DataFrame:
    """``(gram, pos, product_id, sales_rank, _part)`` of all titles; a title is
    cut into letters once, so long titles cost in proportion."""
    letters = F.filter(F.split(F.lower("title"), ""), lambda c: c != "")
    t = products.where("title is not null").select("product_id", "sales_rank", "_part", letters.alias("cs"))
    joined = lambda i, n: F.array_join(F.slice("cs", i + 1, n), "")
    at = t.select("*", F.posexplode("cs").alias("pos", "c"))

    def grams(n):
        rows = at.where(F.col("pos") + n <= F.size("cs"))
        return rows.select("product_id", "sales_rank", "_part", "pos", joined(F.col("pos"), F.lit(n)).alias("gram"))

    short = grams(1).unionByName(grams(2)).groupBy("gram", "product_id", "sales_rank", "_part").agg(F.min("pos").alias("pos"))
    return grams(3).select("gram", "pos", "product_id", "sales_rank", "_part") \
        .unionByName(short.select("gram", "pos", "product_id", "sales_rank", "_part"))


def _folder(gram) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(GRAM_FOLDERS)).cast("int")


@dataclass(frozen=True)
class StoredCatalog:
    """Searches over a catalogue written by :meth:`write`."""

    spark: SparkSession
    path: str

    @staticmethod
    def write(products: DataFrame, path: str) -> "StoredCatalog":
        spark = products.sparkSession
        missing = [c for c in CLUSTER if c not in products.columns]
        if missing:
            raise ValueError(f"products lack the columns {missing}")
        products = materialize(products, "products")
        bits = _quantile_bits(products)
        rows = products.withColumns({"_part": _interleaved(bits, 0, PART_BITS), "_z": _interleaved(bits, PART_BITS, LEVELS)})
        rows = materialize(rows, "clustered")
        # by range, so that a part of many equal products is still written by several tasks
        rows.repartitionByRange("_part", "_z", "product_id").sortWithinPartitions("_part", "_z", "product_id").drop("_z") \
            .write.mode("overwrite").option("parquet.block.size", ROW_GROUP).option("maxRecordsPerFile", ROWS_PER_FILE) \
            .partitionBy("_part").parquet(f"{path}/products")
        products.limit(0).write.mode("overwrite").parquet(f"{path}/schema")     # an empty catalogue has no other file
        ends = [f(c).alias(f"{n}_{c}") for c in CLUSTER for n, f in (("min", F.min), ("max", F.max))]
        rows.groupBy("_part").agg(*ends).coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")
        grams = _gram_rows(rows).withColumn("_g", _folder("gram"))
        grams.repartitionByRange("_g", "gram", "product_id").sortWithinPartitions("_g", "gram", "product_id") \
            .write.mode("overwrite").option("parquet.block.size", ROW_GROUP).option("maxRecordsPerFile", ROWS_PER_FILE) \
            .partitionBy("_g").parquet(f"{path}/grams")
        return StoredCatalog(spark, path)

    @cached_property
    def _schema(self) -> StructType:
        return self.spark.read.parquet(f"{self.path}/schema").schema

    @cached_property
    def _products(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self._schema, StructField("_part", IntegerType())])) \
            .parquet(f"{self.path}/products")

    @cached_property
    def _grams(self) -> DataFrame:
        s = self._schema
        fields = [StructField("gram", StringType()), StructField("pos", IntegerType()), s["product_id"], s["sales_rank"],
                  StructField("_part", IntegerType()), StructField("_g", IntegerType())]
        return self.spark.read.schema(StructType(fields)).parquet(f"{self.path}/grams")

    @property
    def products(self) -> DataFrame:
        return self._products.drop("_part")

    @cached_property
    def _parts(self) -> list:
        """At most 2^(PART_BITS x columns) rows."""
        return self.spark.read.parquet(f"{self.path}/parts").collect()

    def within(self, **ranges: tuple) -> DataFrame:
        """Products of the parts that can hold values in the given ranges
        ``column=(low, high)``; None leaves an end open."""
        def can(part):
            for c, (low, high) in ranges.items():
                least, most = part[f"min_{c}"], part[f"max_{c}"]
                if (low is not None or high is not None) and (
                        least is None or (low is not None and most < low) or (high is not None and least > high)):
                    return False
            return True

        keep = [p["_part"] for p in self._parts if can(p)]
        return self._products.where(F.col("_part").isin(keep) if keep else F.lit(False)).drop("_part")

    def price_range_search(self, min_price: float, max_price: float) -> DataFrame:
        """Q6."""
        return search.price_range_search(self.within(price=(min_price, max_price)), min_price, max_price)

    def products_by_price_range(self, min_price: float = 0, max_price: float = 1000, n: int = search.DEFAULT_N) -> DataFrame:
        """Q8."""
        return search.products_by_price_range(self.within(price=(min_price, max_price)), min_price, max_price, n)

    def complex_query(self, category: str | None = None, min_rating: float | None = None, min_reviews: int | None = None,
                      max_salesrank: int | None = None, max_price: float | None = None) -> DataFrame:
        """Q4."""
        some = self.within(average_rating=(min_rating, None), review_count=(min_reviews, None),
                           sales_rank=(None, max_salesrank), price=(None, max_price))
        return search.complex_query(some, category, min_rating, min_reviews, max_salesrank, max_price)

    def matches(self, term: str) -> DataFrame:
        """``(product_id, sales_rank, _part)`` of the titles that hold a term of
        one letter or more, from the ``grams`` table alone."""
        term = term.lower()
        places = {}
        for i in range(max(1, len(term) - 2)):
            places.setdefault(term[i:i + 3], []).append(i)
        folders = self.spark.createDataFrame([(g,) for g in places], "gram string").select(_folder("gram")).distinct()
        rows = self._grams.where(F.col("_g").isin([r[0] for r in folders.collect()]) & F.col("gram").isin(list(places)))
        if len(term) > 3:
            shift = F.create_map(*[x for g, at in places.items() for x in (F.lit(g), F.array(*map(F.lit, at)))])
            starts = F.explode(F.transform(shift[F.col("gram")], lambda i: F.col("pos") - i)).alias("start")
            rows = rows.select("product_id", "sales_rank", "_part", starts) \
                .groupBy("product_id", "sales_rank", "_part", "start").agg(F.count(F.lit(1)).alias("n")) \
                .where(F.col("n") >= sum(map(len, places.values())))
        return rows.select("product_id", "sales_rank", "_part").distinct()

    def title_search(self, term: str) -> DataFrame:
        """Q5. Every title holds the empty term, so that reads them all."""
        if not term:
            return self.products.where("title is not null")
        found = materialize(self.matches(term).select("product_id", "_part").distinct(), "found")
        return self._of(found, term)

    def search_by_title(self, term: str, n: int = search.DEFAULT_N) -> DataFrame:
        """Q7: the best ``n`` ranks are chosen in the index, then fetched."""
        search.validate_search_parameters(n=n)
        if not term:
            return search.search_by_title(self.products, term, n)
        best = materialize(top_n(self.matches(term), n, order_by(*search.BY_RANK)), "best")
        return search.search_by_title(self._of(best, term), term, n)

    def _of(self, found: DataFrame, term: str) -> DataFrame:
        """The products found, from their parts; another product of the same
        id stays out by its title."""
        parts = [r[0] for r in found.select("_part").distinct().collect()]
        rows = self._products.where(F.col("_part").isin(parts) if parts else F.lit(False))
        rows = rows.join(found.select("product_id").distinct(), "product_id", "left_semi")
        return search.title_search(rows, term).select(*self.products.columns)
