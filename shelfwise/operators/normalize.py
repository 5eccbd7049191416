"""Normalisation of raw catalogue records to the canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_int
from ..schemas import RAW_JSON_PRODUCT

# Fixed values of the catalogue format.
DEFAULT_TITLE = "Unknown"
MISSING_TITLE = "Unknown Product"
DEFAULT_DESCRIPTION = "No description"
DEFAULT_BRAND = "Unknown"
DEFAULT_PRICE = 0.0
LOADER_CATEGORY = "Books"
PARSER_CATEGORY = "General"
DEFAULT_RANK = 9999999
RANK_KEY = "Books"
PRIOR_AVERAGE = 4.0
RELATED_KEYS = ("also_bought", "also_viewed", "bought_together")
PER_LIST = 5
MERGED_MAX = 10
TITLE_MAX = 500
CATEGORY_MAX = 100
REVIEW_DATE_MAX = 20
CUSTOMER_ID_MAX = 50


def enrich_review_stats(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """``review_count`` := count(rating) (0 if none), ``average_rating``
    := avg(rating), else the product's previous value.

    One partial+final aggregation of reviews and one left join; adaptive
    execution picks broadcast or shuffle from the measured stats size.
    """
    stats = review_stats(reviews).withColumnsRenamed(
        {"review_count": "_rc", "average_rating": "_ar"})
    return (products.join(stats, "product_id", "left")
            .withColumn("review_count", F.coalesce(F.col("_rc"), F.lit(0).cast("bigint")))
            .withColumn("average_rating", F.coalesce(F.col("_ar"), F.col("average_rating")))
            .drop("_rc", "_ar"))


def review_stats(reviews: DataFrame) -> DataFrame:
    """Per product: number of non-null ratings and their mean."""
    return reviews.groupBy("product_id").agg(
        F.count("rating").alias("review_count"),
        F.avg("rating").alias("average_rating"))


def first_category(categories: Column, default: str, max_len: int | None = None) -> Column:
    """First entry of the first category path, ``default`` when absent.

    ``get`` returns NULL out of bounds (``getItem`` raises under ANSI).
    """
    first = F.get(F.get(categories, 0), 0)
    if max_len:
        first = F.substring(first, 1, max_len)
    return F.coalesce(first, F.lit(default))


def sales_rank(sales_rank_map: Column, key: str = RANK_KEY, default: int = DEFAULT_RANK) -> Column:
    """Rank under ``key`` of the sales-rank map, else ``default``."""
    return F.coalesce(F.try_element_at(sales_rank_map, F.lit(key)), F.lit(default).cast("bigint"))


def _clean_list(c: Column) -> Column:
    return F.filter(F.coalesce(c, F.array().cast("array<string>")),
                    lambda x: x.isNotNull() & (x != F.lit("")))


def related_priority(related: Column) -> Column:
    """also_bought, else also_viewed, else bought_together, else []."""
    return F.coalesce(*[related.getField(k) for k in RELATED_KEYS], F.array().cast("array<string>"))


def related_merge(related: Column, per_list: int = PER_LIST, max_total: int = MERGED_MAX) -> Column:
    """Up to ``per_list`` non-empty ids of each list, de-duplicated in
    order of first appearance, at most ``max_total``."""
    parts = [F.slice(_clean_list(related.getField(k)), 1, per_list) for k in RELATED_KEYS]
    return F.slice(F.array_distinct(F.concat(*parts)), 1, max_total)


def category_count(categories: Column) -> Column:
    """Number of category paths, 0 when missing."""
    return F.coalesce(F.size(categories), F.lit(0))


def clamp_rating(c: Column) -> Column:
    """N10 helper: rating limited to [0, 5]; NULL stays NULL (least and
    greatest skip NULL arguments)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(5.0), c)))


def dedupe_products(products: DataFrame) -> DataFrame:
    """One row per product_id -- best sales rank, then title, then
    the remaining columns as tie-breaks (deterministic).

    A ``min`` over a (keys, row) struct per id: partial aggregation keeps
    one row per id in every map task, so an id repeated across a third of
    the input never reaches one task whole. NULL keys sort last.
    """
    rest = [c for c in products.columns if c not in ("product_id", "sales_rank", "title")]
    orderable = [c for c in rest if products.schema[c].dataType.typeName() != "map"]
    keys = [F.col("sales_rank").isNull(), F.col("sales_rank"), F.col("title").isNull(), F.col("title")]
    for c in orderable:
        keys += [F.col(c).isNull(), F.col(c)]
    packed = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)],
                      F.struct(*[F.col(c) for c in products.columns]).alias("_row"))
    best = products.groupBy("product_id").agg(F.min(packed).alias("_best"))
    return best.select(*[F.col("_best._row").getField(c).alias(c) for c in products.columns])


# Canonical columns that a source may lack: type, and value where it is NULL.
CANONICAL_FILL = {
    "title": ("string", DEFAULT_TITLE), "category": ("string", LOADER_CATEGORY),
    "sales_rank": ("bigint", DEFAULT_RANK), "image_url": ("string", ""), "description": ("string", DEFAULT_DESCRIPTION),
    "price": ("double", DEFAULT_PRICE), "brand": ("string", DEFAULT_BRAND), "similar_products": ("array<string>", None),
    "category_count": ("int", 0), "review_count": ("bigint", 0), "average_rating": ("double", PRIOR_AVERAGE),
}


def fill_canonical(df: DataFrame, **defaults) -> DataFrame:
    """The canonical products table from rows with a ``product_id``
    and any of the canonical columns. Absent and NULL values get the
    defaults (those given here first), rows without an id go, and one row
    stays for each id."""
    def filled(name: str) -> Column:
        kind, value = CANONICAL_FILL[name]
        value = defaults.get(name, value)
        default = F.array().cast(kind) if value is None else F.lit(value).cast(kind)
        return (F.coalesce(F.col(name).cast(kind), default) if name in df.columns else default).alias(name)

    rows = df.where(F.col("product_id").isNotNull() & (F.col("product_id") != ""))
    return dedupe_products(rows.select("product_id", F.col("product_id").alias("asin"),
                                       *[filled(name) for name in CANONICAL_FILL]))


def complete_raw(raw: DataFrame) -> DataFrame:
    """``raw`` with every field of the JSON catalogue schema: columns that a
    source was inferred without are typed NULLs."""
    return raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in RAW_JSON_PRODUCT.fields])


def products_from_raw(raw: DataFrame, category_default: str = LOADER_CATEGORY,
                      rank_key: str = RANK_KEY, default_rank: int = DEFAULT_RANK,
                      related_mode: str = "priority") -> DataFrame:
    """Canonical products from raw JSON catalogue rows.

    ``review_count``/``average_rating`` start at 0 / 4.0 and are replaced
    by ``enrich_review_stats`` once reviews exist.
    """
    related = related_priority if related_mode == "priority" else related_merge
    typed = complete_raw(raw).select(
        F.col("asin").alias("product_id"), "title", F.col("imUrl").alias("image_url"), "description", "price", "brand",
        first_category(F.col("categories"), category_default).alias("category"),
        sales_rank(F.col("salesRank"), rank_key, default_rank).alias("sales_rank"),
        related(F.col("related")).alias("similar_products"), category_count(F.col("categories")).alias("category_count"))
    return fill_canonical(typed, title=DEFAULT_TITLE if "title" in raw.columns else MISSING_TITLE)


def reviews_from_raw(raw: DataFrame) -> DataFrame:
    """One row per valid embedded review.

    Valid = non-empty reviewer id and integer rating in 1..5 (numbers and
    numeric strings accepted, fractions truncate). Date is cut to 20
    characters, reviewer id to 50; ``helpful`` is the first element of a
    list, or an integer, else 0.
    """
    r = F.col("_r")
    rating = safe_int(r.getField("overall"), 0)
    helpful_raw = r.getField("helpful")
    helpful = F.coalesce(
        F.get(F.from_json(helpful_raw, "array<string>"), 0).try_cast("double").try_cast("bigint"),
        helpful_raw.try_cast("bigint"),
        F.lit(0).cast("bigint"))
    exploded = raw.select(F.col("asin").alias("product_id"),
                          F.explode(F.coalesce(F.col("reviews"), F.array())).alias("_r"))
    return (exploded
            .where(F.coalesce(r.getField("reviewerID"), F.lit("")) != "")
            .withColumn("_rating", rating)
            .where(F.col("_rating").between(1, 5))
            .select(
                "product_id",
                F.substring(r.getField("reviewerID"), 1, CUSTOMER_ID_MAX).alias("customer_id"),
                F.col("_rating").cast("double").alias("rating"),
                F.substring(F.coalesce(r.getField("reviewTime"), F.lit("")), 1, REVIEW_DATE_MAX).alias("review_date"),
                helpful.alias("helpful_votes"),
                safe_int(r.getField("vote"), 0).alias("total_votes")))


def parser_products(raw: DataFrame) -> DataFrame:
    """The tolerant parser's product record.

    asin must be a non-empty string; title to string cut to 500; category
    default ``General`` cut to 100; rank from the map (missing -> 9999999);
    similar ids merged from the three related lists; product rating is the
    given rating clamped to 0..5, else (missing or 0) the mean of the
    record's valid review ratings, else 0.0. Review statistics are computed
    per record with array functions (no join, no shuffle), so duplicate
    asins keep their own reviews.
    """
    def rating_of(r):
        return safe_int(r.getField("overall"), 0)

    valid = F.filter(F.coalesce(F.col("reviews"), F.array()),
                     lambda r: (F.coalesce(r.getField("reviewerID"), F.lit("")) != "")
                     & rating_of(r).between(1, 5))
    n = F.size(valid)
    total = F.aggregate(F.transform(valid, lambda r: rating_of(r).cast("double")), F.lit(0.0),
                        lambda acc, x: acc + x)
    given = F.coalesce(clamp_rating(F.col("rating").try_cast("double")), F.lit(0.0))
    mean = F.when(n > 0, total / n).otherwise(F.lit(0.0))
    return raw.where(F.coalesce(F.col("asin"), F.lit("")) != "").select(
        F.col("asin").alias("product_id"),
        F.col("asin"),
        F.substring(F.coalesce(F.col("title"), F.lit("")), 1, TITLE_MAX).alias("title"),
        first_category(F.col("categories"), PARSER_CATEGORY, CATEGORY_MAX).alias("group"),
        sales_rank(F.col("salesRank")).alias("salesrank"),
        related_merge(F.col("related")).alias("similar"),
        category_count(F.col("categories")).alias("categories_count"),
        n.cast("bigint").alias("reviews_total"),
        n.cast("bigint").alias("reviews_downloaded"),
        F.when(given != 0.0, given).otherwise(mean).alias("avg_rating"))


def parser_to_canonical(parsed: DataFrame) -> DataFrame:
    """Map the tolerant parsers' product fields to the canonical table."""
    names = {"asin": "product_id", "group": "category", "salesrank": "sales_rank", "similar": "similar_products",
             "categories_count": "category_count", "reviews_total": "review_count", "avg_rating": "average_rating"}
    typed = parsed.select(*[F.col(old).alias(new) for old, new in names.items()], "title")
    return fill_canonical(typed, category=PARSER_CATEGORY)


def text_to_canonical(parsed: DataFrame) -> DataFrame:
    """Block-text records as the canonical products table (the format has
    the tolerant parser's field names, and no price, brand or description)."""
    return parser_to_canonical(parsed)
