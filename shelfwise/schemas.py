"""Canonical table schemas (products, reviews, interactions, similarity).

Ids are kept in whatever type the source gives them (strings for ASINs,
bigint keys in the test tables); code never casts ids.
"""

from pyspark.sql import types as T

# Canonical products table produced by every ingest path.
PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sales_rank", T.LongType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("brand", T.StringType()),
    T.StructField("similar_products", T.ArrayType(T.StringType())),
    T.StructField("category_count", T.IntegerType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("average_rating", T.DoubleType()),
])

REVIEWS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("review_date", T.DateType()),
    T.StructField("helpful_votes", T.LongType()),
    T.StructField("total_votes", T.LongType()),
])

# Raw JSON-lines catalogue record as read by the scanner. Mixed-type
# fields (``helpful`` list-or-int, ``overall`` number-or-string, ``vote``)
# are read as strings and converted with try_cast afterwards.
RAW_REVIEW = T.StructType([
    T.StructField("reviewerID", T.StringType()),
    T.StructField("overall", T.StringType()),
    T.StructField("reviewTime", T.StringType()),
    T.StructField("vote", T.StringType()),
    T.StructField("helpful", T.StringType()),
])

RAW_JSON_PRODUCT = T.StructType([
    T.StructField("asin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("imUrl", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("categories", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("salesRank", T.MapType(T.StringType(), T.LongType())),
    T.StructField("related", T.StructType([
        T.StructField("also_bought", T.ArrayType(T.StringType())),
        T.StructField("also_viewed", T.ArrayType(T.StringType())),
        T.StructField("bought_together", T.ArrayType(T.StringType())),
    ])),
    T.StructField("rating", T.StringType()),
    T.StructField("reviews", T.ArrayType(RAW_REVIEW)),
])

CORRUPT_COLUMN = "_corrupt_record"

RAW_JSON_PRODUCT_WITH_CORRUPT = T.StructType(
    RAW_JSON_PRODUCT.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])

# Block-text catalogue record after parsing (field names of that format).
TEXT_PRODUCT = T.StructType([
    T.StructField("source_id", T.LongType()),
    T.StructField("asin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("group", T.StringType()),
    T.StructField("salesrank", T.LongType()),
    T.StructField("similar", T.ArrayType(T.StringType())),
    T.StructField("categories_count", T.IntegerType()),
    T.StructField("reviews_total", T.LongType()),
    T.StructField("reviews_downloaded", T.LongType()),
    T.StructField("avg_rating", T.DoubleType()),
])
