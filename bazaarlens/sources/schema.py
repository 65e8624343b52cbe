"""Explicit schemas: the raw listing table, the cleaned table, the page archive.

Never infer: every reader passes one of these.
"""

from pyspark.sql import types as T

# 12 columns of a scraped listing, in export (CSV) order.
LISTING_FIELDS = [
    T.StructField("asin", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price_inr", T.DecimalType(10, 2)),
    T.StructField("original_price_inr", T.DecimalType(10, 2)),
    T.StructField("discount_percent", T.DecimalType(5, 2)),
    T.StructField("rating", T.DecimalType(3, 1)),
    T.StructField("total_reviews", T.IntegerType()),
    T.StructField("listing_type", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("page_scraped", T.IntegerType()),
    T.StructField("scraped_at", T.TimestampNTZType()),
]

# Scraped export (CSV/Parquet) without the surrogate key.
LISTING_SCHEMA = T.StructType(LISTING_FIELDS)

# The raw table: surrogate key first.
RAW_SCHEMA = T.StructType([T.StructField("id", T.LongType(), False)] + LISTING_FIELDS)

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

CLEANED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("asin", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price_inr", T.DecimalType(10, 2)),
    T.StructField("original_price_inr", T.DecimalType(10, 2)),
    T.StructField("discount_percent", T.DecimalType(5, 1)),
    T.StructField("savings_inr", T.DecimalType(11, 2)),
    T.StructField("rating", T.DecimalType(3, 1)),
    T.StructField("total_reviews", T.IntegerType()),
    T.StructField("price_segment", T.StringType()),
    T.StructField("discount_tier", T.StringType()),
    T.StructField("rating_category", T.StringType()),
    T.StructField("listing_type", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("scraped_at", T.TimestampNTZType()),
])

CLEANED_COLUMNS = [f.name for f in CLEANED_SCHEMA.fields]

# Archived search-result pages. http_status and fetched_at are nullable:
# archives without them classify pages on the body alone.
PAGE_ARCHIVE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
])

# One row per product card as the HTML parser sees it: raw strings only,
# NULL = tag absent, '' = tag present but empty. All typing happens in
# native columns afterwards.
CARD_FIELDS_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("asin_attr", T.StringType()),
    T.StructField("name_medium", T.StringType()),
    T.StructField("name_base_plus", T.StringType()),
    T.StructField("name_h2", T.StringType()),
    T.StructField("brand_text", T.StringType()),
    T.StructField("price_text", T.StringType()),
    T.StructField("mrp_text", T.StringType()),
    T.StructField("rating_text", T.StringType()),
    T.StructField("reviews_text", T.StringType()),
    T.StructField("sponsored", T.BooleanType()),
    T.StructField("broken", T.BooleanType()),
])
