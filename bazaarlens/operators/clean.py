"""Raw listings -> cleaned listings, in one narrow projection.

Every derived column reads the **raw** inputs (a tier from the scraped
discount, a category from the scraped rating), so the whole step is a single
``select`` over the scan: one stage, no shuffle, filter pushed to Parquet.
Never chain ``withColumn`` here: a chained step would read the rewritten
column instead of the raw one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.brand import BRAND_RULES, standard_brand
from bazaarlens.functions.tiers import (DISCOUNT_TIERS, PRICE_SEGMENTS, RATING_CATEGORIES,
                                        discount_tier, price_segment, rating_category)

# Kept price range, both bounds strict.
PRICE_LOW = 5000
PRICE_HIGH = 500000
MAX_RATING = 5


def keep_condition(price: Column, name: Column, lo=PRICE_LOW, hi=PRICE_HIGH) -> Column:
    return price.isNotNull() & (price > lo) & (price < hi) & name.isNotNull()


def clean_columns(rules: Sequence = BRAND_RULES, segments=PRICE_SEGMENTS,
                  tiers=DISCOUNT_TIERS, categories=RATING_CATEGORIES) -> list[Column]:
    name, brand = F.col("product_name"), F.col("brand")
    price, mrp = F.col("price_inr"), F.col("original_price_inr")
    rating, scraped_discount = F.col("rating"), F.col("discount_percent")
    has_markdown = mrp > price
    return [
        F.col("id"),
        F.col("asin"),
        F.trim(name).alias("product_name"),
        standard_brand(name, brand, rules).alias("brand"),
        price.alias("price_inr"),
        mrp.alias("original_price_inr"),
        F.when(has_markdown, F.round((mrp - price) / mrp * 100, 1))
         .cast("decimal(5,1)").alias("discount_percent"),
        F.when(has_markdown, F.round(mrp - price, 2))
         .cast("decimal(11,2)").alias("savings_inr"),
        F.when((rating > 0) & (rating <= MAX_RATING), rating).alias("rating"),
        F.coalesce(F.col("total_reviews"), F.lit(0)).alias("total_reviews"),
        price_segment(price, segments).alias("price_segment"),
        discount_tier(scraped_discount, tiers).alias("discount_tier"),
        rating_category(rating, categories).alias("rating_category"),
        F.col("listing_type"),
        F.col("search_keyword"),
        F.col("scraped_at"),
    ]


def clean(raw: DataFrame, rules: Sequence = BRAND_RULES, segments=PRICE_SEGMENTS,
          tiers=DISCOUNT_TIERS, categories=RATING_CATEGORIES,
          lo=PRICE_LOW, hi=PRICE_HIGH, collation: str | None = None) -> DataFrame:
    """``laptops_raw`` -> ``laptops_cleaned`` (16 columns).

    ``collation='UTF8_LCASE'`` makes later grouping and comparison on brand
    case-insensitive, like a database with a case-insensitive default.
    """
    out = (raw.filter(keep_condition(F.col("price_inr"), F.col("product_name"), lo, hi))
              .select(*clean_columns(rules, segments, tiers, categories)))
    if collation:
        out = out.withColumn("brand", F.col("brand").cast(f"string collate {collation}"))
    return out


def clean_removed(raw: DataFrame, lo=PRICE_LOW, hi=PRICE_HIGH) -> DataFrame:
    """Rows the cleaning filter drops, with the first failing reason."""
    price, name = F.col("price_inr"), F.col("product_name")
    reason = (F.when(price.isNull(), F.lit("missing price"))
               .when(price <= lo, F.lit("price too low"))
               .when(price >= hi, F.lit("price too high"))
               .when(name.isNull(), F.lit("missing name")))
    return (raw.filter(~keep_condition(price, name, lo, hi))
               .select("id", "asin", "product_name", "brand", "price_inr",
                       reason.alias("reason")))
