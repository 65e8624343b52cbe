"""Market questions over the cleaned listings (ten queries).

Each is ``cleaned -> DataFrame``; thresholds are keyword arguments with the
reference's values as defaults. Every ordered LIMIT has a total order (ties
broken on the group key or the row id) so the top-k is deterministic.
Plans: Parquet scan with pruned columns -> partial HashAggregate -> small
hash exchange -> final aggregate; top-k becomes TakeOrderedAndProject.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.aggs import avg_round, share_pct

OTHER_BRAND = "Other"
# The brands compared across price segments.
POSITIONING_BRANDS = ["Lenovo", "HP", "ASUS", "Acer", "Dell", "Apple", "MSI"]


def brand_leaderboard(cleaned: DataFrame, top: int = 10) -> DataFrame:
    return (cleaned.filter(F.col("brand") != OTHER_BRAND)
            .groupBy("brand")
            .agg(F.count(F.lit(1)).alias("total_products"),
                 avg_round("price_inr", 0).alias("avg_price"),
                 avg_round("rating", 2).alias("avg_rating"))
            .orderBy(F.desc("total_products"), F.asc("brand"))
            .limit(top))


def segment_popularity(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("price_segment")
            .agg(F.count(F.lit(1)).alias("total_products"),
                 avg_round("rating", 2).alias("avg_rating"),
                 avg_round("discount_percent", 1).alias("avg_discount"))
            .orderBy(F.desc("total_products"), F.asc_nulls_last("price_segment")))


def top_rated(cleaned: DataFrame, top: int = 10) -> DataFrame:
    return (cleaned.filter(F.col("rating").isNotNull())
            .orderBy(F.desc("rating"), F.asc("price_inr"), F.asc("id"))
            .select("product_name", "brand", "price_inr", "rating")
            .limit(top))


def brand_discount_table(cleaned: DataFrame, min_products: int = 5) -> DataFrame:
    """Average discount and saving per brand, unordered."""
    return (cleaned.filter(F.col("discount_percent").isNotNull()
                           & (F.col("brand") != OTHER_BRAND))
            .groupBy("brand")
            .agg(avg_round("discount_percent", 1).alias("avg_discount"),
                 avg_round("savings_inr", 0).alias("avg_savings_inr"),
                 F.count(F.lit(1)).alias("products"))
            .filter(F.col("products") >= min_products))


def brand_discount(cleaned: DataFrame, min_products: int = 5, top: int | None = 10) -> DataFrame:
    out = brand_discount_table(cleaned, min_products).orderBy(F.desc("avg_discount"),
                                                              F.asc("brand"))
    return out.limit(top) if top else out


def best_value(cleaned: DataFrame, min_rating: float = 4.0, min_discount: float = 15,
               top: int = 10) -> DataFrame:
    return (cleaned.filter((F.col("rating") >= min_rating)
                           & (F.col("discount_percent") >= min_discount))
            .orderBy(F.desc("discount_percent"), F.asc("id"))
            .select("product_name", "brand", "price_inr", "discount_percent", "rating")
            .limit(top))


def rating_distribution(cleaned: DataFrame) -> DataFrame:
    # The total comes from a window over the <= 5 aggregated rows, not from
    # a second scan of the table.
    counts = cleaned.groupBy("rating_category").agg(F.count(F.lit(1)).alias("products"))
    total = F.sum("products").over(Window.partitionBy())
    return (counts.select("rating_category", "products",
                          share_pct(F.col("products"), total, 1).alias("percentage"))
            .orderBy(F.desc("products"), F.asc("rating_category")))


def segment_rating(cleaned: DataFrame) -> DataFrame:
    return (cleaned.filter(F.col("rating").isNotNull())
            .groupBy("price_segment")
            .agg(F.count(F.lit(1)).alias("products"),
                 avg_round("rating", 2).alias("avg_rating"),
                 avg_round("discount_percent", 1).alias("avg_discount"),
                 F.avg("price_inr").alias("_avg_price"))
            .orderBy(F.asc("_avg_price"), F.asc_nulls_last("price_segment"))
            .drop("_avg_price"))


def listing_performance(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("listing_type")
            .agg(F.count(F.lit(1)).alias("total_products"),
                 avg_round("price_inr", 0).alias("avg_price"),
                 avg_round("rating", 2).alias("avg_rating"),
                 avg_round("discount_percent", 1).alias("avg_discount")))


def keyword_quality(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("search_keyword")
            .agg(F.count(F.lit(1)).alias("products"),
                 avg_round("price_inr", 0).alias("avg_price"),
                 avg_round("rating", 2).alias("avg_rating"),
                 avg_round("discount_percent", 1).alias("avg_discount"))
            .orderBy(F.desc_nulls_last("avg_rating"), F.asc("search_keyword")))


def brand_positioning(cleaned: DataFrame,
                      brands: Sequence[str] = POSITIONING_BRANDS) -> DataFrame:
    return (cleaned.filter(F.col("brand").isin(list(brands)))
            .groupBy("brand", "price_segment")
            .agg(F.count(F.lit(1)).alias("products"),
                 F.avg("price_inr").alias("_avg_price"))
            .orderBy(F.asc("brand"), F.asc("_avg_price"), F.asc_nulls_last("price_segment"))
            .drop("_avg_price"))
