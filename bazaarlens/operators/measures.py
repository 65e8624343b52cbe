"""Published insights and dashboard measures, as tables.

Shares divide aggregated rows by the table's row count, a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.aggs import avg_round_or_zero, count_where, share_pct
from bazaarlens.operators.insights import brand_discount_table

OTHER_BRAND = "Other"
PREMIUM_MIN_PRICE = 50000
HIGH_RATING_MIN = 4.0
BELOW_AVERAGE = "Below Average"


def _total(cleaned: DataFrame):
    """Row count as a scalar subquery, which Parquet answers from its footers."""
    return cleaned.select(F.count(F.lit(1))).scalar()


def dominant_segment(cleaned: DataFrame) -> DataFrame:
    """Largest price segment and its share of all listings."""
    seg = cleaned.groupBy("price_segment").agg(F.count(F.lit(1)).alias("total_products"))
    return (seg.orderBy(F.desc("total_products"), F.asc_nulls_last("price_segment")).limit(1)
            .select("price_segment", "total_products",
                    share_pct(F.col("total_products"), _total(cleaned), 1).alias("share_pct")))


def premium_share(cleaned: DataFrame, min_price=PREMIUM_MIN_PRICE) -> DataFrame:
    return cleaned.agg(
        share_pct(count_where(F.col("price_inr") > min_price), F.count(F.lit(1)), 2)
        .alias("premium_pct"))


def discount_extremes(cleaned: DataFrame, min_products: int = 5) -> DataFrame:
    """Brands with the highest and lowest average discount (ties: brand name)."""
    per_brand = brand_discount_table(cleaned, min_products)
    avg = F.col("avg_discount")
    return per_brand.agg(
        F.min_by("brand", F.struct((-avg).alias("k"), F.col("brand"))).alias("highest_brand"),
        F.max(avg).alias("highest_avg_discount"),
        F.min_by("brand", F.struct(avg.alias("k"), F.col("brand"))).alias("lowest_brand"),
        F.min(avg).alias("lowest_avg_discount"))


def top_rated_brand(cleaned: DataFrame) -> DataFrame:
    per_brand = (cleaned.filter(F.col("brand") != OTHER_BRAND).groupBy("brand")
                 .agg(avg_round_or_zero("rating", 2).alias("avg_rating")))
    avg = F.col("avg_rating")
    return per_brand.agg(
        F.min_by("brand", F.struct((-avg).alias("k"), F.col("brand"))).alias("brand"),
        F.max(avg).alias("avg_rating"))


def below_average_share(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        share_pct(count_where(F.col("rating_category") == BELOW_AVERAGE),
                  F.count(F.lit(1)), 1).alias("below_average_pct"))


def high_rated_share(cleaned: DataFrame, min_rating=HIGH_RATING_MIN) -> DataFrame:
    return cleaned.agg(
        share_pct(count_where(F.col("rating") >= min_rating), F.count(F.lit(1)), 2)
        .alias("high_rated_pct"))


def brand_share(cleaned: DataFrame) -> DataFrame:
    """Share of listings per standardised brand (the donut chart)."""
    per_brand = cleaned.groupBy("brand").agg(F.count(F.lit(1)).alias("products"))
    return per_brand.select("brand", "products",
                            share_pct(F.col("products"), _total(cleaned), 1).alias("share_pct"))


def price_discount_points(cleaned: DataFrame) -> DataFrame:
    """Price against discount per rated product (the scatter chart)."""
    return (cleaned.filter(F.col("rating").isNotNull())
            .select("id", "brand", "price_inr",
                    F.coalesce(F.col("discount_percent"), F.lit(0)).cast("decimal(5,1)")
                    .alias("discount_percent")))
