"""Data-quality checks on the raw listings.

All three are single-scan aggregates: conditional counts use ``count_if``
(0 on empty input); the reconciliation compares the two stored tables, so a
short or stale cleaned table shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.aggs import count_where
from bazaarlens.operators.clean import PRICE_HIGH, PRICE_LOW


def dq_profile(raw: DataFrame, lo=PRICE_LOW, hi=PRICE_HIGH) -> DataFrame:
    price = F.col("price_inr")
    return raw.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("asin").alias("unique_products"),
        count_where(price.isNull()).alias("missing_price"),
        count_where(F.col("rating").isNull()).alias("missing_rating"),
        count_where(F.col("total_reviews").isNull()).alias("missing_reviews"),
        count_where(price < lo).alias("suspicious_low_price"),
        count_where(price > hi).alias("suspicious_high_price"))


def dq_duplicates(raw: DataFrame, key: str = "asin", top: int = 10) -> DataFrame:
    """Most repeated keys. Partial aggregation makes a hot key cheap."""
    return (raw.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1)
            .orderBy(F.desc("occurrences"), F.asc(key))
            .limit(top))


def dq_reconcile(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows of the raw table against rows of the stored cleaned table: two
    counts, which Parquet answers from its footers."""
    n_raw = raw.select(F.count(F.lit(1))).scalar()
    return (cleaned.agg(F.count(F.lit(1)).alias("cleaned_records"))
            .select(n_raw.alias("raw_records"), "cleaned_records",
                    (n_raw - F.col("cleaned_records")).alias("rows_removed")))


def raw_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_rows"))
