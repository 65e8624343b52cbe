"""Run report over the crawl output (the scraper's end-of-run summary).

The crawl output can still repeat a key within one page; the report counts
those repeats, then summarises the first-seen rows. Everything is one or two
aggregates; nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.aggs import avg_round, count_where, share_pct
from bazaarlens.operators.dedup import CRAWL_ORDER, first_seen, page_counts, with_crawl_order
from bazaarlens.sources.schema import LISTING_SCHEMA

# The preview columns.
PREVIEW_COLUMNS = ["product_name", "brand", "price_inr", "discount_percent", "rating",
                   "search_keyword"]


def run_report(crawl: DataFrame, key: str = "asin") -> DataFrame:
    """One row: unique rows, repeats removed, price/rating/discount stats,
    distinct raw brands, share with a discount, sponsored/organic counts.

    The run has already left out keys of earlier pages when it removes
    duplicates, so ``duplicates_removed`` counts repeats within a page only."""
    # Rows past the page-level filter as a scalar subquery, not a join.
    rows_before = page_counts(crawl, key).agg(F.sum("new_products").cast("bigint")).scalar()
    unique = first_seen(crawl, key)
    return unique.agg(
        F.count(F.lit(1)).alias("unique_products"),
        (rows_before - F.count(F.lit(1))).alias("duplicates_removed"),
        avg_round("price_inr", 0).alias("avg_price"),
        F.min("price_inr").alias("min_price"),
        F.max("price_inr").alias("max_price"),
        avg_round("rating", 2).alias("avg_rating"),
        F.count_distinct("brand").alias("unique_brands"),
        share_pct(F.count("discount_percent"), F.count(F.lit(1)), 1).alias("pct_with_discount"),
        avg_round("discount_percent", 1).alias("avg_discount"),
        count_where(F.col("listing_type") == "Sponsored").alias("sponsored_listings"),
        count_where(F.col("listing_type") == "Organic").alias("organic_listings"))


def keyword_breakdown(crawl: DataFrame, key: str = "asin") -> DataFrame:
    return (first_seen(crawl, key).groupBy("search_keyword")
            .agg(F.count(key).alias("products")))


def report_columns() -> list[str]:
    """The columns of the run's export, in order."""
    return [f.name for f in LISTING_SCHEMA.fields]


def run_preview(crawl: DataFrame, n: int = 5, key: str = "asin") -> DataFrame:
    """First ``n`` first-seen rows in crawl order (a top-k, not a full sort)."""
    return (with_crawl_order(first_seen(crawl, key))
            .orderBy(*CRAWL_ORDER)
            .select(*PREVIEW_COLUMNS)
            .limit(n))
