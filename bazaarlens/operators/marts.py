"""Reporting marts: six views over the cleaned table for dashboards.

Views hold no data: ``register_marts`` defines them as temporary views over
the (materialised) cleaned table; the analyzer inlines them at read time, so
a dashboard query on a view gets the same pruned, pushed-down plan as the
underlying query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.aggs import avg_round, avg_round_or_zero, count_where

OTHER_BRAND = "Other"
MEGA_DEAL_MIN = 40
EXCELLENT_MIN = 4.5


def _zero(col: str, dtype: str):
    return F.coalesce(F.col(col), F.lit(0)).cast(dtype).alias(col)


def vw_brand_performance(cleaned: DataFrame) -> DataFrame:
    return (cleaned.filter(F.col("brand") != OTHER_BRAND)
            .groupBy("brand")
            .agg(F.count(F.lit(1)).alias("total_products"),
                 avg_round("price_inr", 0).alias("avg_price"),
                 avg_round_or_zero("rating", 2).alias("avg_rating"),
                 avg_round_or_zero("discount_percent", 1).alias("avg_discount"),
                 avg_round_or_zero("savings_inr", 0).alias("avg_savings")))


def vw_price_segments(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("price_segment")
            .agg(F.count(F.lit(1)).alias("total_products"),
                 avg_round("price_inr", 0).alias("avg_price"),
                 avg_round("rating", 2).alias("avg_rating"),
                 avg_round("discount_percent", 1).alias("avg_discount"),
                 avg_round("savings_inr", 0).alias("avg_savings")))


def vw_discount_analysis(cleaned: DataFrame) -> DataFrame:
    return (cleaned.filter(F.col("brand") != OTHER_BRAND)
            .groupBy("brand", "discount_tier")
            .agg(F.count(F.lit(1)).alias("product_count"),
                 avg_round("discount_percent", 1).alias("avg_discount"),
                 avg_round("savings_inr", 0).alias("avg_savings"),
                 F.max("discount_percent").alias("max_discount")))


def vw_top_products(cleaned: DataFrame) -> DataFrame:
    # Sorted on read by the output (raw-or-0) discount, as the view names it; the
    # id splits equal pairs over range partitions and makes the order total.
    return (cleaned.filter(F.col("rating").isNotNull())
            .select("product_name", "brand", "price_inr", "original_price_inr",
                    _zero("discount_percent", "decimal(5,1)"),
                    _zero("savings_inr", "decimal(11,2)"),
                    "rating", "rating_category", "price_segment", "discount_tier")
            .orderBy(F.desc("rating"), F.desc("discount_percent"), "id"))


def vw_kpi_summary(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_distinct("brand").alias("total_brands"),
        avg_round("price_inr", 0).alias("avg_price"),
        F.min("price_inr").alias("min_price"),
        F.max("price_inr").alias("max_price"),
        avg_round("rating", 2).alias("avg_rating"),
        avg_round("discount_percent", 1).alias("avg_discount"),
        count_where(F.col("discount_percent") >= MEGA_DEAL_MIN).alias("mega_deals"),
        count_where(F.col("rating") >= EXCELLENT_MIN).alias("excellent_products"))


def vw_all_products(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "id", "asin", "product_name", "brand", "price_inr", "original_price_inr",
        _zero("discount_percent", "decimal(5,1)"),
        _zero("savings_inr", "decimal(11,2)"),
        _zero("rating", "decimal(3,1)"),
        "total_reviews", "price_segment", "discount_tier", "rating_category",
        "listing_type", "search_keyword", "scraped_at")


MARTS = {
    "vw_brand_performance": vw_brand_performance,
    "vw_price_segments": vw_price_segments,
    "vw_discount_analysis": vw_discount_analysis,
    "vw_top_products": vw_top_products,
    "vw_kpi_summary": vw_kpi_summary,
    "vw_all_products": vw_all_products,
}


def register_marts(spark: SparkSession, cleaned: DataFrame,
                   table: str = "laptops_cleaned") -> list[str]:
    """Define (or replace) the cleaned table view and the six mart views as
    temporary views of this session."""
    cleaned.createOrReplaceTempView(table)
    base = spark.table(table)
    for name, build in MARTS.items():
        build(base).createOrReplaceTempView(name)
    return list(MARTS)


def _avg(col: str, digits: int) -> str:
    return f"CAST(round(avg({col}), {digits}) AS DOUBLE)"


def _avg0(col: str, digits: int) -> str:
    return f"CAST(round(coalesce(avg({col}), 0), {digits}) AS DOUBLE)"


def _zero_sql(col: str, dtype: str) -> str:
    return f"CAST(coalesce({col}, 0) AS {dtype}) AS {col}"


# The same views as SQL text, for the catalog: a stored view keeps its text.
MART_SQL = {
    "vw_brand_performance": f"""SELECT brand, count(*) AS total_products,
  {_avg('price_inr', 0)} AS avg_price, {_avg0('rating', 2)} AS avg_rating,
  {_avg0('discount_percent', 1)} AS avg_discount, {_avg0('savings_inr', 0)} AS avg_savings
FROM {{table}} WHERE brand != '{OTHER_BRAND}' GROUP BY brand""",
    "vw_price_segments": f"""SELECT price_segment, count(*) AS total_products,
  {_avg('price_inr', 0)} AS avg_price, {_avg('rating', 2)} AS avg_rating,
  {_avg('discount_percent', 1)} AS avg_discount, {_avg('savings_inr', 0)} AS avg_savings
FROM {{table}} GROUP BY price_segment""",
    "vw_discount_analysis": f"""SELECT brand, discount_tier, count(*) AS product_count,
  {_avg('discount_percent', 1)} AS avg_discount, {_avg('savings_inr', 0)} AS avg_savings,
  max(discount_percent) AS max_discount
FROM {{table}} WHERE brand != '{OTHER_BRAND}' GROUP BY brand, discount_tier""",
    "vw_top_products": f"""SELECT product_name, brand, price_inr, original_price_inr,
  {_zero_sql('discount_percent', 'DECIMAL(5,1)')}, {_zero_sql('savings_inr', 'DECIMAL(11,2)')},
  rating, rating_category, price_segment, discount_tier
FROM {{table}} WHERE rating IS NOT NULL
ORDER BY rating DESC, coalesce(discount_percent, 0) DESC, id""",
    "vw_kpi_summary": f"""SELECT count(*) AS total_products, count(DISTINCT brand) AS total_brands,
  {_avg('price_inr', 0)} AS avg_price, min(price_inr) AS min_price, max(price_inr) AS max_price,
  {_avg('rating', 2)} AS avg_rating, {_avg('discount_percent', 1)} AS avg_discount,
  count_if(discount_percent >= {MEGA_DEAL_MIN}) AS mega_deals,
  count_if(rating >= {EXCELLENT_MIN}) AS excellent_products
FROM {{table}}""",
    "vw_all_products": f"""SELECT id, asin, product_name, brand, price_inr, original_price_inr,
  {_zero_sql('discount_percent', 'DECIMAL(5,1)')}, {_zero_sql('savings_inr', 'DECIMAL(11,2)')},
  {_zero_sql('rating', 'DECIMAL(3,1)')}, total_reviews, price_segment, discount_tier,
  rating_category, listing_type, search_keyword, scraped_at
FROM {{table}}""",
}


def create_marts(spark: SparkSession, path: str, database: str,
                 table: str = "laptops_cleaned") -> list[str]:
    """Define (or replace) the stored cleaned table and the six views in a named
    database of the catalog: every session of the catalog reads them there.

    ``path``: folder of the stored cleaned table. Views hold no data."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    base = f"`{database}`.`{table}`"
    spark.sql(f"CREATE OR REPLACE VIEW {base} AS SELECT * FROM parquet.`{path}`")
    for name, text in MART_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text.format(table=base)}")
    return list(MART_SQL)


def list_marts(spark: SparkSession, with_counts: bool = True,
               database: str | None = None) -> DataFrame:
    """The defined mart views, each with its current row count; no rows if none
    is defined. The counts come from one union of per-view aggregates, so one
    job answers for all views."""
    where = f" IN `{database}`" if database else ""
    names = sorted(r.viewName for r in spark.sql(f"SHOW VIEWS{where}").collect()
                   if r.viewName in MARTS)
    if not with_counts:
        return spark.createDataFrame([(n,) for n in names], "view_name string")
    if not names:
        return spark.createDataFrame([], "view_name string, n_rows bigint")
    at = f"`{database}`." if database else ""
    parts = [spark.table(f"{at}{n}").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("view_name"), "n_rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
