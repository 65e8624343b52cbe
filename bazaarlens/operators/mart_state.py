"""Grouped marts kept up to date by merging partial states.

The state has one row per (brand, price segment, discount tier): row count, exact
sums and counts of every averaged measure, least and greatest values, conditional
counts. All of these merge by adding or by min/max, so a new load is reduced to
its own few group rows and merged with the rows kept; earlier listings are never
read again. The marts by brand, by segment, by brand and tier, and the headline
figures are sums over group rows.

A state is a numbered version of a folder, complete when its ``_SUCCESS`` file is
there: a reader goes on with the version it opened, a load that dies leaves the
last complete one. Loads of one state are run one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.marts import EXCELLENT_MIN, MEGA_DEAL_MIN, OTHER_BRAND

GROUP = ["brand", "price_segment", "discount_tier"]
# measure -> type of its exact average (four digits more than the measure)
MEASURES = {"price_inr": "decimal(14,6)", "rating": "decimal(7,5)",
            "discount_percent": "decimal(9,5)", "savings_inr": "decimal(15,6)"}
ADDED = ["n", "mega_deals", "excellent_products",
         *[f"{kind}_{m}" for m in MEASURES for kind in ("sum", "n")]]


def mart_state(cleaned: DataFrame) -> DataFrame:
    """The group rows of some cleaned listings."""
    sums = [f for m in MEASURES for f in (F.sum(m).cast("decimal(28,2)").alias(f"sum_{m}"),
                                          F.count(m).alias(f"n_{m}"))]
    return cleaned.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), *sums,
        F.min("price_inr").alias("min_price"), F.max("price_inr").alias("max_price"),
        F.max("discount_percent").alias("max_discount"),
        F.count_if(F.col("discount_percent") >= MEGA_DEAL_MIN).alias("mega_deals"),
        F.count_if(F.col("rating") >= EXCELLENT_MIN).alias("excellent_products"))


def merge_states(one: DataFrame, other: DataFrame) -> DataFrame:
    both = one.unionByName(other)
    added = [F.sum(c).cast(both.schema[c].dataType).alias(c) for c in ADDED]
    return both.groupBy(*GROUP).agg(
        *added, F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
        F.max("max_discount").alias("max_discount")).select(*one.columns)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v=*/_SUCCESS"))
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or ())


def read_state(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last complete version; None before the first load."""
    done = _versions(spark, folder)
    return spark.read.parquet(f"{folder}/v={done[-1]}") if done else None


def update_state(cleaned: DataFrame, folder: str) -> DataFrame:
    """Merge newly loaded listings into the state; returns the new version."""
    spark = cleaned.sparkSession
    done, new = _versions(spark, folder), mart_state(cleaned)
    kept = read_state(spark, folder)
    merged = new if kept is None else merge_states(kept, new)
    path = f"{folder}/v={done[-1] + 1 if done else 1}"
    merged.write.mode("overwrite").parquet(path)   # overwrites what a dead load left
    return spark.read.parquet(path)


def _avg(measure: str, digits: int) -> Column:
    exact = F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}")).cast(MEASURES[measure])
    return F.round(exact, digits).cast("double")


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def brand_performance(state: DataFrame) -> DataFrame:
    return state.filter(F.col("brand") != OTHER_BRAND).groupBy("brand").agg(
        F.sum("n").alias("total_products"), _avg("price_inr", 0).alias("avg_price"),
        _or_zero(_avg("rating", 2)).alias("avg_rating"),
        _or_zero(_avg("discount_percent", 1)).alias("avg_discount"),
        _or_zero(_avg("savings_inr", 0)).alias("avg_savings"))


def price_segments(state: DataFrame) -> DataFrame:
    return state.groupBy("price_segment").agg(
        F.sum("n").alias("total_products"), _avg("price_inr", 0).alias("avg_price"),
        _avg("rating", 2).alias("avg_rating"), _avg("discount_percent", 1).alias("avg_discount"),
        _avg("savings_inr", 0).alias("avg_savings"))


def discount_analysis(state: DataFrame) -> DataFrame:
    return state.filter(F.col("brand") != OTHER_BRAND).groupBy("brand", "discount_tier").agg(
        F.sum("n").alias("product_count"), _avg("discount_percent", 1).alias("avg_discount"),
        _avg("savings_inr", 0).alias("avg_savings"), F.max("max_discount").alias("max_discount"))


def kpi_summary(state: DataFrame) -> DataFrame:
    """The distinct brands are those of the group rows."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return state.agg(
        total("n").alias("total_products"), F.count_distinct("brand").alias("total_brands"),
        _avg("price_inr", 0).alias("avg_price"), F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"), _avg("rating", 2).alias("avg_rating"),
        _avg("discount_percent", 1).alias("avg_discount"), total("mega_deals").alias("mega_deals"),
        total("excellent_products").alias("excellent_products"))


STATE_MARTS = {"vw_brand_performance": brand_performance, "vw_price_segments": price_segments,
               "vw_discount_analysis": discount_analysis, "vw_kpi_summary": kpi_summary}
