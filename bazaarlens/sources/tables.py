"""Readers for the driver's Parquet tables and the listing table derived from them.

The test data ships no scraped listings, so ``listings_from_orders`` turns
``orders`` into ``laptops_raw``-shaped rows by a fixed, engine-neutral recipe
(one narrow projection: no shuffle, scales with ``orders``). The same column
expressions are emitted as SQL for the DuckDB oracle, so both engines start
from identical rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.sources.schema import RAW_SCHEMA

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# The derivation recipe of the test fixture (FIXTURES.md §3).
# Each pair is (output column, SQL expression over `orders`); valid in both
# Spark SQL and DuckDB. Prices are built from whole rupees and exact decimals
# so that no engine-specific double->decimal rounding enters.
_UNIT = ("CAST(floor(o_totalprice/(CASE WHEN o_orderkey%3=0 THEN 8 "
         "WHEN o_orderkey%53=0 THEN 1 ELSE 3 END)) AS DECIMAL(10,0))")

RAW_FROM_ORDERS = [
    ("id", "o_orderkey"),
    ("asin", "concat('B0', lpad(CAST(o_custkey AS VARCHAR(20)),8,'0'))"),
    ("product_name",
     "CASE WHEN o_orderkey%97=0 THEN NULL ELSE concat(' ', CASE o_orderkey%13 "
     "WHEN 0 THEN 'Apple MacBook Air' WHEN 1 THEN 'Lenovo ThinkPad E14' "
     "WHEN 2 THEN 'ideapad slim 3' WHEN 3 THEN 'Dell Inspiron 15' "
     "WHEN 4 THEN 'HP Pavilion 14' WHEN 5 THEN 'EliteBook 840' "
     "WHEN 6 THEN 'Vivobook 15' WHEN 7 THEN 'ZenBook 14' ELSE 'Laptop' END, "
     "' ', CAST(o_orderkey%500 AS VARCHAR(20)), ' ') END"),
    ("brand",
     "CASE o_orderkey%17 WHEN 0 THEN 'LENOVO' WHEN 1 THEN 'hp' WHEN 2 THEN 'Dell ' "
     "WHEN 3 THEN 'Asus' WHEN 4 THEN 'acer' WHEN 5 THEN 'MSI' WHEN 6 THEN 'Samsung' "
     "WHEN 7 THEN 'Microsoft' WHEN 8 THEN 'Alienware' WHEN 9 THEN 'AVITA' "
     "WHEN 10 THEN '15.6 inch' WHEN 11 THEN NULL WHEN 12 THEN 'Apple' "
     "WHEN 13 THEN ' Primebook ' ELSE concat(CASE WHEN o_orderkey%2=0 THEN 'Maker' "
     "ELSE 'MAKER' END, CAST(o_orderkey%5 AS VARCHAR(20))) END"),
    ("price_inr",
     "CASE WHEN o_orderkey%41=0 THEN NULL "
     "WHEN o_orderkey%211=0 THEN CAST(50000.50 AS DECIMAL(10,2)) "
     "WHEN o_orderkey%223=0 THEN CAST(5000 AS DECIMAL(10,2)) "
     f"WHEN o_orderkey%59=0 THEN CAST({_UNIT}*CAST(12 AS DECIMAL(3,0)) AS DECIMAL(10,2)) "
     f"ELSE CAST({_UNIT}+CAST(o_orderkey%4 AS DECIMAL(3,0))*CAST(0.25 AS DECIMAL(3,2)) "
     "AS DECIMAL(10,2)) END"),
    ("original_price_inr",
     f"CASE WHEN o_orderkey%9=0 THEN NULL ELSE CAST({_UNIT}"
     "*CAST(10+o_custkey%12 AS DECIMAL(3,0))*CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(10,2)) END"),
    ("discount_percent",
     "CASE WHEN o_orderkey%9=0 THEN NULL ELSE CAST((o_custkey%12)*5 AS DECIMAL(5,2)) END"),
    ("rating",
     "CASE WHEN o_orderkey%11=0 THEN NULL ELSE CAST((o_orderkey%51)*0.1 AS DECIMAL(3,1)) END"),
    ("total_reviews",
     "CASE WHEN o_orderkey%19=0 THEN NULL ELSE CAST(o_custkey%5000 AS INT) END"),
    ("listing_type",
     "CASE WHEN o_orderstatus='P' THEN 'Sponsored' ELSE 'Organic' END"),
    ("search_keyword",
     "CASE o_orderkey%7 WHEN 0 THEN 'laptops' WHEN 1 THEN 'gaming laptops' "
     "WHEN 2 THEN 'business laptops' WHEN 3 THEN 'laptops under 50000' "
     "WHEN 4 THEN 'laptops under 30000' WHEN 5 THEN 'student laptops' "
     "ELSE 'ultrabook laptops' END"),
    ("page_scraped", "CAST(o_orderkey%20+1 AS INT)"),
    ("scraped_at", "o_orderdate"),
]


def raw_from_orders_sql(source: str = "orders") -> str:
    """The recipe as one SELECT, for the oracle's ``laptops_raw`` CTE."""
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in RAW_FROM_ORDERS)
    return f"SELECT\n  {cols}\nFROM {source}"


def listings_from_orders(orders: DataFrame) -> DataFrame:
    """``orders`` -> raw listing rows (13 columns, RAW_SCHEMA types)."""
    cols = [F.expr(expr).cast(RAW_SCHEMA[name].dataType).alias(name)
            for name, expr in RAW_FROM_ORDERS]
    return orders.select(*cols)


def read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_raw`` for a test-data folder."""
    return listings_from_orders(read_table(spark, sf_dir, "orders"))
