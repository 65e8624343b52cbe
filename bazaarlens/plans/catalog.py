"""Tables of the session catalog: created from a query, bucketed, replaced.

A replaceable table is a view over its newest version. Every version is a table
of its own, bucketed and sorted by the product key, so grouping or joining on the
key needs no exchange of the stored rows. ``replace_table`` writes the next
version and then points the view at it (one catalog change); files of earlier
versions stay until ``drop_versions``, so a reader that opened the table before
goes on. A writer that dies leaves a version that nothing points at.

Rows of one key are in one bucket, as in any hash partitioning; a task that scans
the bucket of a hot key reads it as a stream. ``buckets`` is chosen for the size of
the table (a bucket is one file).
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.operators.clean import clean
from bazaarlens.plans.materialize import _fingerprint, _lock, raw_table
from bazaarlens.session import checkpoint_root, scratch_path
from bazaarlens.sources.tables import table_path

DATABASE = "bazaarlens_tables"
KEY = "asin"
BUCKETS = 16


def _versions(spark: SparkSession, name: str) -> list[int]:
    names = [t.name for t in spark.catalog.listTables(DATABASE)]
    found = [re.fullmatch(re.escape(name.lower()) + r"__v([0-9]+)", n.lower()) for n in names]
    return sorted(int(m[1]) for m in found if m)


def replace_table(df: DataFrame, name: str, key: str = KEY, buckets: int = BUCKETS) -> DataFrame:
    """Create the table, or replace it, with the rows of ``df``."""
    spark = df.sparkSession
    home = os.path.join(checkpoint_root(spark), "catalog")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{home}'")
    number = max(_versions(spark, name), default=0) + 1
    version = f"{DATABASE}.{name}__v{number}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(spark, f"{name}__v{number}")).saveAsTable(version))
    spark.sql(f"CREATE OR REPLACE VIEW {DATABASE}.{name} AS SELECT * FROM {version}")
    return spark.table(f"{DATABASE}.{name}")


def drop_versions(spark: SparkSession, name: str, keep: int = 1) -> list[int]:
    """Drop all versions but the newest ``keep`` (at least the one in use), files
    included: for when no reader of theirs is left. Returns those dropped."""
    old = _versions(spark, name)[:-max(keep, 1)]
    for number in old:
        table = f"{DATABASE}.{name}__v{number}"
        where = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()
                 if r.col_name == "Location"]
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        for folder in where:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return old


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    name = f"{name}_{_fingerprint(spark, table_path(sf_dir, 'orders'))}"
    with _lock:
        if spark.catalog.databaseExists(DATABASE) and \
                spark.catalog.tableExists(f"{DATABASE}.{name}"):
            return spark.table(f"{DATABASE}.{name}")
        return replace_table(build(), name)


def raw_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_raw`` as a bucketed catalog table, created once per input."""
    return _once(spark, sf_dir, "laptops_raw", lambda: raw_table(spark, sf_dir))


def cleaned_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_cleaned``, created from the cleaning query, once per input."""
    return _once(spark, sf_dir, "laptops_cleaned", lambda: clean(raw_bucketed(spark, sf_dir)))
