"""Crawl progress kept per finished keyword, and resumed from it.

The checkpoint is a Parquet table partitioned by search keyword that holds the
first sightings found so far. Keywords are worked on in crawl order; the rows of
one keyword replace its partition only (dynamic partition overwrite), when its
job commits. What is finished is read from the partitions, so a run that was
stopped at any point goes on with the first keyword that has none; a keyword
without new products is looked at again, with the same result. Each keyword's
rows are reduced to one per key and tested against the keys saved so far: the
end result is ``first_seen`` of the whole crawl, whatever the number of runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.keywords import KEYWORDS
from bazaarlens.operators.dedup import first_seen
from bazaarlens.sources.schema import RAW_SCHEMA

PARTITION = "search_keyword"


def read_checkpoint(spark: SparkSession, path: str, schema=RAW_SCHEMA) -> DataFrame:
    """The rows saved so far; none if nothing was saved."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def finished_keywords(spark: SparkSession, path: str, schema=RAW_SCHEMA) -> set[str | None]:
    """Keywords that have a partition (one name per search keyword)."""
    return {r[0] for r in read_checkpoint(spark, path, schema).select(PARTITION).distinct().collect()}


def checkpoint_crawl(crawl: DataFrame, path: str, keywords: Sequence[str] = KEYWORDS,
                     key: str = "asin", at_most: int | None = None) -> list[str | None]:
    """Work on the keywords that have no partition yet, in crawl order, and save
    each when it is done; rows of other keywords (null included) come last, as one
    step. ``at_most`` ends the run after so many keywords. Returns the keywords
    worked on (None: the last step)."""
    spark = crawl.sparkSession
    done = finished_keywords(spark, path, crawl.schema)
    known = F.coalesce(F.col(PARTITION).isin(*keywords), F.lit(False))
    others = crawl.filter(~known)
    for name in done - set(keywords):
        others = others.filter(~F.col(PARTITION).eqNullSafe(F.lit(name)))
    steps = [(k, crawl.filter(F.col(PARTITION) == k)) for k in keywords if k not in done]
    steps = [*steps, (None, others)][:at_most]
    for _, rows in steps:
        seen = read_checkpoint(spark, path, crawl.schema).select(F.col(key).alias("_seen")).distinct()
        fresh = first_seen(rows, key, keywords=keywords).join(
            seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PARTITION).parquet(path))
    return [k for k, _ in steps]
