"""Dense surrogate keys (1..N in a given order) without a global window.

``row_number()`` over an unpartitioned window would pull every row into one
task. Instead the rows are sorted (range-partitioned, distributed) and written
once as Parquet: file names follow the order, and a row's place inside its
file is part of the file. Counts per file become offsets, and offset plus
place is the key. Files are ordered by the numbers in their names (task, then
file of the task), not by the names, which stop sorting at 100,000 files. The
offsets table has one row per file, so broadcasting it is bounded by the number
of files, not by the data.

``keyed_load`` continues the keys over several loads of one table: each load
reserves the range after the table's high-water mark before it writes its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.session import scratch_path


def file_order(name: str) -> list[Column]:
    """Order of Spark's output files by task and file number."""
    def number(pattern: str) -> Column:
        return F.regexp_extract(name, pattern, 1).try_cast("bigint").asc_nulls_first()

    return [number(r"^part-(\d+)"), number(r"-c(\d+)[.]"), F.col(name)]


def surrogate_key(df: DataFrame, order: Sequence[str | Column], name: str = "row_id",
                  sorted_path: str | None = None, after: int = 0) -> DataFrame:
    """``sorted_path``: folder for the sorted copy, for callers that store the
    result and delete the copy; a new scratch folder by default. Keys start at
    ``after`` + 1."""
    cols = df.columns
    path = sorted_path or scratch_path(df.sparkSession, "sorted")
    df.orderBy(*order).write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select(
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"),
        *cols)
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*file_order("_file")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0))
                            .alias("_offset"))
    return (rows.join(F.broadcast(offsets), "_file")
            .select((F.col("_offset") + F.col("_at") + after + 1).cast("bigint").alias(name), *cols))


def high_water_mark(spark: SparkSession, table: str) -> int:
    """The last key handed out for ``table``; 0 before its first load."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{table}.mark")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        return 0
    return spark.read.schema("last bigint").parquet(f"{table}.mark").agg(F.max("last")).first()[0] or 0


def keyed_load(df: DataFrame, order: Sequence[str | Column], table: str,
               name: str = "row_id") -> tuple[int, int]:
    """Append ``df`` to the Parquet folder ``table`` with keys that continue
    those of earlier loads; returns the first and last key. The range is reserved
    before rows are written: a load that fails leaves a gap, never a key twice.
    Loads of one table are run one after the other."""
    spark = df.sparkSession
    after, path = high_water_mark(spark, table), scratch_path(df.sparkSession, "sorted")
    keyed = surrogate_key(df, order, name, sorted_path=path, after=after)
    last = after + spark.read.parquet(path).count()
    spark.range(1).select(F.lit(last).cast("bigint").alias("last")) \
        .write.mode("append").parquet(f"{table}.mark")
    keyed.write.mode("append").parquet(table)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return after + 1, last
