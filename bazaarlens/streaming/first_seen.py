"""First-seen de-duplication on a stream of scraped listings, with keyed state.

``readStream`` over a landing folder feeds a streaming aggregate per product
key whose state, the best row by crawl order so far, is kept in Spark's state
store (RocksDB, on the executors' disks and in the checkpoint). Rows of one key
are reduced to one per task before the shuffle, so a hot key costs one row a
task. Each micro-batch hands on only keys that are new or whose winner improved:
every row carries its batch's time stamp, and a winner that does not carry the
current one was there before. A late row that stands earlier in the crawl
replaces the winner of an earlier batch.

A batch goes to its own folder of the sink. A batch that is run again after a
failure keeps its time stamp and overwrites its folder, so each batch counts
once; a restarted query resumes offsets and state from the checkpoint. A key
stands in several batches only if its winner improved; ``read_first_seen`` drops
its earlier rows by a join with the (few) improved keys, without sorting or
de-duplicating all rows again.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bazaarlens.operators.dedup import CRAWL_ORDER, with_crawl_order
from bazaarlens.sources.schema import RAW_SCHEMA

BATCH_BYTES = 10 << 30
STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def winners(stream: DataFrame, key: str = "asin",
            order: Sequence[str] = CRAWL_ORDER) -> DataFrame:
    """Update-mode stream of the keys whose first sighting is new or improved
    in the batch: the row, and ``is_new``."""
    now = F.current_timestamp()   # one value for a whole micro-batch
    best = (with_crawl_order(stream).withColumn("_at", now).groupBy(key)
            .agg(F.min_by(F.struct(*stream.columns, "_at"), F.struct(*order)).alias("_row"),
                 F.min("_at").alias("_first")))
    return (best.filter(F.col("_row._at") == now)
            .select(*[F.col(f"_row.`{c}`") for c in stream.columns],
                    (F.col("_first") == now).alias("is_new")))


def start_first_seen(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                     schema: T.StructType = RAW_SCHEMA, key: str = "asin",
                     batch_bytes: int = BATCH_BYTES, available_now: bool = True,
                     batch_files: int | None = None) -> StreamingQuery:
    """Run the de-duplicating stream from Parquet files in ``landing``; a
    micro-batch takes files of up to ``batch_bytes``, or ``batch_files`` files."""
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"batch={number}"))

    reader = spark.readStream.schema(schema)
    reader = reader.option("maxBytesPerTrigger", batch_bytes) if batch_files is None \
        else reader.option("maxFilesPerTrigger", batch_files)
    writer = (winners(reader.parquet(landing), key).writeStream.outputMode("update")
              .foreachBatch(keep).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="10 seconds")
    before = spark.conf.get(STORE_SETTING, None)
    spark.conf.set(STORE_SETTING, STORE)   # the query keeps the setting it starts with
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(STORE_SETTING)
        else:
            spark.conf.set(STORE_SETTING, before)


def read_first_seen(spark: SparkSession, sink: str, schema: T.StructType = RAW_SCHEMA,
                    key: str = "asin") -> DataFrame:
    """The first sightings over all batches so far, all columns."""
    written = T.StructType([*schema.fields, T.StructField("is_new", T.BooleanType()),
                            T.StructField("batch", T.LongType())])
    rows = spark.read.schema(written).parquet(sink)
    last = (rows.filter(~F.col("is_new")).groupBy(F.col(key).alias("_key"))
            .agg(F.max("batch").alias("_last")))
    kept = rows.join(last, F.col(key).eqNullSafe(F.col("_key")), "left")
    return (kept.filter(F.col("_last").isNull() | (F.col("batch") == F.col("_last")))
            .select(*schema.names))
