"""Shared helpers: stored intermediates, Arrow tasks, row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.session import scratch_path

# ASCII white space of the contracts: blank and U+0009 to U+000D.
WS_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

# Rows leave an Arrow task in batches of about this many bytes.
OUT_BYTES = 4 << 20


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet below ``spark.checkpoint.dir`` and read back.

    Cuts lineage (a lost executor re-reads files instead of redoing the
    work) and lets several consumers share one computation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a stored intermediate that no plan reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship() -> None:
    """Task code travels by value: executors need not have the package."""
    from pyspark import cloudpickle

    import bazaarlens
    cloudpickle.register_pickle_by_value(bazaarlens)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with task code shipped by value. Python workers are used
    again by later tasks, so a task gives its Arrow buffers back at its end."""
    ship()

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


class Rows:
    """Collects output rows and hands them on in batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, limit: int = OUT_BYTES):
        self.schema, self.limit = schema, limit
        self._reset()

    def _reset(self):
        self.cols = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, size: int, *values) -> bool:
        """True when a batch is due: call ``take``."""
        for col, v in zip(self.cols, values):
            col.append(v)
        self.bytes += size + 32
        return self.bytes >= self.limit

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(self.cols, self.schema)],
            schema=self.schema)
        self._reset()
        return out

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.cols[0]:
            yield self.take()


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Key of a document row: digest of id and text. Rows equal in both share
    a key and get the same result; rows that only share an id do not mix."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit(":"),
                          F.coalesce(F.col(text), F.lit(""))))


def guarded(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[str]]:
    """The input under names that no working column uses, the map from the
    original names, and the original names in order. Stages work on the
    guarded names and rename back, so extra input columns never clash."""
    safe = [f"in{i}_" for i in range(len(docs.columns))]
    return docs.toDF(*safe), dict(zip(docs.columns, safe)), list(docs.columns)
