"""Corpus pipeline: quality rules, line de-duplication, near-duplicate removal,
mixing to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's documents. All stages but the
last return the columns they were given. Documents that a stage drops are
gone for all later stages; a document that the mix takes twice appears twice.
The last stage returns, per document, its token ids and digests of ids and of
the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import bpe, linededup, mixing, neardup, quality
from bazaarlens.llm.common import drop_stored, store
from bazaarlens.sources.tables import read_table

NEAR_DUP_SHINGLE = 5   # words; similarity 0.8 or more
LINE_MIN_DOCS = 10


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(spark, docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(spark, docs, min_docs=LINE_MIN_DOCS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(spark, docs, NEAR_DUP_SHINGLE)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(spark, docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(spark, docs)
    return coded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

# SQL has no byte-pair encoding, no exact binomial cutoffs: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's table is deleted once the next
    stage's is written, so two copies of the corpus at most are stored."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_stored(spark, before)
        before = docs
    return docs
