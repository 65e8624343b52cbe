"""Query op13: periodic runs of whole documents, a tenth of them rewritten."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from bazaarlens.llm.runs import periodic_runs
from bazaarlens.sources.tables import read_table

NAME = "op13_periodic_runs"
ORACLE = None  # all periods of all positions are too slow in SQL: tested by brute force


def replay(doc_id, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: where crc32 of the decimal id divides by ten,
    the words from a on repeat. A null id has no number: nothing is rewritten."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs, edit=replay)
    # runs come by start, then period: only a greater exponent replaces an earlier run
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
        (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))""")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
