"""Mixing sources to target weights along a time-varying curriculum (operator 2).

Training time runs from 0 to 1. Each source has a weight schedule over it, a
piecewise-linear density; its integral is the share of the source's target
that has been demanded by time t. Documents of a source stand in a fixed
pseudo-random order (digest of the id), pass after pass; a document whose
words start at offset o of the source's stream gets the training position
where the source's cumulative demand reaches o (the inverse of the integral).
Range-sorting all takes by position gives the training order.

A pass takes a document when the middle of its words lies within the target,
so a source's taken words differ from its target by at most half a document.
Targets never exceed two passes, so no document exceeds twice its size.

Null text has size 0; null sources sort last and are a source of their own;
null ids are allowed; rows alike in id, size and source are interchangeable,
so the result does not depend on their order. Documents of size 0 take no
words. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import WORD_CLASS, guarded, row_key, store

WEIGHTS = (5, 2, 1)          # by source in code-point order, repeating
SHARE = 1.5                  # words of the mix over words of the corpus
MAX_PASSES = 2
BLOCK_DOCS = 4_000         # documents of a source that one running sum covers

# Weight schedules (start density, end density), by source rank, repeating:
# steady, falling and rising over training time. Each integrates to 1.
SCHEDULES = ((1.0, 1.0), (1.5, 0.5), (0.5, 1.5))


def words_of(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_CLASS)).cast("bigint")


def targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """Adds rank, weight and target to (source, source_size, ...).

    Water filling in closed form: with sources sorted by cap over weight, all
    below the water level get their cap (``MAX_PASSES`` sizes) and the rest
    share what is left by weight; that is where resharing of excess ends. One
    row per source goes through the window, not documents."""
    ranked = sizes.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size") * MAX_PASSES
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    level = ((F.lit(share) * F.sum("source_size").over(whole)
              - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("weight").over(onward))
    filled = (ranked.withColumn("weight", weight).withColumn("cap", cap)
              .withColumn("level", level)
              .withColumn("open", F.col("cap") >= F.col("level") * F.col("weight")))
    water = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"),
                                                 "rank", "level"))).over(whole)["level"]
    at = F.col("water") * F.col("weight")
    return (filled.withColumn("water", water)
            .select(*sizes.columns, "rank", "weight",
                    F.when(F.col("water").isNull() | (F.col("cap") <= at),
                           F.col("cap").cast("double")).otherwise(at).alias("target")))


def inverse_demand(share_done: Column, rank: Column) -> Column:
    """Time at which a source's integrated schedule reaches ``share_done``:
    the root in [0, 1] of a*t + (b - a)*t*t/2 = share_done."""
    out = None
    for k, (a, b) in enumerate(SCHEDULES):
        slope = b - a
        root = share_done if slope == 0 else \
            (F.sqrt(F.lit(a * a) + F.lit(2 * slope) * share_done) - F.lit(a)) / F.lit(slope)
        out = F.when(rank % len(SCHEDULES) == k, root) if out is None else \
            out.when(rank % len(SCHEDULES) == k, root)
    return out


def mix(spark: SparkSession, docs: DataFrame, text: str = "text", share: float = SHARE,
        block_docs: int = BLOCK_DOCS, carry: tuple[Column, ...] = ()) -> DataFrame:
    """Per document row: doc_id, source, size, source_size, target, taken and
    ``positions`` (training time of each take, by pass).

    A running sum over a hot source would sit in one task; instead a source's
    order is cut into blocks of about ``block_docs`` documents by the leading
    bits of the order key, block totals are summed first, and the window runs
    inside blocks on top of the totals before them. ``carry``: further columns
    of the documents to keep in the result."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = store(docs.select("doc_id", "source", words_of(text).alias("size"),
                              order.alias("ord"), *carry), "mix-sized")
    carried = sized.columns[4:]
    sources = targets(sized.groupBy("source").agg(
        F.sum("size").cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("n_docs")),
        share)
    plan = store(sources.withColumn("n_blocks", F.ceil(F.col("n_docs") / block_docs)), "mix-plan")
    lead = F.conv(F.substring("ord", 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))
    placed = (sized.join(plan.select(F.col("source").alias("s"), "rank", "n_blocks", "target",
                                     "source_size"), F.col("source").eqNullSafe(F.col("s")))
              .drop("s").withColumn("block", F.floor(lead * F.col("n_blocks"))))
    totals = store(placed.groupBy("rank", "block").agg(F.sum("size").alias("block_size")),
                   "mix-blocks")
    ahead = Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("rank", "block", F.coalesce(F.sum("block_size").over(ahead),
                                                       F.lit(0)).alias("block_start"))
    inside = (Window.partitionBy("rank", "block").orderBy("ord", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = placed.withColumn("upto", F.sum("size").over(inside)).join(starts, ["rank", "block"])
    offset = F.col("block_start") + F.col("upto") - F.col("size")
    passes = []
    for k in range(MAX_PASSES):
        start = offset + F.col("source_size") * k
        taken = (F.col("size") > 0) & (start + F.col("size") / 2 <= F.col("target"))
        done = F.least(start / F.col("target"), F.lit(1.0))
        passes.append(F.when(taken, inverse_demand(done, F.col("rank"))))
    return (running.withColumn("positions", F.array_compact(F.array(*passes)))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * F.size("positions")).alias("taken"), "positions", "ord", *carried))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per take, range-sorted by training position."""
    takes = mixed.select("doc_id", "source", "size", "ord",
                         F.posexplode("positions").alias("pass", "position"))
    return takes.orderBy("position", "ord", "pass")


def mix_documents(spark: SparkSession, docs: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents as the mix takes them: a document taken twice appears
    twice, one not taken is left out; range-sorted by training position.

    Takes find their rows by a digest of id, source and text. Alike rows share
    the digest, and the n-th of them gets the n-th take list. The text is
    shuffled by digest and then by position, nothing else moves it."""
    safe, name, cols = guarded(docs)
    source = F.coalesce(F.concat(F.lit("="), F.col(name["source"])), F.lit("-"))
    rk = F.md5(F.concat(row_key(name["doc_id"], name["text"]), source))
    plain = safe.select(F.col(name["doc_id"]).alias("doc_id"),
                        F.col(name["source"]).alias("source"), F.col(name["text"]).alias("text"),
                        rk.alias("rk"))
    plans = (mix(spark, plain, share=share, carry=(F.col("rk"),))
             .groupBy("rk", "ord").agg(F.collect_list("positions").alias("lists")))
    nth = F.row_number().over(Window.partitionBy("rk").orderBy("rk")) - 1
    rows = safe.withColumn("rk", rk).withColumn("nth", nth)
    takes = (rows.join(store(plans, "mix-takes").hint("shuffle_hash"), "rk")
             .select(*safe.columns, "ord", F.posexplode(F.get("lists", "nth"))
                     .alias("pass", "position"))
             .orderBy("position", "ord", "pass"))
    return takes.select(*[F.col(name[c]).alias(c) for c in cols])
