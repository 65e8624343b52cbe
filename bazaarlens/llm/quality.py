"""Quality rules with risk-controlled cutoffs (operator 8).

``features`` measures every whole text. ``learn_cutoffs`` picks the cutoffs of a
stratum (language) from labelled holdouts and certifies all rules together: the
exact binomial test must reject "the rules discard more than ``alpha_total`` of
the good documents of this stratum" at level ``delta`` divided by the strata.

Order of the tests. A path leads from "all rules off" to one target cutoff per
rule, a grid step at a time, the rule with the largest gain first. The targets
are learned from the bad documents and one good document in ``ORDER_SHARE`` (by
digest of the id). The other good documents, which had no part in the path, test
its points from the loosest on; the first point that is not certified ends the
sequence, so the level needs no division by points or rules. Among certified
points the one with the best ``bad rejected - cost * good rejected`` is used.

Strata. With n good documents to test with, a stratum can certify a point only
if ``(1 - alpha_total)^n`` is at most its level. The level is divided by the strata
that can, so rare languages do not weaken the others; in a stratum that cannot,
only the base rule applies.

Null text has no words (base rule fails it); null and empty languages are one
stratum; repeated labels of a document count once, good if any says good;
null labels are ignored; repeated documents are measured one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.common import arrow_map, guarded, ship, store

SYMBOLS = b"#*$%&|<>"
WS = b" \t\n\x0b\x0c\r"

ORDER_SHARE = 10   # one good label in so many orders the tests and takes no part in them

# rule -> (numerator, denominator, width of a grid step); a document's grid
# index is floor(ratio / step), at most GRID
RULES = {
    "symbols": ("n_symbols", "word_chars", 0.01),
    "dup_lines": ("n_dup_lines", "n_text_lines", 0.01),
    "repeats": ("n_repeat_words", "n_words", 0.01),
    "word_length": ("word_chars", "n_words", 0.25),
}
GRID = 100
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_text_lines")


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    _, pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)
    _, tri, count = np.unique(pair[:-1] * np.int64(len(ids)) + w[2:],
                              return_inverse=True, return_counts=True)
    hit = count[tri] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def measure(text: bytes, n_chars: int) -> tuple[int, ...]:
    """The MEASURES of one UTF-8 text of ``n_chars`` code points."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), n_chars - (len(text) - len(text.translate(None, WS))),
            len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines))


def features(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` columns (default: all) plus one long column per measure."""
    keep = list(docs.columns) if keep is None else keep
    fields = [f for f in docs.schema.fields if f.name in keep]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                    + [f"{m} bigint" for m in MEASURES])
    src = docs.select(*[F.col(f"`{f.name}`") for f in fields],
                      F.col(text).alias("__measured"))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            raw = texts.cast(pa.binary())
            chars = pc.utf8_length(texts)
            rows = [(0,) * len(MEASURES) if not raw[i].is_valid
                    else measure(raw[i].as_py(), chars[i].as_py()) for i in range(len(raw))]
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + cols, names=batch.schema.names[:-1] + list(MEASURES))

    return arrow_map(src, run, ddl)


def base_failed() -> Column:
    """Fixed values of the contract: fewer than 50 words, or more than half
    of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum(lang: str = "lang") -> Column:
    return F.coalesce(F.col(lang), F.lit(""))


def grid_index(rule: str) -> Column:
    top, bottom, step = RULES[rule]
    ratio = F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))
    return F.least(F.floor(ratio / F.lit(step)), F.lit(GRID)).cast("int")


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact sum of the terms in logarithms."""
    i = np.arange(k + 1)
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    terms = (log_fact[n] - log_fact[i] - log_fact[n - i]
             + i * math.log(p) + (n - i) * math.log1p(-p))
    top = terms.max()
    return min(1.0, float(np.exp(terms - top).sum() * math.exp(top)))


def choose_cutoff(good: np.ndarray, bad: np.ndarray, alpha: float, level: float,
                  cost: float) -> int | None:
    """Best certified grid index c (reject index > c), or None.

    ``good`` and ``bad`` count labelled documents per grid index."""
    n = int(good.sum())
    rejected_good = n - np.cumsum(good)
    rejected_bad = int(bad.sum()) - np.cumsum(bad)
    best, best_gain = None, 0.0
    for c in range(len(good) - 1, -1, -1):
        k = int(rejected_good[c])
        if n == 0 or k > alpha * n or binomial_cdf(k, n, alpha) > level:
            break  # the sequence of tests ends here
        gain = float(rejected_bad[c]) - cost * k
        if gain > best_gain:
            best, best_gain = c, gain
    return best


def plan_path(good: dict[str, np.ndarray], bad: dict[str, np.ndarray],
              cost: float) -> list[tuple[str, int]]:
    """(rule, target cutoff), largest gain first; rules without gain are left
    out. Of cutoffs with the same gain the loosest is the target."""
    found = []
    for r in RULES:
        gain = (int(bad[r].sum()) - np.cumsum(bad[r])
                - cost * ORDER_SHARE * (int(good[r].sum()) - np.cumsum(good[r])))
        target = max(range(GRID + 1), key=lambda c: (gain[c], c))
        if gain[target] > 0:
            found.append((-float(gain[target]), r, target))
    return [(r, target) for _, r, target in sorted(found)]


def certifiable(n: int, sizes: list[int], alpha: float, delta: float) -> bool:
    """Whether n good labels can certify anything when the level is divided by
    the strata with at least as many."""
    rank = max(1, sum(x >= n for x in sizes))
    return n * math.log1p(-alpha) <= math.log(delta / rank)


def learn_cutoffs(measured: DataFrame, labels: DataFrame, alpha_total: float = 0.01,
                  delta: float = 0.05, cost: float = 20.0) -> DataFrame:
    """(stratum, rule, cutoff, good, good_rejected, bad, bad_rejected); the
    counts are of all rules together, good ones of the documents tested with.

    The holdout is joined on doc_id and reduced twice, map side first: to
    counts per (stratum, rule, grid index), which give the path, and per
    (stratum, first point of the path that rejects the document), which
    certify its points. Only those counts meet in a task, at most
    rules x (GRID + 1) rows per stratum. Documents that the base rule fails
    are not part of the holdout: the verdict never reaches them."""
    truth = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    digest = F.crc32(F.concat(F.lit("order:"), F.col("doc_id").cast("string")).cast("binary"))
    good = F.col("quality") >= 1
    held = store(
        measured.filter(~base_failed())
        .select("doc_id", stratum().alias("stratum"),
                *[grid_index(r).alias(f"i_{r}") for r in RULES])
        .join(truth, "doc_id")
        .select("stratum", *[f"i_{r}" for r in RULES], (~good).cast("int").alias("bad"),
                (good & (digest % ORDER_SHARE == 0)).cast("int").alias("orders"),
                (good & (digest % ORDER_SHARE != 0)).cast("int").alias("tests")),
        "quality-held")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = {}
        for kind in ("orders", "bad"):
            counts[kind] = {r: np.zeros(GRID + 1, np.int64) for r in RULES}
            for r, i, n in zip(pdf["rule"], pdf["idx"], pdf[kind]):
                counts[kind][r][i] = n
        row = {"stratum": pdf["stratum"].iloc[0], "points": 0}
        row |= {f"{x}_{r}": v for r in RULES for x, v in (("off", 0), ("to", GRID))}
        for r, target in plan_path(counts["orders"], counts["bad"], cost):
            row[f"off_{r}"], row[f"to_{r}"] = row["points"], target
            row["points"] += GRID - target
        return pd.DataFrame([row])

    pairs = ", ".join(f"'{r}', i_{r}" for r in RULES)
    fields = ["points"] + [f"{x}_{r}" for r in RULES for x in ("off", "to")]
    ship()
    path = store(
        held.selectExpr("stratum", "orders", "bad",
                        f"stack({len(RULES)}, {pairs}) as (rule, idx)")
        .groupBy("stratum", "rule", "idx")
        .agg(F.sum("orders").alias("orders"), F.sum("bad").alias("bad"))
        .groupBy("stratum")
        .applyInPandas(plan, "stratum string, " + ", ".join(f"{x} int" for x in fields)),
        "quality-path")

    # the first point that rejects a document, counted from the end; 0: none does
    point = F.least(*[F.when(F.col(f"i_{r}") > F.col(f"to_{r}"),
                             F.col(f"off_{r}") + GRID - F.col(f"i_{r}") + 1) for r in RULES])
    counts = store(
        held.join(path, "stratum")
        .withColumn("idx", F.coalesce(F.col("points") - point + 1, F.lit(0)))
        .groupBy("stratum", *fields, "idx")
        .agg(F.sum("tests").alias("good"), F.sum("bad").alias("bad")), "quality-counts")
    least = math.log(delta) / math.log1p(-alpha_total)
    sizes = (counts.groupBy("stratum").agg(F.sum("good").alias("n"))
             .filter(F.col("n") >= least).select(F.collect_list("n").alias("n")).scalar())

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        first, sizes = pdf.iloc[0], [int(n) for n in pdf["sizes"].iloc[0]]
        points = int(first["points"])
        good, bad = np.zeros(points + 1, np.int64), np.zeros(points + 1, np.int64)
        good[pdf["idx"]], bad[pdf["idx"]] = pdf["good"], pdf["bad"]
        if not certifiable(int(good.sum()), sizes, alpha_total, delta):
            return pd.DataFrame([])
        level = delta / sum(certifiable(n, sizes, alpha_total, delta) for n in sizes)
        c = choose_cutoff(good, bad, alpha_total, level, cost)
        if c is None:
            return pd.DataFrame([])
        out = []
        for r in RULES:
            steps = min(points - c - int(first[f"off_{r}"]), GRID - int(first[f"to_{r}"]))
            if steps > 0:
                out.append({
                    "stratum": first["stratum"], "rule": r, "cutoff": GRID - steps,
                    "good": good.sum(), "good_rejected": good[c + 1:].sum(),
                    "bad": bad.sum(), "bad_rejected": bad[c + 1:].sum()})
        return pd.DataFrame(out)

    return (counts.withColumn("sizes", sizes).groupBy("stratum")
            .applyInPandas(choose, "stratum string, rule string, cutoff int, good bigint, "
                                   "good_rejected bigint, bad bigint, bad_rejected bigint"))


def cutoffs_wide(cutoffs: DataFrame) -> DataFrame:
    """One row per stratum with a column ``c_<rule>`` (null: rule is off)."""
    return cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in RULES])


def judge(measured: DataFrame, wide: DataFrame, lang: str = "lang") -> DataFrame:
    """Adds base_failed and kept. The cutoff table has one row per certified
    stratum; Spark broadcasts it when its file is small, else it shuffles."""
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(grid_index(r) > F.col(f"c_{r}"), F.lit(False))
    return (measured.withColumn("__stratum", stratum(lang))
            .join(wide.withColumnRenamed("stratum", "__stratum"), "__stratum", "left")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejected)
            .drop("__stratum", *[f"c_{r}" for r in RULES]))


def quality_report(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: measures, base verdict, verdict."""
    measured = store(features(docs.select("doc_id", "lang", "text"), ["doc_id", "lang"]),
                     "quality-measures")
    wide = store(cutoffs_wide(learn_cutoffs(measured, labels)), "quality-cutoffs")
    return judge(measured, wide)


def quality_filter(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that pass, with their own columns. Two passes over the text:
    one to learn cutoffs from labelled rows, one to measure and filter; the
    text is never shuffled."""
    measured = store(features(docs.select("doc_id", "lang", "text"), ["doc_id", "lang"]),
                     "quality-measures")
    wide = store(cutoffs_wide(learn_cutoffs(measured, labels)), "quality-cutoffs")
    safe, name, cols = guarded(docs)
    kept = judge(features(safe, text=name["text"]), wide, name["lang"]).filter("kept")
    return kept.select(*[F.col(name[c]).alias(c) for c in cols])
