"""Query op8: quality rules over whole documents."""

from __future__ import annotations

from bazaarlens.llm.quality import quality_report
from bazaarlens.sources.tables import read_table

NAME = "op8_quality_rules"
ORACLE = None  # exact binomial tests over learned cutoffs: tested by brute force


def query(spark, sf_dir):
    report = quality_report(spark, read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "labels"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")
