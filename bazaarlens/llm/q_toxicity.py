"""Query op10: toxicity score of whole documents."""

from __future__ import annotations

from bazaarlens.llm.toxicity import toxicity
from bazaarlens.sources.tables import read_table

NAME = "op10_toxicity"
ORACLE = None  # a trained model: tested by held-out accuracy


def query(spark, sf_dir):
    return toxicity(spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                    read_table(spark, sf_dir, "labels"))
