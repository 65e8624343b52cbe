"""Query op11: fingerprints of whole documents and of their edited texts."""

from __future__ import annotations

from bazaarlens.llm.ctph import neighbours
from bazaarlens.sources.tables import read_table

NAME = "op11_fingerprints"
ORACLE = None  # rolling hashes over code points: tested by brute force


def query(spark, sf_dir):
    return neighbours(read_table(spark, sf_dir, "documents"))
