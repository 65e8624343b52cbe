"""Query op3: byte-level BPE round trip of whole documents."""

from __future__ import annotations

from bazaarlens.llm.bpe import digests, round_trip
from bazaarlens.sources.tables import read_table

NAME = "op3_byte_bpe"
ORACLE = None  # tested against a public tokenizer library and by exact round trip


def query(spark, sf_dir):
    return digests(round_trip(spark, read_table(spark, sf_dir, "documents")))
