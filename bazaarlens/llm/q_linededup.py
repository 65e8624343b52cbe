"""Query op4: line de-duplication of whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.llm.linededup import drop_lines
from bazaarlens.sources.tables import read_table

NAME = "op4_line_dedup"


def query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(spark, docs, min_docs=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_KEY = ("translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def oracle_sql(source: str, columns: str) -> str:
    """CTEs of the rule over ``source`` (needs doc_id, text), ending in ``kept_lines``
    with one row per row of ``source``: row_no, kept_text, n_lines, n_dropped."""
    return f"""
numbered AS (SELECT row_number() OVER () AS row_no, {columns} FROM {source}),
all_lines AS (SELECT row_no, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT row_no, string_split(coalesce(text, ''), chr(10)) AS ls FROM numbered)),
keyed AS (SELECT row_no, pos, line, {_KEY} AS k FROM all_lines),
often AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k
  HAVING count(DISTINCT row_no) >= 10),
kept_lines AS (SELECT row_no, count(*) AS n_lines,
    count(*) FILTER (WHERE k IN (SELECT k FROM often)) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos)
      FILTER (WHERE k NOT IN (SELECT k FROM often)), '') AS kept_text
  FROM keyed GROUP BY row_no)"""


ORACLE = f"""WITH {oracle_sql("documents", "doc_id, text")}
SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256
FROM kept_lines JOIN numbered USING (row_no)"""
