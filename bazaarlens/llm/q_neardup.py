"""Query op9: near-duplicate documents by SuperMinHash."""

from __future__ import annotations

from bazaarlens.llm.neardup import near_duplicates
from bazaarlens.sources.tables import read_table

NAME = "op9_minhash_neardup"


def query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(spark, docs).select("doc_id", "n_shingles", "component_id", "kept")


# All pairs of texts that share a shingle and are of similar size; rows, not ids, are linked.
ORACLE = """WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT r, list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d),
s AS (SELECT r, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (SELECT a.r AS a, b.r AS b, any_value(a.n) + any_value(b.n) AS total, count(*) AS n_both
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.r < b.r AND 10 * a.n >= 8 * b.n
    AND 10 * b.n >= 8 * a.n GROUP BY a.r, b.r),
links AS (SELECT a, b FROM common WHERE 100 * n_both >= 80 * (total - n_both)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, c) AS (SELECT r, r FROM d UNION SELECT reach.a, e.b FROM reach JOIN edges e ON reach.c = e.a),
least AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = c GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN sets USING (r) JOIN least USING (r)"""
