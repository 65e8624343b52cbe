"""Query op5: near-duplicate embeddings within equal labels."""

from __future__ import annotations

from bazaarlens.llm.embeddings import near_duplicates
from bazaarlens.sources.tables import read_table

NAME = "op5_embedding_neardup"


def query(spark, sf_dir):
    return near_duplicates(spark, read_table(spark, sf_dir, "embeddings"))


ORACLE = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
valid AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.c = l.a),
comp AS (SELECT a AS vec_id, min(c) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN degree USING (vec_id)"""
