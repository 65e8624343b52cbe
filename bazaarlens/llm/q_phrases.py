"""Query op12: collocations of all documents, per language."""

from __future__ import annotations

from bazaarlens.llm.phrases import phrases
from bazaarlens.sources.tables import read_table

NAME = "op12_phrases"


def query(spark, sf_dir):
    return phrases(spark, read_table(spark, sf_dir, "documents"))


ORACLE = """WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM pieces),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM
  (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
   FROM words, (VALUES (1), (2), (3), (4)) AS t(m))),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m >= 2 AND f >= 30),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
    (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM candidates c JOIN (VALUES (1), (2), (3)) AS t(k) ON k < c.m
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(f) AS f FROM
  (SELECT lang, f, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM
    (SELECT lang, f, w, s, unnest(range(1, m - s + 2)) AS i
     FROM candidates JOIN (VALUES (2), (3)) AS t(s) ON s < m)) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
  s.phrase, a, l, r, n, score::BIGINT AS score
FROM scored s JOIN totals t ON t.lang = s.lang
LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE i.f IS NULL OR 100 * i.f < 80 * a
QUALIFY rank <= 2000"""
