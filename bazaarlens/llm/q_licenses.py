"""Query op6: license scan of whole documents."""

from __future__ import annotations

from bazaarlens.llm.licenses import CONTAINED, MARKERS, SHINGLE, TEMPLATES, scan
from bazaarlens.llm.licenses import size_class, template_shingles
from bazaarlens.sources.tables import read_table

NAME = "op6_license_scan"


def query(spark, sf_dir):
    return scan(spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _oracle() -> str:
    """Exact containment in every window, without signatures."""
    wanted = ", ".join(
        f"('{name}', {size_class(len(sh))}, {len(sh)}, '{s}')" for name, sh in
        ((n, template_shingles(t)) for n, t in TEMPLATES.items()) for s in sh)
    joined = " || ' ' || ".join(f"w[p + {k}]" for k in range(SHINGLE))
    return f"""WITH wanted(license, size, n, shingle) AS (VALUES {wanted}),
docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body FROM documents),
words AS (SELECT row_no, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w
  FROM docs WHERE regexp_matches(lower(body), '(^|[^a-z0-9])({"|".join(MARKERS)})($|[^a-z0-9])')),
places AS (SELECT row_no, w, unnest(generate_series(1, len(w) - {SHINGLE - 1})) AS p FROM words),
shingles AS (SELECT row_no, p - 1 AS p, {joined} AS shingle FROM places),
hits AS (SELECT row_no, license, size, n, p, w.shingle FROM shingles JOIN wanted w USING (shingle)),
windows AS (SELECT row_no, license, n, shingle, unnest([p // (size // 2), p // (size // 2) - 1]) AS win
  FROM hits),
found AS (SELECT DISTINCT row_no, license FROM (SELECT row_no, license, win FROM windows WHERE win >= 0
  GROUP BY row_no, license, win, n HAVING count(DISTINCT shingle) >= {CONTAINED} * n)),
listed AS (SELECT row_no, count(*) AS k, string_agg(license, ',' ORDER BY license) AS names
  FROM found GROUP BY row_no)
SELECT doc_id, coalesce(k, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses
FROM docs LEFT JOIN listed USING (row_no)"""


ORACLE = _oracle()
