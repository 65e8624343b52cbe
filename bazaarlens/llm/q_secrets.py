"""Query op1: secret scan of whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.llm.secrets import scan
from bazaarlens.sources.tables import read_table

NAME = "op1_secret_scan"


def query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select("doc_id", "n_assign", "n_access", "n_hex",
                             F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_linked")


# The same question with the patterns written out as they must match.
_P = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
               r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?"""
               r"""([A-Za-z0-9+/_.=-]+)"""),
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{24,}",
    "login": (r"""([Uu][Ss][Ee][Rr][Nn][Aa][Mm][Ee]|[Uu][Ss][Ee][Rr]|[Ll][Oo][Gg][Ii][Nn]"""
              r"""|[Cc][Ll][Ii][Ee][Nn][Tt]_[Ii][Dd]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt])"""
              r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9_.@-]{3,64})"""),
    "token": "[A-Za-z0-9+/]{40,}",
    "endpoint": r"(https?|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[A-Za-z0-9.:@_-]+",
}
_GOOD = {"assign": f"length(regexp_extract(m, '{_P['assign']}', 2)) >= 6", "access": "length(m) >= 20"}
_FOUND = "\nUNION ALL ".join(
    f"""SELECT row_no, '{k}' AS kind, {i} AS o, pos, gap, m, {_GOOD.get(k, 'true')} AS good FROM (
  SELECT row_no, generate_subscripts(ms, 1) AS pos, unnest(ms) AS m,
    length(unnest(gs[1:len(ms)])) AS gap FROM (
  SELECT row_no, regexp_extract_all(body, '{p}') AS ms, string_split_regex(body, '{p}') AS gs
  FROM docs WHERE regexp_matches(body, '{p}')))""" for i, (k, p) in enumerate(_P.items()))
ORACLE = f"""WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body
  FROM documents),
found AS ({_FOUND}),
placed AS (SELECT *, (sum(gap + length(m)) OVER (PARTITION BY row_no, kind ORDER BY pos))::BIGINT AS e
  FROM found),
parts AS (SELECT row_no, kind, o, e - length(m) AS s, e, kind IN ('assign', 'access', 'hex') AS strong,
  CASE WHEN kind IN ('assign', 'hex', 'token') THEN 'S' WHEN kind = 'endpoint' THEN 'E' ELSE 'I' END AS r
  FROM placed WHERE good),
linked AS (SELECT *, strong OR (
    NOT EXISTS (SELECT 1 FROM parts q WHERE q.row_no = p.row_no AND q.strong AND q.s < p.e AND q.e > p.s)
    AND EXISTS (SELECT 1 FROM parts q WHERE q.row_no = p.row_no AND q.s - p.e <= 200
      AND p.s - q.e <= 200 AND CASE WHEN p.r = 'S' THEN q.r <> 'S' ELSE q.r = 'S' END)) AS reported
  FROM parts p),
listed AS (SELECT row_no,
  count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex, count(*) FILTER (WHERE reported AND NOT strong) AS n_linked,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o, e) FILTER (WHERE strong) AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o, e) FILTER (WHERE reported) AS spans
  FROM linked GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_linked, 0) AS n_linked
FROM docs LEFT JOIN listed USING (row_no)"""
