"""Query op2: mix all documents to target weights; rows stand in training order
of each document's first take, documents that are not taken last."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.llm.mixing import mix
from bazaarlens.sources.tables import read_table

NAME = "op2_mixing"


def query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix(spark, docs).orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "ord")
    return mixed.select("doc_id", "size", "source_size", "target", "taken",
                        F.size("positions").cast("bigint").alias("n_takes"),
                        F.round(F.get("positions", F.lit(0)), 6).alias("first_position"))


def oracle_sql(source: str) -> str:
    """CTEs over ``source`` (row_no, doc_id, source, text), ending in ``takes``."""
    return f"""
sized AS (SELECT row_no, doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS ord,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {source}),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM per_source),
weighed AS (SELECT *, CASE rnk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
  2 * source_size AS cap FROM ranked),
levels AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (ORDER BY cap / weight, rnk
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level FROM weighed),
water AS (SELECT arg_min(level, struct_pack(a := cap / weight, b := rnk)) AS w FROM levels
  WHERE cap >= level * weight),
targets AS (SELECT source, source_size, rnk,
  CASE WHEN w IS NULL OR cap <= w * weight THEN cap::DOUBLE ELSE w * weight END AS target
  FROM levels, water),
offsets AS (SELECT s.*, t.source_size, t.target, t.rnk,
  (sum(size) OVER (PARTITION BY t.rnk ORDER BY ord, doc_id, size
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS o
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
takes AS (SELECT *, (size > 0 AND o + size / 2 <= target)::INT
    + (size > 0 AND o + source_size + size / 2 <= target)::INT AS n_takes,
  least(o / target, 1.0::DOUBLE) AS done FROM offsets)"""


ORACLE = f"""WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, source, text FROM documents),
{oracle_sql("docs")}
SELECT doc_id, size, source_size, target, size * n_takes AS taken, n_takes::BIGINT AS n_takes,
  CASE WHEN n_takes > 0 THEN round(CASE rnk % 3 WHEN 0 THEN done
    WHEN 1 THEN 1.5 - sqrt(2.25 - 2 * done) ELSE (sqrt(0.25 + 2 * done) - 0.5) END, 6)
  END AS first_position
FROM takes"""
