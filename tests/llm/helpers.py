"""Shared fixtures of the operator tests: awkward documents and oracle runs."""

import os
import sys

import duckdb

from bazaarlens.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(__file__))),
                                "scripts"))
from check_oracle import rows_of  # noqa: E402

DOC_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = "lorem ipsum dolor sit amet\n" * 4000


def awkward_docs():
    """Nulls in every column, empty and very long texts, repeated rows and ids."""
    body = "one two three four five six seven eight nine ten " * 8
    rows = [(1, body + "alpha", "en", "a", 1), (1, body + "alpha", "en", "a", 1),
            (2, body + "beta", "en", "a", 2), (None, body + "alpha", "en", "b", 3),
            (3, None, "de", "b", None), (4, "", None, None, 0), (5, "", "fr", None, 0),
            (6, LONG, "en", "", 6), (7, " \n\t\n", "en", "a", 4), (8, "word", "es", "c", 4),
            (9, "Word", "es", "c", 4), (10, body.upper() + "ALPHA", None, "a", 5)]
    return rows


def docs_frame(spark, rows=None):
    return spark.createDataFrame(awkward_docs() if rows is None else rows, DOC_DDL)


def write_tables(spark, folder, **frames):
    for name, df in frames.items():
        df.coalesce(1).write.parquet(os.path.join(str(folder), f"{name}.parquet"))
    return str(folder)


def oracle_rows(sql, sf_dir=SF_SMALL, names=TABLES):
    con = duckdb.connect()
    try:
        for t in names:
            p = table_path(sf_dir, t)
            if os.path.exists(p):
                src = p + "/*.parquet" if os.path.isdir(p) else p
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{src}')")
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        return rows_of(cols, res.fetchall())
    finally:
        con.close()


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
