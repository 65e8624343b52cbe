"""Every registered query against its DuckDB oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

from __spark_entry__ import entry
from bazaarlens.plans.oracle import oracle_sql
from bazaarlens.plans.registry import QUERIES
from bazaarlens.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))
from check_oracle import rows_of  # noqa: E402

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["brand", "total_products", "avg_price", "avg_rating"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, res.fetchall())
