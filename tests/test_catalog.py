"""Catalog tables: bucketed by the product key, replaced under readers."""

import os

import pytest

from bazaarlens.plans import catalog as K
from bazaarlens.plans.registry import QUERIES
from bazaarlens.sources.tables import read_raw
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_replace_under_a_reader(spark):
    raw = read_raw(spark, SF_SMALL)
    first = K.replace_table(raw.filter("id % 2 = 0"), "t_replace", buckets=4)
    before = rows(first)
    other = spark.newSession().table(f"{K.DATABASE}.t_replace")     # opened before the replace
    second = K.replace_table(raw, "t_replace", buckets=4)
    assert rows(second) == rows(raw) == rows(spark.table(f"{K.DATABASE}.t_replace"))
    assert rows(other) == rows(first) == before
    assert K.drop_versions(spark, "t_replace", keep=2) == []
    files = [f.removeprefix("file:") for f in first.inputFiles()]
    assert K.drop_versions(spark, "t_replace") == [1]
    assert not any(os.path.exists(f) for f in files)
    assert rows(spark.table(f"{K.DATABASE}.t_replace")) == rows(raw)


def test_a_dead_writer_changes_nothing(spark):
    raw = read_raw(spark, SF_SMALL)
    K.replace_table(raw, "t_dead", buckets=2)
    bad = raw.selectExpr("raise_error('lost') as asin", "id")
    with pytest.raises(Exception):
        K.replace_table(bad, "t_dead", buckets=2)
    assert rows(spark.table(f"{K.DATABASE}.t_dead")) == rows(raw)
    assert rows(K.replace_table(raw.limit(0), "t_dead", buckets=2)) == []


def test_buckets_are_sorted_files(spark):
    import pyarrow.parquet as pq
    stored = K.raw_bucketed(spark, SF_SMALL)
    files = [f.removeprefix("file:") for f in stored.inputFiles()]
    assert 1 < len(files) <= K.BUCKETS
    for f in files:
        keys = pq.read_table(f, columns=["asin"]).column(0).to_pylist()
        assert keys == sorted(keys)


@pytest.mark.parametrize("key", ["dq_duplicates", "first_seen", "incremental_new"])
def test_grouping_by_the_key_exchanges_no_stored_rows(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_SMALL))
    assert "Bucketed: true" in plan
    assert not any("hashpartitioning(asin" in x for x in plan.splitlines())


def test_stored_rows_are_the_cleaning_query(spark):
    assert rows(QUERIES["cleaned_stored"](spark, SF_SMALL)) == rows(QUERIES["cleaned"](spark, SF_SMALL))
