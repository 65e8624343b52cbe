"""Rejected fields of a load; marts merged from partial states."""

import os

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import mart_state as S
from bazaarlens.operators.marts import MARTS
from bazaarlens.plans.registry import QUERIES
from bazaarlens.session import scratch_path
from bazaarlens.sources.csv import load_csv, load_rejects
from tests.conftest import SF_SMALL
from tests.test_sources import HEADER, _write

GOOD = "B1,n,b,6000.00,,,4.1,7,Organic,laptops,1,2024-01-01 10:00:00"


def rejects(spark, body, **options):
    path = _write(spark, body)
    found = load_rejects(spark, path, **options)
    return [tuple(r) for r in found.select("asin", "field", "reason").collect()], path


def test_good_lines_are_not_rejected(spark):
    body = GOOD + "\r\n" + 'B2,"a, ""b""",,,,,,,,,,\r\n'
    assert rejects(spark, body)[0] == []


def test_bad_fields_short_and_long_lines(spark):
    body = ("B2,n,b,12x,,,4.1,7.5,Organic,laptops,,2024-01-01\r\n"
            "B3,n,b,99999999999.00,,,,,,,one,then\r\n"
            "B4,n\r\n" + GOOD + ",extra\r\n"
            'B5,"x, y, z",b,1,2\r\n' + GOOD + "\r\n")
    got, path = rejects(spark, body)
    assert sorted(map(str, got)) == sorted(map(str, [
        ("B2", "price_inr", "not a decimal(10,2)"), ("B2", "total_reviews", "not a int"),
        ("B3", "price_inr", "not a decimal(10,2)"), ("B3", "page_scraped", "not a int"),
        ("B3", "scraped_at", "not a timestamp_ntz"), ("B4", None, "too few fields"),
        ("B1", None, "too many fields"), ("B5", None, "too few fields")]))
    loaded = {r.asin: r for r in load_csv(spark, path).collect()}
    assert loaded["B2"].price_inr is None and loaded["B2"].total_reviews is None
    assert loaded["B3"].price_inr is None and loaded["B3"].scraped_at is None


def test_rejects_name_their_place(spark):
    path = _write(spark, "B2,n,b,12x,,,,,,,,\r\n")
    row = load_rejects(spark, path).first()
    assert (row.file, row.block_start, row.value) == ("part.csv", 0, "12x")
    assert load_rejects(spark, _write(spark, "")).count() == 0
    assert len(HEADER.split(",")) == 12


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", sorted(S.STATE_MARTS))
def test_merged_marts_equal_a_recomputation(spark, name):
    cleaned = QUERIES["cleaned"](spark, SF_SMALL)
    folder = scratch_path(spark, "mart-state")
    for k in range(3):
        state = S.update_state(cleaned.filter(F.col("id") % 3 == k), folder)
        so_far = cleaned.filter(F.col("id") % 3 <= k)
        columns = MARTS[name](cleaned).columns
        assert rows(S.STATE_MARTS[name](state).select(*columns)) == rows(MARTS[name](so_far))
    assert state.count() == cleaned.select(*S.GROUP).distinct().count() < cleaned.count()
    empty = S.mart_state(cleaned.limit(0))
    assert rows(S.STATE_MARTS[name](S.merge_states(state, empty))) == \
        rows(S.STATE_MARTS[name](state))
    assert rows(S.STATE_MARTS[name](empty).select(*columns)) == rows(MARTS[name](cleaned.limit(0)))


def test_a_read_of_merged_marts_touches_group_rows_only(spark):
    plan = QUERIES["merged_brand_performance"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scans) == 1 and "mart-state" in scans[0] and ",price_inr#" not in scans[0]


def test_readers_and_dead_loads(spark):
    cleaned = QUERIES["cleaned"](spark, SF_SMALL)
    folder = scratch_path(spark, "mart-state")
    assert S.read_state(spark, folder) is None
    first = S.update_state(cleaned.filter("id % 2 = 0"), folder)
    before = rows(first)
    os.makedirs(os.path.join(folder, "v=2", "_temporary"))   # a load that died
    assert rows(S.read_state(spark, folder)) == before
    S.update_state(cleaned.filter("id % 2 = 1"), folder)
    assert rows(first) == before                              # the open reader goes on
    assert rows(S.read_state(spark, folder)) != before
