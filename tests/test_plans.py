"""Plan guards over every registered key (shape, not timing)."""

import pytest

from bazaarlens.plans.registry import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("MapInArrow", "MapInPandas", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas")


def _plan(spark, key) -> str:
    return QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_pairwise_joins(spark, key):
    plan = _plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_reports_stay_in_the_jvm(spark, key):
    plan = _plan(spark, key)
    assert not any(node in plan for node in PYTHON_NODES), key


@pytest.mark.parametrize("key", ["brand_leaderboard", "listing_performance", "vw_kpi_summary",
                                 "dq_profile", "first_seen"])
def test_scans_read_only_needed_columns(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans
    if key != "first_seen":  # first_seen returns whole rows
        for line in scans:
            assert "scraped_at" not in line and "product_name" not in line


def test_extraction_has_no_shuffle_and_only_card_pages_reach_python(spark):
    from bazaarlens.operators.extract import extract_cards
    from bazaarlens.plans.registry import archived_pages
    plan = extract_cards(archived_pages(spark, SF_SMALL))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan
    below = plan[plan.index("MapInArrow"):]
    assert "Contains(html" in below and "s-search-result" in below


@pytest.mark.parametrize("key", ["page_yield", "brand_share", "dominant_segment"])
def test_no_window_over_all_rows(spark, key):
    """Whole-table windows only sit on a row per search keyword."""
    plan = _plan(spark, key)
    singles = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(singles) <= (1 if key == "page_yield" else 2)
    assert "Window" not in plan or key == "page_yield"
