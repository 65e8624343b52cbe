"""Cleaning rules on literal edge rows (one row per rule)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators.clean import clean, clean_removed
from tests.helpers import D, raw_rows


def _clean_one(spark, **over):
    rows = clean(raw_rows(spark, [over])).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize("price,kept", [
    ("5000.00", False), ("5000.01", True), ("500000.00", False), ("499999.99", True)])
def test_price_bounds_are_strict(spark, price, kept):
    assert (_clean_one(spark, price_inr=D(price), original_price_inr=None) is not None) == kept


@pytest.mark.parametrize("price,segment", [
    ("5000.01", "Budget (Under 30K)"), ("29999.99", "Budget (Under 30K)"),
    ("30000.00", "Mid-Range (30K-50K)"), ("50000.00", "Mid-Range (30K-50K)"),
    ("50000.50", None), ("80000.99", None),
    ("50001", "Premium (50K-80K)"), ("80000", "Premium (50K-80K)"),
    ("80001", "High-End (80K-1.2L)"), ("120000", "High-End (80K-1.2L)"),
    ("120000.01", "Ultra-Premium (Above 1.2L)"), ("499999.99", "Ultra-Premium (Above 1.2L)")])
def test_price_segments_with_gaps(spark, price, segment):
    assert _clean_one(spark, price_inr=D(price), original_price_inr=None).price_segment == segment


def test_missing_price_or_name_removed(spark):
    assert _clean_one(spark, price_inr=None) is None
    assert _clean_one(spark, product_name=None) is None


@pytest.mark.parametrize("rating,clean_rating,category", [
    ("0.0", None, "Below Average"), (None, None, "Not Rated"), ("5.1", None, "Excellent (4.5+)"),
    ("4.5", "4.5", "Excellent (4.5+)"), ("4.4", "4.4", "Good (4.0-4.4)"),
    ("4.0", "4.0", "Good (4.0-4.4)"), ("3.9", "3.9", "Average (3.5-3.9)"),
    ("3.5", "3.5", "Average (3.5-3.9)"), ("3.4", "3.4", "Below Average")])
def test_rating_and_category_read_raw_rating(spark, rating, clean_rating, category):
    r = _clean_one(spark, rating=D(rating))
    assert r.rating == D(clean_rating)
    assert r.rating_category == category


@pytest.mark.parametrize("scraped,tier", [
    (None, "No Discount"), ("9.99", "Low (Under 10%)"), ("10", "Moderate (10-24%)"),
    ("24.99", "Moderate (10-24%)"), ("25", "High (25-39%)"), ("39.99", "High (25-39%)"),
    ("40", "Mega Deal (40%+)")])
def test_discount_tier_reads_scraped_discount(spark, scraped, tier):
    r = _clean_one(spark, discount_percent=D(scraped))
    assert r.discount_tier == tier
    # recomputed discount is independent of the scraped one
    assert r.discount_percent == Decimal("20.0")


@pytest.mark.parametrize("price,mrp", [("60000", "60000"), ("60000", "50000"), ("60000", None)])
def test_no_markdown_no_discount(spark, price, mrp):
    r = _clean_one(spark, price_inr=D(price), original_price_inr=D(mrp))
    assert r.discount_percent is None and r.savings_inr is None


def test_discount_and_savings(spark):
    r = _clean_one(spark, price_inr=D("60000"), original_price_inr=D("80000"))
    assert r.discount_percent == Decimal("25.0")
    assert r.savings_inr == Decimal("20000.00")


def test_discount_rounds_half_up(spark):
    # (8000 - 7996) / 8000 * 100 = 0.05 exactly: half-up gives 0.1, half-even 0.0
    r = _clean_one(spark, price_inr=D("7996"), original_price_inr=D("8000"))
    assert r.discount_percent == Decimal("0.1")


def test_reviews_default_zero(spark):
    assert _clean_one(spark, total_reviews=None).total_reviews == 0


@pytest.mark.parametrize("name,brand,expected", [
    ("Dell MacBook stand", "Dell", "Apple"),
    ("x", "hp-compatible", "HP"),
    ("x", "15.6", "Other"),
    ("x", " 15", "15"),
    ("x", " Primebook ", "Primebook"),
    ("x", None, None),
    ("x", "ULTIMUS", "ULTIMUS"),
    ("lenovo thinkpad", "acer", "Lenovo"),
    ("x", "MSI-ish", "MSI"),
])
def test_brand_rules(spark, name, brand, expected):
    assert _clean_one(spark, product_name=name, brand=brand).brand == expected


def test_name_trimmed(spark):
    assert _clean_one(spark, product_name="  Laptop A  ").product_name == "Laptop A"


def test_null_brand_dropped_by_not_other(spark):
    from bazaarlens.operators.insights import brand_leaderboard
    df = clean(raw_rows(spark, [dict(product_name="x", brand=None),
                                dict(product_name="y", brand="Acer")]))
    assert [r.brand for r in brand_leaderboard(df).collect()] == ["Acer"]


def test_case_insensitive_collation_option(spark):
    df = raw_rows(spark, [dict(product_name="x", brand="ULTIMUS"),
                          dict(product_name="y", brand="Ultimus")])
    assert clean(df).select("brand").distinct().count() == 2
    assert clean(df, collation="UTF8_LCASE").select("brand").distinct().count() == 1


def test_removed_plus_cleaned_is_raw(spark):
    rows = [dict(price_inr=D(p)) for p in ["5000", "5000.01", None, "500000", "70000"]]
    rows.append(dict(product_name=None))
    raw = raw_rows(spark, rows)
    removed = clean_removed(raw)
    assert clean(raw).count() + removed.count() == raw.count()
    reasons = {r.id: r.reason for r in removed.collect()}
    assert reasons == {1: "price too low", 3: "missing price", 4: "price too high",
                       6: "missing name"}


def test_clean_is_one_narrow_stage(spark):
    plan = clean(raw_rows(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Python" not in plan


def test_clean_independent_of_partitioning(spark):
    from tests.conftest import SF_SMALL
    from bazaarlens.sources.tables import read_raw
    raw = read_raw(spark, SF_SMALL)
    a = clean(raw).orderBy("id").collect()
    b = clean(raw.repartition(7)).orderBy("id").collect()
    assert a == b


def test_filter_pushed_to_parquet(spark):
    from tests.conftest import SF_SMALL
    from bazaarlens.sources.tables import read_raw
    from bazaarlens.operators.insights import listing_performance
    df = listing_performance(clean(read_raw(spark, SF_SMALL)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan
    # the scan reads only the columns the query needs
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l][0]
    assert "o_orderpriority" not in scan


def test_brand_rule_expression_matches_sql_rules(spark):
    from bazaarlens.functions.brand import BRAND_RULES
    assert len(BRAND_RULES) == 19
    df = raw_rows(spark, [dict(product_name="zenbook", brand="Dell")])
    assert clean(df).select(F.col("brand")).first()[0] == "ASUS"
