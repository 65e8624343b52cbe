"""First-seen, page yield, crawl cutoff, resume."""


from bazaarlens.operators.dedup import (crawl_cutoff, first_seen, incremental_new,
                                        page_yield)
from tests.helpers import raw_rows


def test_first_keyword_wins(spark):
    df = raw_rows(spark, [
        dict(asin="A", search_keyword="business laptops", page_scraped=1, id=1),
        dict(asin="A", search_keyword="laptops", page_scraped=5, id=2),
        dict(asin="B", search_keyword="student laptops", page_scraped=2, id=3)])
    got = {r.asin: r.search_keyword for r in first_seen(df).collect()}
    assert got == {"A": "laptops", "B": "student laptops"}


def test_within_page_first_position_wins(spark):
    df = raw_rows(spark, [dict(asin="A", id=7, product_name="second"),
                          dict(asin="A", id=3, product_name="first")])
    assert [r.product_name for r in first_seen(df).collect()] == ["first"]


def test_first_seen_one_row_per_key_any_partitioning(spark):
    from tests.conftest import SF_SMALL
    from bazaarlens.sources.tables import read_raw
    raw = read_raw(spark, SF_SMALL)
    a = first_seen(raw)
    assert a.count() == a.select("asin").distinct().count() == raw.select("asin").distinct().count()
    b = first_seen(raw.repartition(5, "id"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_first_seen_limits_rows_before_shuffle(spark):
    from tests.conftest import SF_SMALL
    from bazaarlens.sources.tables import read_raw
    plan = first_seen(read_raw(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_page_yield_counts_repeats_within_page_as_new(spark):
    df = raw_rows(spark, [
        dict(asin="A", page_scraped=1, id=1), dict(asin="A", page_scraped=1, id=2),
        dict(asin="B", page_scraped=1, id=3),
        dict(asin="A", page_scraped=2, id=4), dict(asin="C", page_scraped=2, id=5),
        dict(asin="C", search_keyword="gaming laptops", page_scraped=1, id=6),
        dict(asin="D", search_keyword="gaming laptops", page_scraped=1, id=7)])
    got = {(r.search_keyword, r.page_scraped): (r.products, r.new_products, r.duplicates,
                                                r.running_total)
           for r in page_yield(df).collect()}
    assert got == {("laptops", 1): (3, 3, 0, 3), ("laptops", 2): (2, 1, 1, 4),
                   ("gaming laptops", 1): (2, 1, 1, 5)}


def _stats(spark, counts, statuses=None):
    rows = [("laptops", i + 1, n, (statuses or {}).get(i + 1, "ok")) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "search_keyword string, page_scraped int, "
                                       "products bigint, status string")


def test_cutoff_second_consecutive_empty_page(spark):
    r = crawl_cutoff(_stats(spark, [20, 0, 5, 0, 0, 9])).first()
    assert (r.stop_page, r.stop_reason, r.products_kept) == (5, "empty run", 25)


def test_cutoff_blocked_page(spark):
    r = crawl_cutoff(_stats(spark, [20, 0, 5], {2: "blocked"})).first()
    assert (r.stop_page, r.stop_reason, r.products_kept) == (2, "blocked", 20)


def test_cutoff_runs_to_last_page(spark):
    r = crawl_cutoff(_stats(spark, [1, 0, 2, 0, 3])).first()
    assert (r.stop_page, r.stop_reason, r.products_kept) == (5, "max pages", 6)


def test_cutoff_exhausted_and_empty_start(spark):
    r = crawl_cutoff(_stats(spark, [0, 0, 7])).first()
    assert (r.stop_page, r.stop_reason) == (2, "empty run")
    r = crawl_cutoff(_stats(spark, [4, 0], {2: "exhausted"})).first()
    assert (r.stop_page, r.stop_reason) == (2, "exhausted")


def test_incremental_new_skips_known_keys(spark):
    seen = raw_rows(spark, [dict(asin="A"), dict(asin="A"), dict(asin="B")])
    new = raw_rows(spark, [dict(asin="A", id=10), dict(asin="C", id=11), dict(asin="C", id=12)])
    assert sorted(r.id for r in incremental_new(new, seen).collect()) == [11]


def test_resume_appends_and_keeps_null_keywords(spark):
    from bazaarlens.operators.dedup import resume_crawl
    seen = raw_rows(spark, [dict(asin="A", id=1)])
    new = raw_rows(spark, [dict(asin="A", id=10), dict(asin="C", id=11, search_keyword=None),
                           dict(asin="D", id=12)])
    assert sorted(r.id for r in resume_crawl(seen, new).collect()) == [1, 11, 12]


def test_hot_key_is_limited_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    new = raw_rows(spark, [dict(asin="A", id=1)]).drop("asin").crossJoin(
        spark.range(2000).select(F.expr("CASE WHEN id % 2 = 0 THEN 'HOT' ELSE concat('K', id) END")
                                 .alias("asin"), F.col("id").alias("n"))) \
        .withColumn("id", F.col("n")).drop("n")
    got = incremental_new(new, new.filter("asin = 'K1'"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert got.count() == 1000


def test_unlisted_keywords_are_told_apart(spark):
    df = raw_rows(spark, [dict(asin="A", search_keyword="zeta", id=1),
                          dict(asin="A", search_keyword="eta", id=2)])
    got = {r.search_keyword: (r.new_products, r.running_total) for r in page_yield(df).collect()}
    assert got == {"eta": (1, 1), "zeta": (0, 1)}


def test_cutoff_counts_visits_not_page_numbers(spark):
    rows = [("laptops", p, n, "ok") for p, n in ((1, 9), (2, 0), (5, 4), (9, 0), (12, 0), (13, 1))]
    stats = spark.createDataFrame(rows, "search_keyword string, page_scraped int, "
                                        "products bigint, status string")
    r = crawl_cutoff(stats).first()
    assert (r.stop_page, r.stop_reason, r.products_kept) == (12, "empty run", 13)
    late = spark.createDataFrame([("laptops", 2, 0, "ok"), ("laptops", 3, 5, "ok")],
                                 stats.schema)
    assert crawl_cutoff(late).first().stop_reason == "max pages"


def test_duplicates_removed_counts_repeats_within_a_page_only(spark):
    from bazaarlens.operators.report import run_report
    df = raw_rows(spark, [dict(asin="A", id=1), dict(asin="A", id=2), dict(asin="B", id=3),
                          dict(asin="A", page_scraped=2, id=4), dict(asin="B", page_scraped=3, id=5)])
    r = run_report(df).first()
    assert (r.unique_products, r.duplicates_removed) == (2, 1)


def test_run_report_counts(spark):
    from bazaarlens.operators.report import keyword_breakdown, run_preview, run_report
    from tests.helpers import D
    df = raw_rows(spark, [
        dict(asin="A", listing_type="Sponsored", discount_percent=None),
        dict(asin="A"), dict(asin="B", price_inr=D("10000"), rating=None),
        dict(asin="C", search_keyword="gaming laptops", brand="Other1")])
    r = run_report(df).first()
    assert r.unique_products == 3 and r.duplicates_removed == 1
    assert r.sponsored_listings == 1 and r.organic_listings == 2
    assert r.unique_brands == 2
    assert r.pct_with_discount == 66.7
    assert r.avg_rating == 4.2
    assert {x.search_keyword: x.products for x in keyword_breakdown(df).collect()} == \
        {"laptops": 2, "gaming laptops": 1}
    assert run_preview(df, n=2).count() == 2
    assert run_preview(df).columns == ["product_name", "brand", "price_inr", "discount_percent",
                                       "rating", "search_keyword"]
