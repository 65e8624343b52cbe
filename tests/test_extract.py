"""Card extraction: parser literals, native coercions, page classes, round trip."""

import datetime as dt
from decimal import Decimal

import pytest

from bazaarlens.functions.cards import parse_cards
from bazaarlens.operators.extract import extract_cards, page_status
from bazaarlens.sources.archive_fixture import render_pages

URL = "https://shop.example/s?k=gaming+laptops&i=computers&s=review-rank&page=2"
TS = dt.datetime(2024, 5, 6, 7, 8, 59)


def card(asin='B0X', name='<span class="a-size-medium">Dell Inspiron 15</span>', brand=None,
         price="45,990.", mrp=None, rating=None, reviews=None, extra=""):
    parts = [f'<div data-component-type="s-search-result"'
             + (f' data-asin="{asin}"' if asin is not None else "") + ">"]
    parts.append(name or "")
    if brand is not None:
        parts.append(f'<span class="a-size-base-plus a-color-base">{brand}</span>')
    if price is not None:
        parts.append(f'<span class="a-price"><span class="a-price-whole">{price}</span></span>')
    if mrp is not None:
        parts.append(f'<span class="a-price a-text-price"><span class="a-offscreen">{mrp}'
                     '</span></span>')
    if rating is not None:
        parts.append(f'<span class="a-icon-alt">{rating}</span>')
    if reviews is not None:
        parts.append(f'<span class="a-size-base" dir="auto">{reviews}</span>')
    parts.append(extra)
    parts.append("</div>")
    return "".join(parts)


def extract_one(spark, html, url=URL, status=200):
    pages = spark.createDataFrame([(1, url, html, status, TS)],
                                  "page_id long, url string, html string, http_status int, "
                                  "fetched_at timestamp_ntz")
    return extract_cards(pages).collect()


def test_parser_reports_raw_strings():
    cards = parse_cards(card(brand="Dell", mrp="₹59,990.00", rating="4.3 out of 5 stars",
                             reviews="1,234", extra="<span>Sponsored</span>"))
    assert len(cards) == 1
    c = cards[0]
    assert c["asin_attr"] == "B0X" and c["name_medium"] == "Dell Inspiron 15"
    assert c["name_base_plus"] == "Dell" and c["brand_text"] == "Dell"
    assert c["price_text"] == "45,990." and c["mrp_text"] == "₹59,990.00"
    assert c["rating_text"] == "4.3 out of 5 stars" and c["reviews_text"] == "1,234"
    assert c["sponsored"] is True and c["name_h2"] is None


@pytest.mark.parametrize("asin", ["", "  ", None])
def test_missing_asin_skipped(spark, asin):
    assert extract_one(spark, card(asin=asin)) == []


def test_name_from_h2_only(spark):
    r = extract_one(spark, card(name="<h2>Acer Aspire 7</h2>"))[0]
    assert r.product_name == "Acer Aspire 7" and r.brand == "Acer"


def test_no_name_skipped(spark):
    assert extract_one(spark, card(name="")) == []


def test_empty_first_name_tag_does_not_fall_through(spark):
    html = card(name='<span class="a-size-medium"> </span><h2>Real name</h2>')
    assert extract_one(spark, html) == []


def test_name_falls_back_to_brand_span(spark):
    r = extract_one(spark, card(name="", brand="Lenovo"))[0]
    assert r.product_name == "Lenovo" and r.brand == "Lenovo"


def test_brand_first_word_of_name(spark):
    assert extract_one(spark, card())[0].brand == "Dell"


@pytest.mark.parametrize("text,price", [("45,990.", Decimal("45990.00")),
                                        ("45,990.50", Decimal("4599050.00"))])
def test_price_digits(spark, text, price):
    assert extract_one(spark, card(price=text))[0].price_inr == price


@pytest.mark.parametrize("text", [None, "0", "N/A"])
def test_no_price_dropped(spark, text):
    assert extract_one(spark, card(price=text)) == []


@pytest.mark.parametrize("text,mrp", [("₹59,990.00", Decimal("59990.00")), ("N/A", None)])
def test_mrp(spark, text, mrp):
    assert extract_one(spark, card(mrp=text))[0].original_price_inr == mrp


def test_scraped_discount(spark):
    r = extract_one(spark, card(price="45,000.", mrp="₹60,000.00"))[0]
    assert r.discount_percent == Decimal("25.00")
    r = extract_one(spark, card(price="45,000.", mrp="₹40,000.00"))[0]
    assert r.discount_percent is None


@pytest.mark.parametrize("text,rating", [("4.3 out of 5 stars", Decimal("4.3")),
                                         ("no stars", None)])
def test_rating(spark, text, rating):
    assert extract_one(spark, card(rating=text))[0].rating == rating


@pytest.mark.parametrize("text,n", [("1,234", 1234), ("(1,234)", None), ("1.2K", None)])
def test_reviews(spark, text, n):
    assert extract_one(spark, card(reviews=text))[0].total_reviews == n


@pytest.mark.parametrize("extra,kind", [("<span>SPONSORED</span>", "Sponsored"),
                                        ("", "Organic"),
                                        ("<span>Sponsored <b>ad</b></span>", "Organic")])
def test_listing_type(spark, extra, kind):
    assert extract_one(spark, card(extra=extra))[0].listing_type == kind


def test_text_nodes_stripped_and_joined(spark):
    r = extract_one(spark, card(name='<span class="a-size-medium">Dell <b>15</b> x</span>'))[0]
    assert r.product_name == "Dell15x"


def test_keyword_page_and_minute_from_archive(spark):
    r = extract_one(spark, card())[0]
    assert (r.search_keyword, r.page_scraped) == ("gaming laptops", 2)
    assert r.scraped_at == dt.datetime(2024, 5, 6, 7, 8)


def test_blocked_page_has_no_cards(spark):
    assert extract_one(spark, card(), status=503) == []


def test_page_classes(spark):
    rows = [(1, URL, "<html>Please enter the characters you see</html>", None, None),
            (2, URL, '<span class="x">No results for "zzz"</span>', None, None),
            (3, URL, "<html><body>nothing</body></html>", None, None),
            (4, URL, card(), None, None),
            (5, URL, card(), 503, None),
            (6, "not a url", None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, "
                                        "http_status int, fetched_at timestamp_ntz")
    got = {r.page_id: (r.status, r.n_cards) for r in page_status(pages).collect()}
    assert got == {1: ("challenge", 0), 2: ("exhausted", 0), 3: ("empty", 0),
                   4: ("ok", 1), 5: ("blocked", 0), 6: ("empty", 0)}
    r = page_status(pages).filter("page_id = 6").first()
    assert r.search_keyword is None and r.page_num is None


def test_round_trip_through_rendered_pages(spark):
    from tests.conftest import SF_SMALL
    from pyspark.sql import functions as F
    from bazaarlens.functions.keywords import keyword_rank
    from bazaarlens.sources.tables import read_raw
    raw = read_raw(spark, SF_SMALL)
    got = extract_cards(render_pages(raw))
    rank = keyword_rank(F.col("search_keyword"))
    want = (raw.withColumn("kr", rank)
            .filter("price_inr >= 1 AND (product_name IS NOT NULL OR brand IS NOT NULL)")
            .filter("id % 37 != 0 AND NOT (kr = 2 AND page_scraped = 15) AND NOT (kr = 3 AND "
                    "page_scraped = 12) AND NOT (kr = 4 AND page_scraped = 18) AND NOT (kr = 5 "
                    "AND page_scraped IN (9, 10))")
            .withColumn("total_reviews", F.expr("CASE WHEN id % 41 != 0 THEN total_reviews END")))
    assert got.count() == want.count()
    # every extracted card maps back to its source asin, keyword and page
    a = got.select("asin", "search_keyword", "page_scraped", "rating", "total_reviews")
    b = want.select("asin", "search_keyword", "page_scraped", "rating", "total_reviews")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pages_bounded_by_id_span(spark):
    from tests.conftest import SF_SMALL
    from bazaarlens.sources.tables import read_raw
    from pyspark.sql import functions as F
    pages = render_pages(read_raw(spark, SF_SMALL), span=5600)
    n = pages.select(F.regexp_count("html", F.lit("s-search-result")).alias("n"))
    assert n.agg(F.max("n")).first()[0] <= 40


def test_every_class_and_reason_occurs(spark):
    from tests.conftest import SF_SMALL
    from bazaarlens.plans.registry import QUERIES
    classes = {r.status for r in QUERIES["page_status"](spark, SF_SMALL).collect()}
    assert classes == {"blocked", "challenge", "exhausted", "empty", "ok"}
    from pyspark.sql import functions as F
    sums = QUERIES["card_rejects"](spark, SF_SMALL).agg(
        *[F.sum(c).alias(c) for c in ("kept", "no_asin", "no_name", "no_price")]).first()
    assert all(v > 0 for v in sums)
    stops = {r.stop_reason for r in QUERIES["crawl_cutoff"](spark, SF_SMALL).collect()}
    assert stops == {"blocked", "exhausted", "empty run", "max pages"}


def test_first_sightings_stop_where_the_crawl_does(spark):
    from bazaarlens.operators.extract import listings_from_archive
    u = "https://shop.example/s?k=laptops&page={}"
    rows = [(1, u.format(1), card(asin="A"), 200, TS), (2, u.format(2), card(asin="B"), 503, TS),
            (3, u.format(3), card(asin="C"), 200, TS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, "
                                        "http_status int, fetched_at timestamp_ntz")
    assert [r.asin for r in listings_from_archive(pages).collect()] == ["A"]


def test_card_rejects_counts_first_reason(spark):
    from bazaarlens.operators.extract import card_rejects
    html = "".join([card(), card(asin=""), card(name=""), card(price=None),
                    card(asin="", price=None)])
    pages = spark.createDataFrame([(7, URL, html, 200, TS)],
                                  "page_id long, url string, html string, http_status int, "
                                  "fetched_at timestamp_ntz")
    r = card_rejects(pages).first()
    assert (r.page_id, r.cards, r.kept, r.no_asin, r.no_name, r.no_price) == (7, 5, 1, 2, 1, 1)


def test_listings_from_archive_first_sighting_and_ids(spark):
    from bazaarlens.operators.extract import listings_from_archive
    u = "https://shop.example/s?k=laptops&i=computers&s=review-rank&page={}"
    g = "https://shop.example/s?k=gaming+laptops&i=computers&s=review-rank&page=1"
    rows = [(10, u.format(2), card(asin="A", price="50,000.") + card(asin="C"), 200, TS),
            (11, u.format(1), card(asin="B") + card(asin="A", price="40,000.")
             + card(asin="B", price="1."), 200, TS),
            (12, g, card(asin="C", price="7,000.") + card(asin="D", price=None), 200, TS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, "
                                        "http_status int, fetched_at timestamp_ntz")
    got = [(r.id, r.asin, str(r.price_inr), r.page_scraped)
           for r in listings_from_archive(pages).orderBy("id").collect()]
    # crawl order: laptops p1 (B, A, B), laptops p2 (A, C), gaming p1 (C, D: no price)
    assert got == [(1, "B", "45990.00", 1), (2, "A", "40000.00", 1), (3, "C", "45990.00", 2)]


def test_markers_are_searched_in_markup_once(spark):
    """Any marker in any letter case, letters of A-Z and a-z alone alike. Markup is
    put in lower case once, and the pattern needs its words to be there."""
    rows = [(1, URL, "₹ <b>CaptchA</b>", 200, None), (2, URL, "ENTER THE Characters", None, None),
            (3, URL, '<SPAN\nid=x>\n é No Results FOR "zzz"', 200, None),
            (4, URL, "<span><b>no results for</b></span>", 200, None),
            (5, URL, "<ſpan>no results for", 200, None), (6, URL, "no reſults for", 200, None),
            (7, URL, None, 200, None), (8, URL, "captcha", 503, None), (None, URL, "", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, "
                                        "http_status int, fetched_at timestamp_ntz")
    status = page_status(pages)
    assert {r.page_id: r.status for r in status.collect()} == {
        1: "challenge", 2: "challenge", 3: "exhausted", 4: "empty", 5: "empty", 6: "empty",
        7: "empty", 8: "blocked", None: "empty"}
    plan = status._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("lower(html") == 1
    assert plan.index("contains(low") < plan.index("no results for") < plan.index("rlike")


def test_cards_do_not_move_by_keyword(spark, monkeypatch):
    """The rows on reached pages are kept by a broadcast of the stored stops."""
    from bazaarlens.operators import dedup
    from bazaarlens.operators.extract import listings_from_archive
    seen, plain = [], dedup.within_cutoff
    monkeypatch.setattr(dedup, "within_cutoff",
                        lambda cards, cutoff: seen.append(plain(cards, cutoff)) or seen[0])
    pages = spark.createDataFrame([(1, URL, card(), 200, TS)],
                                  "page_id long, url string, html string, http_status int, "
                                  "fetched_at timestamp_ntz")
    assert [r.asin for r in listings_from_archive(pages).collect()] == ["B0X"]
    plan = seen[0]._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
