"""Fixture: listing rows rendered as archived search-result pages.

The driver's ``pages`` hold no product cards, so the extraction runs over
pages made from the listing rows by a fixed recipe, with the cases a real
archive has: refused, challenge, exhausted and empty pages; cards without
ASIN, names in other tags, linked labels, unreadable review counts, commented
and nested cards, signs and quotes inside attributes, extra blanks in classes.
Not an operator: nothing outside the stored page archive uses it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.keywords import KEYWORDS, keyword_rank

# A page holds the cards of one (keyword, page) whose ids fall in one span of
# this many ids: ids are unique, so no page can exceed this many cards.
PAGE_ID_SPAN = 5600
# Search URL form (keyword, then page, appended).
SEARCH_URL_HEAD = "https://shop.example/s?k="
SEARCH_URL_MID = "&i=computers&s=review-rank&page="

# Pages that are not plain result pages, by (keyword rank, page).
BLOCKED = ((2, 15),)
CHALLENGE = ((3, 12),)
EXHAUSTED = ((4, 18),)
EMPTY = ((5, 9), (5, 10))


def _at(places) -> Column:
    out = F.lit(False)
    for rank, page in places:
        out = out | ((F.col("kr") == rank) & (F.col("page_scraped") == page))
    return out


def _esc(col: Column) -> Column:
    out = F.replace(col, F.lit("&"), F.lit("&amp;"))
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def card_html() -> Column:
    """One listing row (the raw listing columns) as a search-result card."""
    def opt(cond: Column, *parts) -> Column:
        return F.when(cond, F.concat(*parts)).otherwise(F.lit(""))

    def every(n: int) -> Column:
        return F.col("id") % n == 0

    name, brand = F.col("product_name"), F.col("brand")
    price, mrp = F.col("price_inr"), F.col("original_price_inr")
    named = F.when(every(23), F.concat(F.lit("<h2>"), _esc(name), F.lit("</h2>"))) \
        .when(every(29), F.concat(F.lit('<span class="a-size-base-plus x">'), _esc(name),
                                  F.lit("</span>"))) \
        .otherwise(F.concat(F.lit('<h2 class="a-size-mini"><a href="#">'
                                  '<span class="a-size-medium  a-color-base a-text-normal">'),
                            _esc(name), F.lit("</span></a></h2>")))
    label = F.when(every(3), F.lit('<span class="puis-label-popover"><a href="#">Sponsored</a></span>')) \
        .otherwise(F.lit('<span class="puis-label-popover"><span>Sponsored</span></span>'))
    return F.concat(
        opt(every(31), F.lit('<!-- <div data-component-type="s-search-result" data-asin="GONE">'
                             '<span class="a-size-medium">Old</span></div> -->')),
        F.when(every(7), F.lit('<div title="a > b, \'c\'" data-x=\'{ class="a-price-whole" }\' ')) \
         .otherwise(F.lit("<div ")),
        F.lit('data-asin="'), F.when(every(37), F.lit(" ")).otherwise(_esc(F.col("asin"))),
        F.when(every(11), F.lit('" DATA-COMPONENT-TYPE = "s-search-result" class="s-result-item">')) \
         .otherwise(F.lit('" data-component-type="s-search-result" class="s-result-item">')),
        opt(name.isNotNull(), named),
        opt(brand.isNotNull(), F.lit('<span class=" a-size-base-plus   a-color-base ">'),
            _esc(brand), F.lit("</span>")),
        opt(price.isNotNull(), F.lit('<span class="a-price"><span class="a-price-whole">'),
            F.format_number(F.floor(price), 0), F.lit('.</span><span class="a-price-fraction">'),
            F.lpad(((price - F.floor(price)) * 100).cast("int").cast("string"), 2, "0"),
            F.lit("</span></span>")),
        opt(mrp.isNotNull(), F.lit('<span class="a-price  a-text-price"><span class="a-offscreen">'
                                   '₹'), F.format_number(mrp, 2), F.lit("</span></span>")),
        opt(F.col("rating").isNotNull(), F.lit('<i class="a-icon"><span class="a-icon-alt">'),
            F.col("rating").cast("string"), F.lit(" out of 5 stars</span></i>")),
        opt(F.col("total_reviews").isNotNull(), F.lit('<span class="a-size-base" dir="auto">'),
            F.when(every(41), F.lit("1.2K")).otherwise(F.format_number(F.col("total_reviews"), 0)),
            F.lit("</span>")),
        opt(F.col("listing_type") == "Sponsored", label),
        # an inner card without name and price: found, and skipped
        opt(every(43), F.lit('<div data-component-type="s-search-result" data-asin="INNER"></div>')),
        F.lit("</div>"))


def render_pages(listings: DataFrame, span: int = PAGE_ID_SPAN,
                 keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Listings -> archived pages: one page per (keyword, page, id span), cards
    in id order. Page ids encode (id span, keyword rank, page): fixture rows
    have listed keywords and pages up to 9,999."""
    kr = keyword_rank(F.col("search_keyword"), keywords)
    pages = (listings
             .select("search_keyword", "page_scraped", "id", "scraped_at", kr.alias("kr"),
                     F.floor(F.col("id") / span).alias("chunk"), card_html().alias("card"))
             .groupBy("search_keyword", "page_scraped", "kr", "chunk")
             .agg(F.array_sort(F.collect_list(F.struct("id", "card"))).alias("cards"),
                  F.min("scraped_at").alias("fetched_at")))
    results = F.array_join(F.transform("cards", lambda c: c["card"]), "")
    body = (F.when(_at(CHALLENGE), F.lit("<form>Enter the characters you see below</form>"))
             .when(_at(EXHAUSTED), F.concat(F.lit("<span>No results for "),
                                            _esc(F.col("search_keyword")), F.lit("</span>")))
             .when(_at(EMPTY), F.lit("<p></p>"))
             .otherwise(results))
    url = F.concat(F.lit(SEARCH_URL_HEAD), F.url_encode(F.col("search_keyword")),
                   F.lit(SEARCH_URL_MID), F.col("page_scraped").cast("string"))
    page_id = -(F.col("chunk") * 1_000_000 + F.col("kr") * 10_000 + F.col("page_scraped")) - 1
    return pages.select(
        page_id.cast("bigint").alias("page_id"), url.alias("url"),
        F.concat(F.lit("<!DOCTYPE html><html><body><div class=\"s-main-slot\">"), body,
                 F.lit("</div></body></html>")).alias("html"),
        F.when(_at(BLOCKED), F.lit(503)).otherwise(F.lit(200)).alias("http_status"),
        F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"))
