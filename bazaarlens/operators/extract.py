"""Product cards from archived search-result pages, as one narrow job.

``pages(page_id, url, html, http_status, fetched_at)`` -> one row per kept
card with the raw listing columns. The only Python is the per-page card
finder (``mapInArrow``, Arrow batches in and out); it returns raw strings, and every
coercion (digits-only price, currency-stripped MRP, first number of the
rating text, comma-free review count, discount, keyword and page from the
URL, minute timestamp) is a native column expression. Parsing is
partition-local: no shuffle between the page scan and the card rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.functions.cards import CARD_ATTR, FIELDS, parse_cards
from bazaarlens.functions.keywords import KEYWORDS, keyword_rank
from bazaarlens.session import scratch_path
from bazaarlens.sources.schema import CARD_FIELDS_SCHEMA, LISTING_SCHEMA, PAGE_ARCHIVE_SCHEMA

# Page classification (case-insensitive body markers).
CHALLENGE_MARKERS = ("captcha", "enter the characters")
NO_RESULTS_MARKER = "no results for"
NO_RESULTS_PATTERN = rf"(?i)<span[^>]*>[^<]*{NO_RESULTS_MARKER}"
KEYWORD_PATTERN = r"[?&]k=([^&#]*)"
PAGE_PATTERN = r"[?&]page=([0-9]+)"
OK_STATUS = 200

CARD_SCHEMA = T.StructType(CARD_FIELDS_SCHEMA.fields + [
    T.StructField("url", T.StringType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
])
_ARROW_TYPES = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(),
                T.BooleanType: pa.bool_(), T.TimestampNTZType: pa.timestamp("us")}
_CARD_ARROW = pa.schema([pa.field(f.name, _ARROW_TYPES[type(f.dataType)]) for f in CARD_SCHEMA.fields])


def as_page_archive(pages: DataFrame) -> DataFrame:
    """Give a bare (page_id, url, html) table the archive's optional columns."""
    cols = []
    for f in PAGE_ARCHIVE_SCHEMA.fields:
        cols.append(F.col(f.name).cast(f.dataType) if f.name in pages.columns
                    else F.lit(None).cast(f.dataType).alias(f.name))
    return pages.select(*cols)


def keyword_from_url(url: Column) -> Column:
    raw = F.nullif(F.regexp_extract(url, KEYWORD_PATTERN, 1), F.lit(""))
    return F.try_url_decode(raw)


def page_from_url(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, PAGE_PATTERN, 1), F.lit("")).try_cast("int")


def page_status(pages: DataFrame, cards: DataFrame | None = None) -> DataFrame:
    """Classify each archived page: blocked, challenge, exhausted, empty, ok.

    ``cards``: the parsed cards of these pages, if they are stored; what counts
    as a card is decided by the card finder alone. Markup is put in lower case
    once and looked at before the join with the per-page counts, and does not
    travel; the pattern is tried on pages that hold its words alone."""
    low = F.col("low")
    challenge = F.lit(False)
    for m in CHALLENGE_MARKERS:
        challenge = challenge | low.contains(m)
    no_results = low.contains(NO_RESULTS_MARKER) & F.col("html").rlike(NO_RESULTS_PATTERN)
    flags = as_page_archive(pages).withColumn("low", F.lower("html")).select(
        "page_id", "url", "http_status",
        F.coalesce(challenge, F.lit(False)).alias("challenge"),
        F.coalesce(no_results, F.lit(False)).alias("no_results"))
    counts = (card_fields(pages) if cards is None else cards) \
        .groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    n_cards = F.coalesce("n", F.lit(0))
    status = (F.when(F.col("http_status") != OK_STATUS, F.lit("blocked"))
               .when(F.col("challenge"), F.lit("challenge"))
               .when((n_cards == 0) & F.col("no_results"), F.lit("exhausted"))
               .when(n_cards == 0, F.lit("empty"))
               .otherwise(F.lit("ok")))
    return flags.join(counts, "page_id", "left").select(
        "page_id", keyword_from_url(F.col("url")).alias("search_keyword"),
        page_from_url(F.col("url")).alias("page_num"),
        n_cards.cast("int").alias("n_cards"), status.alias("status"))


def _cards_of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of pages -> Arrow batches of cards (one output batch per
    input batch; columns are built straight from Python lists)."""
    for batch in batches:
        cols = {f.name: [] for f in CARD_SCHEMA.fields}
        page_ids = batch.column("page_id").to_pylist()
        urls = batch.column("url").to_pylist()
        htmls = batch.column("html").to_pylist()
        fetched = batch.column("fetched_at").to_pylist()
        for page_id, url, html, ts in zip(page_ids, urls, htmls, fetched):
            for pos, card in enumerate(parse_cards(html)):
                cols["page_id"].append(page_id)
                cols["pos"].append(pos)
                for f in FIELDS:
                    cols[f].append(card[f])
                cols["sponsored"].append(card["sponsored"])
                cols["broken"].append(card["broken"])
                cols["url"].append(url)
                cols["fetched_at"].append(ts)
        yield pa.RecordBatch.from_pydict(cols, schema=_CARD_ARROW)


def _ship_by_value() -> None:
    """Serialize this package's task code by value, so executors need not
    have it installed (no --py-files, no install on workers)."""
    from pyspark import cloudpickle

    import bazaarlens
    cloudpickle.register_pickle_by_value(bazaarlens)


def card_fields(pages: DataFrame) -> DataFrame:
    """Raw per-card strings of every page that was served (status 200 or unknown).
    Only pages that name the card marker reach Python."""
    _ship_by_value()
    p = as_page_archive(pages)
    served = F.col("http_status").isNull() | (F.col("http_status") == OK_STATUS)
    return (p.filter(served & F.col("html").contains(CARD_ATTR[1]))
            .select("page_id", "url", "html", "fetched_at")
            .mapInArrow(_cards_of_pages, CARD_SCHEMA))


def to_minute(ts: Column) -> Column:
    """Wall-clock timestamp truncated to the minute, with no time-zone step
    (``date_trunc`` would pass through the session zone and can shift a
    wall-clock time that falls in a daylight-saving gap)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.minute(ts), F.lit(0))


def _price(text: Column) -> Column:
    digits = F.regexp_replace(text, r"[,.]", "")
    return F.when(digits.rlike("^[0-9]+$"), digits.try_cast("decimal(10,2)"))


def _mrp(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[₹,]", "")).try_cast("decimal(10,2)")


def _rating(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(\d+\.?\d*)", 1), F.lit("")) \
        .try_cast("decimal(3,1)")


def _reviews(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, ",", "")).try_cast("int")


def _card_columns() -> dict[str, Column]:
    """Typed listing columns over the parser's raw strings (native only)."""
    name = F.coalesce("name_medium", "name_base_plus", "name_h2")
    first_word = F.element_at(F.split(name, r"\s+"), 1)
    price = _price(F.col("price_text"))
    mrp = _mrp(F.col("mrp_text"))
    discount = F.when((price > 0) & (mrp > 0) & (mrp > price),
                      F.round((mrp - price) / mrp * 100, 1))
    return {
        "asin": F.trim(F.col("asin_attr")),
        "product_name": name,
        "brand": F.coalesce(F.col("brand_text"), first_word),
        "price_inr": price,
        "original_price_inr": mrp,
        "discount_percent": discount,
        "rating": _rating(F.col("rating_text")),
        "total_reviews": _reviews(F.col("reviews_text")),
        "listing_type": F.when(F.col("sponsored"), F.lit("Sponsored")).otherwise(F.lit("Organic")),
        "search_keyword": keyword_from_url(F.col("url")),
        "page_scraped": page_from_url(F.col("url")),
        "scraped_at": to_minute(F.col("fetched_at")),
    }


def _reject_reason(cols: dict[str, Column]) -> Column:
    """First failed requirement of a card, NULL when the card is kept."""
    asin, name, price = cols["asin"], cols["product_name"], cols["price_inr"]
    return (F.when(F.col("broken"), F.lit("broken"))
             .when(asin.isNull() | (asin == ""), F.lit("no asin"))
             .when(name.isNull() | (name == ""), F.lit("no name"))
             .when(price.isNull() | (price <= 0), F.lit("no price")))


def extract_cards(pages: DataFrame) -> DataFrame:
    """Archived pages -> listing rows (LISTING_SCHEMA) plus page_id and pos.

    Cards without an ASIN, without a name, or without a positive price are
    skipped, as are cards the finder could not read (``broken``)."""
    return kept_cards(card_fields(pages))


def reject_counts(cards: DataFrame) -> DataFrame:
    """Per page with cards: cards found, kept, and skipped by first reason."""
    reason = _reject_reason(_card_columns())
    return (cards.select("page_id", reason.alias("reason"))
            .groupBy("page_id")
            .agg(F.count(F.lit(1)).alias("cards"),
                 F.count_if(F.col("reason").isNull()).alias("kept"),
                 F.count_if(F.col("reason") == "broken").alias("broken"),
                 F.count_if(F.col("reason") == "no asin").alias("no_asin"),
                 F.count_if(F.col("reason") == "no name").alias("no_name"),
                 F.count_if(F.col("reason") == "no price").alias("no_price")))


def card_rejects(pages: DataFrame) -> DataFrame:
    return reject_counts(card_fields(pages))


# Crawl order of extracted cards: keyword rank, page number, archived page, position.
CARD_ORDER = ("keyword_rank", "search_keyword", "page_scraped", "page_id", "pos")


def kept_cards(cards: DataFrame) -> DataFrame:
    """Parsed cards -> listing rows (LISTING_SCHEMA) plus page_id and pos."""
    cols = _card_columns()
    typed = [cols[f.name].cast(f.dataType).alias(f.name) for f in LISTING_SCHEMA.fields]
    return cards.filter(_reject_reason(cols).isNull()).select("page_id", "pos", *typed)


def cutoff_path(sorted_path: str) -> str:
    """Where ``listings_from_cards`` stores the stops of the crawl."""
    return f"{sorted_path}.cutoff"


def listings_from_cards(cards: DataFrame, status: DataFrame,
                        keywords: Sequence[str] = KEYWORDS,
                        sorted_path: str | None = None) -> DataFrame:
    """The crawl's own output as a raw listing table (RAW_SCHEMA).

    ``cards``: parsed cards, ``status``: page classes. Each keyword's pages up
    to where its crawl stops; of each ASIN the first sighting in crawl order;
    ids 1..N in crawl order, as an auto-increment key on load would be.
    Shuffles: per-page counts, one on the ASIN (first-seen) and one range sort
    for the ids; no single-task step. Where keywords stop is stored before cards
    are cut: its size is known then, a row per keyword is broadcast, and cards do
    not move to one task per keyword. ``sorted_path``: see ``surrogate_key``; the
    stops are stored beside it."""
    from bazaarlens.operators.dedup import crawl_cutoff, first_seen, page_stats, within_cutoff
    from bazaarlens.sources.keys import surrogate_key
    from bazaarlens.sources.schema import RAW_SCHEMA

    spark, kept = cards.sparkSession, kept_cards(cards)
    sorted_path = sorted_path or scratch_path(spark, "sorted")
    stops = crawl_cutoff(page_stats(status, kept))
    stops.write.parquet(cutoff_path(sorted_path))
    stops = spark.read.schema(stops.schema).parquet(cutoff_path(sorted_path))
    reached = within_cutoff(kept, stops).withColumn(
        "keyword_rank", keyword_rank(F.col("search_keyword"), keywords))
    unique = first_seen(reached, order=CARD_ORDER, keywords=keywords)
    keyed = surrogate_key(unique, list(CARD_ORDER), name="id", sorted_path=sorted_path)
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])


def listings_from_archive(pages: DataFrame, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Archive -> raw listing table: parse, classify, stop, de-duplicate, number."""
    cards = card_fields(pages)
    return listings_from_cards(cards, page_status(pages, cards), keywords)
