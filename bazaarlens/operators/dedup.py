"""First-seen de-duplication and crawl bookkeeping as distributed jobs.

A crawl visits keywords in order, pages in order, cards in page order; the
first sighting of a product key wins. Here that order is data (keyword rank,
page, position) and every step is a shuffle on a key, never a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.keywords import KEYWORDS, keyword_rank

CRAWL_ORDER = ("keyword_rank", "search_keyword", "page_scraped", "id")


def with_crawl_order(df: DataFrame, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    return df.withColumn("keyword_rank", keyword_rank(F.col("search_keyword"), keywords))


def first_seen(df: DataFrame, key: str = "asin",
               order: Sequence[str | Column] = CRAWL_ORDER,
               keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """One row per key: the earliest in crawl order (ties broken by the last
    order column, which must be unique).

    In the default order the winners' ids are found first, on four narrow
    columns, and their rows fetched by a semi-join (see ``_winner_ids``). In any
    other order ``row_number() == 1`` lets Spark insert a partial
    WindowGroupLimit before the shuffle. Either way each map task ships at most
    one row per key: a key that holds a third of all rows costs one row per map
    task, not a third of the data in one reducer.
    """
    cols = df.columns
    if tuple(order) == CRAWL_ORDER and "keyword_rank" not in cols:
        return df.join(_winner_ids(df, key, keywords), "id", "left_semi").select(*cols)
    return _first_in_window(df, key, order, keywords)


def _position() -> Column:
    """Rank, page (null first) and id of a row of a known keyword as one exact
    number of fixed width, so that its minimum is a hash aggregate."""
    def part(c: Column, digits: int) -> Column:
        return c.cast(f"decimal({digits},0)")

    def shifted(c: Column, zeros: int) -> Column:
        return c * part(F.lit("1" + "0" * zeros), zeros + 1)

    page = F.coalesce(F.col("page_scraped").cast("bigint") + F.lit(2 ** 31 + 1), F.lit(0))
    row = part(F.col("id"), 20) + part(F.lit(str(2 ** 63)), 20)
    return (shifted(part(F.col("keyword_rank"), 7), 30) + shifted(part(page, 10), 20)
            + row).cast("decimal(38,0)")


def _winner_ids(df: DataFrame, key: str, keywords: Sequence[str]) -> DataFrame:
    """Ids of the first sightings in crawl order. Only key, keyword, page and id
    are read, and nothing is sorted but rows of keywords outside the list, whose
    order is by name; they count for keys without a row of a listed keyword."""
    narrow = with_crawl_order(df.select(key, "search_keyword", "page_scraped", "id"), keywords)
    listed = F.col("search_keyword").isin(*keywords)
    known = (narrow.filter(listed).select(key, "id", _position().alias("_at"))
             .groupBy(key).agg(F.min_by("id", "_at").alias("id")))
    others = narrow.filter(F.col("search_keyword").isNull() | ~listed)
    seen = known.select(F.col(key).alias("_seen"))
    rest = _first_in_window(others, key, CRAWL_ORDER, keywords).join(
        seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
    return known.select("id").unionByName(rest.select("id"))


def _first_in_window(df: DataFrame, key: str, order: Sequence[str | Column],
                     keywords: Sequence[str]) -> DataFrame:
    cols = df.columns
    ranked = with_crawl_order(df, keywords) if "keyword_rank" not in cols else df
    w = Window.partitionBy(key).orderBy(*[F.col(c) if isinstance(c, str) else c
                                          for c in order])
    return (ranked.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1)
            .select(*cols))


def page_counts(df: DataFrame, key: str = "asin",
                keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Per (keyword, page): cards, and cards whose key is on no earlier page.

    Plan: partial and final aggregate to one row per (key, page) - a hot key
    collapses map-side; a window per key over those rows (at most one per page
    the key is on) finds its first page; an aggregate per page."""
    ranked = with_crawl_order(df, keywords)
    page = ["keyword_rank", "search_keyword", "page_scraped"]
    per_key_page = ranked.groupBy(key, *page).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(*page)).over(Window.partitionBy(key))
    flagged = per_key_page.withColumn("is_new", first == F.struct(*page))
    return (flagged.groupBy(*page)
            .agg(F.sum("n").alias("products"),
                 F.sum(F.when(F.col("is_new"), F.col("n")).otherwise(0)).alias("new_products")))


def page_yield(df: DataFrame, key: str = "asin",
               keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Per (keyword, page): cards, new keys, repeats, running total of new.

    "New" means the key was not seen on an earlier page, so repeats within
    one page all count as new (the crawl tests a whole page before adding
    it to the seen set). The running total is a window per keyword on top of
    the totals of the keywords before it; only keyword totals, a row per
    search keyword, are summed up in one place."""
    per_page = page_counts(df, key, keywords)
    before = Window.orderBy("keyword_rank", "search_keyword") \
        .rowsBetween(Window.unboundedPreceding, -1)
    ahead = (per_page.groupBy("keyword_rank", "search_keyword")
             .agg(F.sum("new_products").alias("total"))
             .select(F.col("keyword_rank").alias("kr"), F.col("search_keyword").alias("kw"),
                     F.coalesce(F.sum("total").over(before), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("keyword_rank", "search_keyword").orderBy("page_scraped") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = per_page.withColumn("upto", F.sum("new_products").over(inside))
    same = (F.col("keyword_rank") == F.col("kr")) & F.col("search_keyword").eqNullSafe(F.col("kw"))
    return rows.join(ahead, same).select(
        "search_keyword", "page_scraped",
        F.col("products").cast("bigint").alias("products"),
        F.col("new_products").cast("bigint").alias("new_products"),
        (F.col("products") - F.col("new_products")).cast("bigint").alias("duplicates"),
        (F.col("ahead") + F.col("upto")).cast("bigint").alias("running_total"))


# Page classes that stop a keyword's crawl, and the most pages
# the crawl visits for a keyword.
STOP_STATUSES = ("blocked", "exhausted")
MAX_PAGES = 20

BLOCK_PAGES = 1000   # page numbers of one keyword that one window sees


def _block_summaries(page_stats: DataFrame, run: int, block: int) -> DataFrame:
    """One row per keyword and block of page numbers: visits, products, visits
    without products at its end (``trail``), pages of the first such visits
    (``lead``, fewer than ``run``), and the first stop that the block shows by
    itself, with the products up to it."""
    inside = Window.partitionBy("search_keyword", "block").orderBy("page_scraped") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = F.coalesce(F.col("products") > 0, F.lit(False))
    visits = (page_stats
              .withColumn("block", F.floor(F.col("page_scraped") / block))
              .withColumn("visit", F.count(F.lit(1)).over(inside))
              .withColumn("last_full", F.max(F.when(full, F.col("visit"))).over(inside))
              .withColumn("so_far", F.sum("products").over(inside)))
    empty_run = F.col("visit") - F.coalesce("last_full", F.lit(0))
    hard_stop = F.coalesce(F.col("status").isin(*STOP_STATUSES), F.lit(False))
    reason = F.when(hard_stop, F.col("status")).when(empty_run >= run, F.lit("empty run"))
    page = F.col("page_scraped")
    leading = F.col("last_full").isNull() & (F.col("visit") < run)
    stop = F.when(F.col("reason").isNotNull(), page)
    return (visits.withColumn("reason", reason)
            .groupBy("search_keyword", "block")
            .agg(F.count(F.lit(1)).alias("visits"), F.sum("products").alias("products"),
                 F.max("last_full").alias("last_full"), F.max(page).alias("last_page"),
                 F.array_sort(F.collect_list(F.when(leading, page))).alias("lead"),
                 F.min(stop).alias("stop"), F.min_by("reason", stop).alias("reason"),
                 F.min_by("so_far", stop).alias("kept"))
            .withColumn("trail", F.col("visits") - F.coalesce("last_full", F.lit(0))))


def crawl_cutoff(page_stats: DataFrame, run: int = 2, max_pages: int | None = MAX_PAGES,
                 block: int = BLOCK_PAGES) -> DataFrame:
    """Where each keyword's crawl stops.

    ``page_stats``: (search_keyword, page_scraped, products, status), one row
    per visited page, pages without products included; pages above ``max_pages``
    are not visited (None: no limit). A keyword stops after a blocked or exhausted
    page, or at the ``run``-th visit in a row without products; otherwise at its
    last page. Visits are counted, not page numbers.

    A keyword's pages are dealt over tasks in blocks of ``block`` page numbers,
    each summed up in one row; how many visits without products end the blocks
    before decides whether a block's first visits complete a run. The window over
    a keyword sees one row a block."""
    visited = page_stats if max_pages is None \
        else page_stats.filter(F.col("page_scraped") <= max_pages)
    blocks = _block_summaries(visited, run, block)
    before = Window.partitionBy("search_keyword").orderBy("block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("search_keyword").orderBy("block") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("search_keyword")
    # visits up to the last one with products, seen from the end of each block
    blocks = blocks.withColumn("full_until", F.when(
        F.col("last_full").isNotNull(), F.sum("visits").over(here) - F.col("trail")))
    carry = (F.coalesce(F.sum("visits").over(before), F.lit(0))
             - F.coalesce(F.max("full_until").over(before), F.lit(0)))
    blocks = blocks.withColumn("carry", carry).withColumn("joined", F.when(
        (F.col("carry") > 0) & (F.col("carry") < run),
        F.try_element_at("lead", (F.lit(run) - F.col("carry")).cast("int"))))
    joins = F.col("joined").isNotNull() & (F.col("stop").isNull()
                                           | (F.col("joined") < F.col("stop")))
    blocks = (blocks.withColumn("reason", F.when(joins, F.lit("empty run"))
                                .otherwise(F.col("reason")))
              .withColumn("kept", F.when(joins, F.lit(0)).otherwise(F.col("kept")))
              .withColumn("stop", F.least("stop", "joined")))
    blocks = blocks.withColumn("first_stop", F.min("stop").over(whole))
    counted = (F.when(F.col("stop") == F.col("first_stop"), F.col("kept"))
               .when(F.col("first_stop").isNull() | (F.col("last_page") < F.col("first_stop")),
                     F.col("products")))
    return (blocks.groupBy("search_keyword")
            .agg(F.coalesce(F.min("stop"), F.max("last_page")).cast("int").alias("stop_page"),
                 F.coalesce(F.min_by("reason", "stop"), F.lit("max pages")).alias("stop_reason"),
                 F.coalesce(F.sum(counted), F.lit(0)).cast("bigint").alias("products_kept")))


def page_stats(status: DataFrame, cards: DataFrame) -> DataFrame:
    """Stop-rule input from page classes and kept cards: one row per visited
    (keyword, page), with its kept products and its worst class. Archived pages
    whose address names no keyword or page are not visits of a crawl.

    ``status``: search_keyword, page_num, status; ``cards``: listing rows."""
    worst = F.coalesce(*[F.max(F.when(F.col("status") == s, F.lit(s))) for s in STOP_STATUSES],
                       F.max("status"))
    pages = (status.filter(F.col("page_num").isNotNull() & F.col("search_keyword").isNotNull())
             .groupBy("search_keyword", F.col("page_num").alias("page_scraped"))
             .agg(worst.alias("status")))
    kept = cards.groupBy(F.col("search_keyword").alias("kw"), F.col("page_scraped").alias("page")) \
        .agg(F.count(F.lit(1)).alias("n"))
    same = F.col("search_keyword").eqNullSafe(F.col("kw")) & (F.col("page_scraped") == F.col("page"))
    return pages.join(kept, same, "left").select(
        "search_keyword", "page_scraped", F.coalesce("n", F.lit(0)).alias("products"), "status")


def within_cutoff(cards: DataFrame, cutoff: DataFrame) -> DataFrame:
    """Rows on pages that the crawl reached before it stopped."""
    stop = cutoff.select(F.col("search_keyword").alias("kw"), "stop_page")
    return (cards.join(stop, F.col("search_keyword").eqNullSafe(F.col("kw"))
                       & (F.col("page_scraped") <= F.col("stop_page")), "left_semi"))


def incremental_new(new: DataFrame, seen: DataFrame, key: str = "asin",
                    order: Sequence[str | Column] = CRAWL_ORDER) -> DataFrame:
    """First sightings in ``new`` of keys that ``seen`` does not hold.

    ``new`` is reduced to one row per key first (limited map-side) and so is
    ``seen`` (partial aggregation): a hot key is one row on either side of the
    anti-join."""
    fresh = first_seen(new, key, order)
    return fresh.join(seen.select(key).distinct(), key, "left_anti").select(*new.columns)


def resume_crawl(seen: DataFrame, new: DataFrame, key: str = "asin") -> DataFrame:
    """Resume after a checkpoint: the earlier rows, then the new first sightings."""
    return seen.unionByName(incremental_new(new, seen, key))
