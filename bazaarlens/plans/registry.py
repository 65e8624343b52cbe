"""Named queries: each key binds (spark, sf_dir) -> DataFrame.

Inputs are always the whole driver tables (or data Spark derives from
them). ``laptops_raw`` (derived from ``orders``) and ``laptops_cleaned``
are written once per input as Parquet in the shared checkpoint folder, as a
loaded table and a create-table-as-select; every report then starts from a
Parquet scan with pushed filters and only the columns it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.keywords import KEYWORDS
from bazaarlens.operators import clean as C
from bazaarlens.operators import dedup as D
from bazaarlens.operators import extract as X
from bazaarlens.operators import insights as B
from bazaarlens.operators import mart_state as S
from bazaarlens.operators import marts as V
from bazaarlens.operators import measures as I
from bazaarlens.operators import quality as Q
from bazaarlens.operators import report as R
from bazaarlens.operators.checkpoint import checkpoint_crawl, read_checkpoint
from bazaarlens.plans import catalog as K
from bazaarlens.plans import materialize as M
from bazaarlens.session import scratch_path
from bazaarlens.sources.csv import load_csv, load_rejects
from bazaarlens.sources.keys import keyed_load
from bazaarlens.sources.schema import LISTING_SCHEMA
from bazaarlens.sources.tables import read_table
from bazaarlens.streaming.first_seen import read_first_seen, start_first_seen

QueryFn = Callable[[SparkSession, str], DataFrame]

# Resume point for the incremental job: keywords up to this rank are in the
# checkpoint, the rest are the new crawl.
RESUME_AFTER_KEYWORDS = 3


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_raw``: the listings derived from ``orders``, stored once."""
    return M.raw_table(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning projection itself, evaluated over the stored raw table."""
    return C.clean(raw(spark, sf_dir))


def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_cleaned``: created once from ``laptops_raw``, read by reports."""
    return M.cleaned_table(spark, sf_dir)


def _on_cleaned(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(cleaned_table(spark, sf_dir))


def _on_bucketed(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(K.raw_bucketed(spark, sf_dir))


def _on_raw(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(raw(spark, sf_dir))


_registered: dict[str, str] = {}   # by application id and session


def _ensure_marts(spark: SparkSession, sf_dir: str) -> None:
    """Define the mart views over this input's cleaned table, once per
    session and input (views are metadata: re-defining costs analysis)."""
    path = M.cleaned_table_path(spark, sf_dir)
    key = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"
    if _registered.get(key) != path or not all(
            spark.catalog.tableExists(n) for n in V.MARTS):
        V.register_marts(spark, cleaned_table(spark, sf_dir))
        _registered[key] = path


def _via_view(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _ensure_marts(spark, sf_dir)
        return spark.table(name)
    return run


def _list_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ensure_marts(spark, sf_dir)
    return V.list_marts(spark)


def _split_for_resume(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the finished keywords, all other rows; null keywords are new)."""
    done = F.coalesce(F.col("search_keyword").isin(KEYWORDS[:RESUME_AFTER_KEYWORDS]), F.lit(False))
    return df.filter(done), df.filter(~done)


def _incremental_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, new = _split_for_resume(K.raw_bucketed(spark, sf_dir))
    return D.incremental_new(new, seen)


def _resume_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, new = _split_for_resume(raw(spark, sf_dir))
    return D.resume_crawl(D.first_seen(seen), new)


def _crawl_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop rules over the archive's result pages: page classes and kept cards."""
    cards = M.parsed_cards(spark, sf_dir)
    status = X.page_status(archived_pages(spark, sf_dir), cards)
    return D.crawl_cutoff(D.page_stats(status, X.kept_cards(cards)))


def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page archive: the driver's ``pages`` table plus the listing rows
    rendered as search-result pages (the driver's pages hold no cards)."""
    return M.page_archive(spark, sf_dir)


def _page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.page_status(archived_pages(spark, sf_dir), M.parsed_cards(spark, sf_dir))


def _extract_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.kept_cards(M.parsed_cards(spark, sf_dir))


def _card_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.reject_counts(M.parsed_cards(spark, sf_dir))


def _archive_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.archive_listings_table(spark, sf_dir)


def _archive_kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole crawl flow: archive -> listings (stored once, as the
    crawl's raw table) -> clean -> headline KPIs."""
    return V.vw_kpi_summary(C.clean(M.archive_listings_table(spark, sf_dir)))


def _load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_csv(spark, M.raw_csv_path(spark, sf_dir))


def _load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of a flawed file cannot take (the file's place left out)."""
    return load_rejects(spark, M.flawed_csv_path(spark, sf_dir), header=False).drop(
        "file", "block_start")


def _merged(name: str) -> QueryFn:
    """A mart from the merged states of two loads (the keywords of the resume)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, "mart-state")
        for part in _split_for_resume(cleaned_table(spark, sf_dir)):
            state = S.update_state(part, folder)
        return S.STATE_MARTS[name](state)
    return run


def _export_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LISTING_SCHEMA).parquet(M.export_path(spark, sf_dir))


def _surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.keyed_table(spark, sf_dir)


def _stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sightings by the stream over the landed files, in two micro-batches;
    the stream runs in the query, with state and sink of its own."""
    work = scratch_path(spark, "first-seen")
    start_first_seen(spark, M.landing_path(spark, sf_dir), f"{work}/sink", f"{work}/ckpt",
                     batch_files=M.LANDING_FILES // 2).awaitTermination()
    return read_first_seen(spark, f"{work}/sink")


def _crawl_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl that ends after three keywords, and a second run that resumes."""
    path = scratch_path(spark, "crawl-checkpoint")
    checkpoint_crawl(raw(spark, sf_dir), path, at_most=RESUME_AFTER_KEYWORDS)
    checkpoint_crawl(raw(spark, sf_dir), path)
    return read_checkpoint(spark, path)


def _surrogate_key_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one table: the keys of the second continue the first's."""
    table = f"{scratch_path(spark, 'keyed-loads')}/table"
    for part in _split_for_resume(raw(spark, sf_dir)):
        keyed_load(part, ["id"], table)
    return spark.read.parquet(table)


def _crawl_cutoff_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop rules over keywords of thousands of pages (visits derived from
    ``orders``), which are dealt over tasks in blocks."""
    visits = read_table(spark, sf_dir, "orders").select(
        F.expr("concat('long ', o_orderkey % 3)").alias("search_keyword"),
        F.expr("cast(o_orderkey div 3 as int)").alias("page_scraped"),
        F.expr("cast(o_custkey % 60 as bigint)").alias("products"),
        F.expr("if(o_orderkey % 9973 = 0, 'blocked', 'ok')").alias("status"))
    return D.crawl_cutoff(visits, max_pages=None)


def _dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dq_reconcile(raw(spark, sf_dir), cleaned_table(spark, sf_dir))


QUERIES: dict[str, QueryFn] = {
    # extraction from archived pages
    "page_status": _page_status,
    "extract_cards": _extract_cards,
    "card_rejects": _card_rejects,
    "archive_listings": _archive_listings,
    "archive_kpi_summary": _archive_kpi_summary,
    # sources / catalog
    "raw_count": _on_raw(Q.raw_count),
    "load_csv": _load_csv,
    "load_rejects": _load_rejects,
    "export_raw": _export_raw,
    "surrogate_key": _surrogate_key,
    "surrogate_key_loads": _surrogate_key_loads,
    "cleaned": cleaned,
    "cleaned_stored": K.cleaned_bucketed,
    "clean_removed": _on_raw(C.clean_removed),
    "list_marts": _list_marts,
    # data quality
    "dq_profile": _on_raw(Q.dq_profile),
    "dq_duplicates": _on_bucketed(Q.dq_duplicates),
    "dq_reconcile": _dq_reconcile,
    # market questions
    "brand_leaderboard": _on_cleaned(B.brand_leaderboard),
    "segment_popularity": _on_cleaned(B.segment_popularity),
    "top_rated": _on_cleaned(B.top_rated),
    "brand_discount": _on_cleaned(B.brand_discount),
    "best_value": _on_cleaned(B.best_value),
    "rating_distribution": _on_cleaned(B.rating_distribution),
    "segment_rating": _on_cleaned(B.segment_rating),
    "listing_performance": _on_cleaned(B.listing_performance),
    "keyword_quality": _on_cleaned(B.keyword_quality),
    "brand_positioning": _on_cleaned(B.brand_positioning),
    # reporting marts, read through their registered views
    **{name: _via_view(name) for name in V.MARTS},
    # the grouped marts, kept up to date over two loads
    **{name.replace("vw_", "merged_"): _merged(name) for name in S.STATE_MARTS},
    # dedup and crawl bookkeeping
    "first_seen": _on_bucketed(D.first_seen),
    "page_yield": _on_raw(D.page_yield),
    "crawl_cutoff": _crawl_cutoff,
    "crawl_cutoff_long": _crawl_cutoff_long,
    "crawl_checkpoint": _crawl_checkpoint,
    "incremental_new": _incremental_new,
    "resume_crawl": _resume_crawl,
    "stream_first_seen": _stream_first_seen,
    # run report
    "run_report": _on_raw(R.run_report),
    "keyword_breakdown": _on_raw(R.keyword_breakdown),
    "run_preview": _on_raw(R.run_preview),
    # insights and dashboard measures
    "dominant_segment": _on_cleaned(I.dominant_segment),
    "premium_share": _on_cleaned(I.premium_share),
    "discount_extremes": _on_cleaned(I.discount_extremes),
    "top_rated_brand": _on_cleaned(I.top_rated_brand),
    "below_average_share": _on_cleaned(I.below_average_share),
    "high_rated_share": _on_cleaned(I.high_rated_share),
    "brand_share": _on_cleaned(I.brand_share),
    "price_discount_points": _on_cleaned(I.price_discount_points),
}
