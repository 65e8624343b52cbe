"""Materialise once, query many: the stored tables reports read.

``laptops_raw`` is a loaded table and ``laptops_cleaned`` a create-table-as-
select; the page archive, its parsed cards and the crawl's own listing table
are stored the same way. All are Parquet tables in the shared checkpoint
folder, written once per input and reused by every query. A table is keyed by
every leaf file of its source (path, length, modification time), so a rewritten
part file gives a new table, and by the version of the code that defines it;
``rebuild`` replaces it on request. Storing also cuts lineage: a query's plan
starts at a Parquet scan with pushed filters and pruned columns.

A table is written into a private folder, marked complete by a file of its own
written last, and renamed into place. A failed or lost writer leaves only a
private folder without a marker; the next caller builds the table again. The
loser of a race deletes its private copy. A build runs its plan once, files are
as the plan is partitioned (split by rows where rows are large).
"""

from __future__ import annotations

import functools
import hashlib
import os
import pkgutil
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.clean import clean
from bazaarlens.operators.extract import (CARD_SCHEMA, as_page_archive, card_fields,
                                          cutoff_path, listings_from_cards, page_status)
from bazaarlens.session import checkpoint_root
from bazaarlens.sources.archive_fixture import render_pages
from bazaarlens.sources.schema import CLEANED_SCHEMA, PAGE_ARCHIVE_SCHEMA, RAW_SCHEMA
from bazaarlens.sources.tables import listings_from_orders, read_table, table_path

_lock = threading.RLock()
MARKER = "_COMPLETE"
TABLES_SUFFIX = ""            # a run that wants tables of its own sets this
LANDING_FILES = 4             # arrivals at the stream
ARCHIVE_PAGES_PER_FILE = 64   # pages are large rows: a few MB of markup a file


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


# Modules whose code defines the stored tables: a change to any of them gives
# new table names, so a stale table is never reused.
_DEFINING = ("sources/tables.py", "sources/schema.py", "sources/archive_fixture.py",
             "sources/keys.py", "sources/csv.py", "operators/clean.py", "operators/dedup.py",
             "operators/extract.py", "functions/brand.py", "functions/tiers.py",
             "functions/cards.py", "functions/keywords.py", "plans/materialize.py")


@functools.cache
def code_version() -> str:
    """Digest of the defining modules, read through the import system (also
    from a zip) when the first table is asked for. A module shipped without
    source counts with its name alone."""
    h = hashlib.sha1()
    for rel in _DEFINING:
        try:
            source = pkgutil.get_data("bazaarlens", rel)
        except OSError:
            source = None
        h.update(rel.encode() + b"\0" + (source or b""))
    return h.hexdigest()[:8]


def _fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of the source's leaf files: path, length and modification time."""
    p, fs = _hadoop_path(spark, path)
    it, files = fs.listFiles(p, True), []
    while it.hasNext():
        st = it.next()
        files.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}")
    key = "\n".join([code_version(), path, *sorted(files)])
    return hashlib.sha1(key.encode()).hexdigest()[:16]


def _complete(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, os.path.join(path, MARKER))
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def write_table(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def publish(spark: SparkSession, path: str, write) -> None:
    """Run ``write(folder)`` into a private folder, mark it complete, rename it
    into place; the loser of a race deletes its own copy."""
    tmp = f"{path}.part-{uuid.uuid4().hex[:12]}"
    write(tmp)
    mark, fs = _hadoop_path(spark, os.path.join(tmp, MARKER))
    fs.create(mark, True).close()
    src, dst = _hadoop_path(spark, tmp)[0], _hadoop_path(spark, path)[0]
    if not fs.exists(dst) and fs.rename(src, dst):
        # a store whose rename moves into an existing folder shows the loser there
        _delete(spark, os.path.join(path, os.path.basename(tmp)))
    else:
        fs.delete(src, True)
    if not _complete(spark, path):
        raise RuntimeError(f"stored table was not published: {path}")


def stored(spark: SparkSession, name: str, sources: list[str], write) -> str:
    """Path of the stored table ``name`` over source files, built if missing."""
    fp = "".join(_fingerprint(spark, s) for s in sources)
    path = os.path.join(checkpoint_root(spark), "tables" + TABLES_SUFFIX, f"{name}-{fp}")
    with _lock:
        if not _complete(spark, path):
            _delete(spark, path)   # left by a writer of another kind
            publish(spark, path, write)
    return path


def rebuild(spark: SparkSession, path: str) -> None:
    """Drop a stored table: the next reader builds it again."""
    with _lock:
        _delete(spark, path)


def raw_table_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of ``laptops_raw`` for a test-data folder, written once."""
    return stored(spark, "laptops_raw", [table_path(sf_dir, "orders")],
                  lambda folder: write_table(
                      listings_from_orders(read_table(spark, sf_dir, "orders")), folder))


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_raw`` for a test-data folder, materialised once."""
    return spark.read.schema(RAW_SCHEMA).parquet(raw_table_path(spark, sf_dir))


def raw_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw listings exported once as CSV (the bulk-load input)."""
    from bazaarlens.sources.csv import export_csv
    return stored(spark, "laptops_raw_csv", [table_path(sf_dir, "orders")],
                  lambda folder: export_csv(raw_table(spark, sf_dir), folder))


def flawed_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw listings as CSV lines that end with CRLF, some of them flawed by
    their id: numbers and dates that are none, lines cut short or too long."""
    from bazaarlens.sources.schema import LISTING_SCHEMA

    def write(folder: str) -> None:
        flaws = {"price_inr": (83, "n/a"), "total_reviews": (89, "12.5"), "rating": (101, "4,5"),
                 "scraped_at": (107, "yesterday")}
        cols = []
        for f in LISTING_SCHEMA.fields:
            c = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
            if f.name in flaws:
                every, value = flaws[f.name]
                c = F.when(F.col("id") % every == 0, F.lit(value)).otherwise(c)
            cols.append(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
        line = F.when(F.col("id") % 131 == 0, F.concat_ws(",", *cols[:3])) \
            .otherwise(F.concat_ws(",", *cols))
        line = F.when(F.col("id") % 137 == 0, F.concat(line, F.lit(",more"))).otherwise(line)
        raw_table(spark, sf_dir).select(line.alias("value")).write.mode("overwrite") \
            .option("lineSep", "\r\n").text(folder)

    return stored(spark, "laptops_flawed_csv", [table_path(sf_dir, "orders")], write)


def export_path(spark: SparkSession, sf_dir: str) -> str:
    """The de-duplicated listings exported once (the run's raw export)."""
    from bazaarlens.operators.dedup import first_seen
    from bazaarlens.sources.csv import export_parquet
    return stored(spark, "raw_export", [table_path(sf_dir, "orders")],
                  lambda folder: export_parquet(first_seen(raw_table(spark, sf_dir)), folder))


def landing_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw listings as files that arrive at the stream, written once per
    input; every file holds rows of all keywords and pages."""
    return stored(spark, "landing", [table_path(sf_dir, "orders")], lambda folder: write_table(
        raw_table(spark, sf_dir).repartition(LANDING_FILES, "id"), folder))


def cleaned_table_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of ``laptops_cleaned``: create-table-as-select over ``laptops_raw``."""
    return stored(spark, "laptops_cleaned", [table_path(sf_dir, "orders")],
                  lambda folder: write_table(clean(raw_table(spark, sf_dir)), folder))


def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_cleaned`` for a test-data folder, materialised once."""
    return spark.read.schema(CLEANED_SCHEMA).parquet(cleaned_table_path(spark, sf_dir))


def _archive_sources(sf_dir: str) -> list[str]:
    return [table_path(sf_dir, "orders"), table_path(sf_dir, "pages")]


def page_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page archive: the driver's ``pages`` plus every raw listing
    rendered into search-result pages, stored once as Parquet."""
    def write(folder: str) -> None:
        real = as_page_archive(read_table(spark, sf_dir, "pages"))
        write_table(render_pages(raw_table(spark, sf_dir)).unionByName(real), folder,
                    ARCHIVE_PAGES_PER_FILE)

    path = stored(spark, "page_archive", _archive_sources(sf_dir), write)
    return spark.read.schema(PAGE_ARCHIVE_SCHEMA).parquet(path)


def parsed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive's cards as the finder read them, stored once: every
    extraction query reads these, so markup is parsed once per archive."""
    path = stored(spark, "parsed_cards", _archive_sources(sf_dir),
                  lambda folder: write_table(card_fields(page_archive(spark, sf_dir)), folder))
    return spark.read.schema(CARD_SCHEMA).parquet(path)


def archive_listings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl's own raw table (stop rules, first sightings, ids), stored once."""
    def write(folder: str) -> None:
        cards = parsed_cards(spark, sf_dir)
        status = page_status(page_archive(spark, sf_dir), cards)
        write_table(listings_from_cards(cards, status, sorted_path=f"{folder}.sorted"), folder)
        _delete(spark, f"{folder}.sorted")
        _delete(spark, cutoff_path(f"{folder}.sorted"))

    path = stored(spark, "archive_listings", _archive_sources(sf_dir), write)
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``laptops_raw`` with a dense key in id order, stored once."""
    from bazaarlens.sources.keys import surrogate_key

    def write(folder: str) -> None:
        write_table(surrogate_key(raw_table(spark, sf_dir), ["id"],
                                  sorted_path=f"{folder}.sorted"), folder)
        _delete(spark, f"{folder}.sorted")

    path = stored(spark, "laptops_keyed", [table_path(sf_dir, "orders")], write)
    return spark.read.parquet(path)
