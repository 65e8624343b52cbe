"""CSV import/export, surrogate keys, marts catalog, streaming restart."""

import os

from pyspark.sql import functions as F

from bazaarlens.operators.clean import clean
from bazaarlens.operators.marts import MARTS, list_marts, register_marts
from bazaarlens.session import scratch_path
from bazaarlens.sources.csv import export_csv, load_csv
from bazaarlens.sources.keys import surrogate_key
from bazaarlens.sources.tables import read_raw
from bazaarlens.streaming.first_seen import read_first_seen, start_first_seen
from tests.conftest import SF_SMALL

HEADER = ("asin,product_name,brand,price_inr,original_price_inr,discount_percent,rating,"
          "total_reviews,listing_type,search_keyword,page_scraped,scraped_at")


def _write(spark, text, header=HEADER):
    d = scratch_path(spark, "csv-literal")
    os.makedirs(d)
    with open(os.path.join(d, "part.csv"), "w", newline="") as f:
        f.write(header + "\r\n" + text)
    return d


def test_csv_quotes_empty_bad_and_crlf(spark):
    body = ('B1,"Dell ""X"" 15, black",Dell,45000.00,50000.00,10.00,,12,Organic,laptops,1,'
            '2024-01-01 10:00:00\r\n'
            'B2,Acer,Acer,abc,,,4.1,,Sponsored,laptops,2,2024-01-01 10:01:00\r\n')
    rows = {r.asin: r for r in load_csv(spark, _write(spark, body)).collect()}
    assert rows["B1"].product_name == 'Dell "X" 15, black'
    assert rows["B1"].rating is None
    assert rows["B2"].price_inr is None and str(rows["B2"].rating) == "4.1"
    assert rows["B2"].scraped_at.minute == 1
    assert not rows["B1"].search_keyword.endswith("\r")
    zero = {r.asin: r for r in load_csv(spark, _write(spark, body), empty_numeric="zero").collect()}
    assert str(zero["B1"].rating) == "0.0" and zero["B2"].total_reviews == 0


def test_csv_maps_by_position_not_header(spark):
    body = "B1,n,b,6000.00,,,,,Organic,laptops,1,2024-01-01 10:00:00\r\n"
    shuffled = ",".join(reversed(HEADER.split(",")))
    r = load_csv(spark, _write(spark, body, header=shuffled)).first()
    assert r.asin == "B1" and str(r.price_inr) == "6000.00"


def test_csv_round_trip_keeps_spaces(spark):
    raw = read_raw(spark, SF_SMALL)
    back = load_csv(spark, export_csv(raw, scratch_path(spark, "rt")))
    cols = back.columns
    assert back.exceptAll(raw.select(*cols)).count() == 0
    assert raw.select(*cols).exceptAll(back).count() == 0


def test_surrogate_key_dense_across_partitions(spark):
    raw = read_raw(spark, SF_SMALL).repartition(6)
    keyed = surrogate_key(raw, ["id"])
    ids = [r.row_id for r in keyed.orderBy("row_id").collect()]
    assert ids == list(range(1, raw.count() + 1))
    firsts = keyed.orderBy("row_id").select("id").limit(3).collect()
    assert [r.id for r in firsts] == sorted(r.id for r in raw.orderBy("id").limit(3).collect())


def test_marts_registered_and_listed(spark):
    names = register_marts(spark, clean(read_raw(spark, SF_SMALL)))
    assert sorted(names) == sorted(MARTS)
    listed = {r.view_name: r.n_rows for r in list_marts(spark).collect()}
    assert set(listed) == set(MARTS)
    assert listed["vw_kpi_summary"] == 1
    assert spark.table("vw_all_products").count() == listed["vw_all_products"]


def test_stream_equals_batch_and_restarts(spark):
    """All columns of the batch result, over several micro-batches that arrive
    against the crawl order; a restart takes new files only."""
    from bazaarlens.operators.dedup import first_seen
    raw = read_raw(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    raw.orderBy(F.desc("page_scraped")).repartition(4).write.parquet(landing)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    start_first_seen(spark, landing, sink, ckpt, batch_bytes=1).awaitTermination()
    assert sorted(map(str, read_first_seen(spark, sink).collect())) == \
        sorted(map(str, first_seen(raw).collect()))
    late = raw.limit(100).withColumn("id", F.col("id") + 10**9)
    late.write.mode("append").parquet(landing)
    start_first_seen(spark, landing, sink, ckpt, batch_bytes=1).awaitTermination()
    assert sorted(map(str, read_first_seen(spark, sink).collect())) == \
        sorted(map(str, first_seen(raw.unionByName(late)).collect()))


def test_surrogate_key_on_ids_with_gaps_in_another_order(spark):
    raw = read_raw(spark, SF_SMALL).withColumn("id", F.col("id") * 7 + 3).repartition(5)
    got = surrogate_key(raw, [F.desc("id")]).orderBy("row_id").select("row_id", "id").collect()
    assert [r.row_id for r in got] == list(range(1, len(got) + 1))
    assert [r.id for r in got] == sorted((r.id for r in got), reverse=True)


def test_no_marts_gives_no_rows(spark):
    other = spark.newSession()
    assert list_marts(other).collect() == [] and list_marts(other, with_counts=False).count() == 0


def test_marts_in_a_named_database_are_read_by_another_session(spark):
    from bazaarlens.operators.marts import create_marts
    from bazaarlens.plans.materialize import cleaned_table, cleaned_table_path
    create_marts(spark, cleaned_table_path(spark, SF_SMALL), "ecommerce_marts")
    other = spark.newSession()
    assert {r.view_name for r in list_marts(other, database="ecommerce_marts").collect()} == set(MARTS)
    for name, build in MARTS.items():
        got = other.table(f"ecommerce_marts.{name}")
        want = build(cleaned_table(spark, SF_SMALL))
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_changed_part_file_gives_a_new_table(spark):
    """A folder source keeps its own length and time when a part file changes."""
    from bazaarlens.plans.materialize import raw_table
    folder = scratch_path(spark, "source")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").coalesce(1)
    orders.write.parquet(f"{folder}/orders.parquet")
    part = next(f for f in os.listdir(f"{folder}/orders.parquet") if f.startswith("part-"))
    assert raw_table(spark, folder).count() == 1500
    other = scratch_path(spark, "other")
    orders.limit(700).write.parquet(other)
    new = next(f for f in os.listdir(other) if f.startswith("part-"))
    stamp = os.stat(f"{folder}/orders.parquet").st_mtime_ns
    with open(f"{other}/{new}", "rb") as src, open(f"{folder}/orders.parquet/{part}", "wb") as dst:
        dst.write(src.read())
    crc = f"{folder}/orders.parquet/.{part}.crc"
    if os.path.exists(crc):
        with open(f"{other}/.{new}.crc", "rb") as src, open(crc, "wb") as dst:
            dst.write(src.read())
    os.utime(f"{folder}/orders.parquet", ns=(stamp, stamp))
    assert raw_table(spark, folder).count() == 700


def test_table_is_built_once_without_success_markers(spark):
    from bazaarlens.plans.materialize import rebuild, stored, write_table
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        built = []

        def write(path):
            built.append(path)
            write_table(spark.range(10), path)

        source = [f"{SF_SMALL}/region.parquet"]
        a, b = stored(spark, "t", source, write), stored(spark, "t", source, write)
        assert a == b and len(built) == 1 and spark.read.parquet(a).count() == 10
        assert not [f for f in os.listdir(os.path.dirname(a)) if ".part-" in f]
        rebuild(spark, a)
        stored(spark, "t", source, write)
        assert len(built) == 2
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_reconcile_shows_a_short_cleaned_table(spark):
    from bazaarlens.operators.quality import dq_reconcile
    raw = read_raw(spark, SF_SMALL)
    whole = clean(raw)
    r = dq_reconcile(raw, whole).first()
    assert r.rows_removed == raw.count() - whole.count()
    short = dq_reconcile(raw, whole.limit(100)).first()
    assert (short.cleaned_records, short.rows_removed) == (100, raw.count() - 100)
