"""Crawl state: stop rules over blocks of pages, first sightings by late
materialisation, the stream's keyed state, per-keyword checkpoints, keys over
several loads."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.functions.keywords import KEYWORDS
from bazaarlens.operators.checkpoint import (checkpoint_crawl, finished_keywords,
                                             read_checkpoint)
from bazaarlens.operators.dedup import (CRAWL_ORDER, _first_in_window, crawl_cutoff, first_seen)
from bazaarlens.session import scratch_path
from bazaarlens.sources.keys import file_order, high_water_mark, keyed_load
from bazaarlens.sources.tables import read_raw
from bazaarlens.streaming.first_seen import STORE_SETTING, read_first_seen, start_first_seen
from tests.conftest import SF_SMALL
from tests.helpers import raw_rows


def rows(df):
    return sorted(map(str, df.collect()))


# ---- stop rules

def plain_cutoff(pages, run, limit):
    kept, stop, reason, empty, last = 0, None, None, 0, None
    for page, products, status in sorted(pages):
        if limit is not None and page > limit:
            break
        last = page
        kept += products or 0
        empty = 0 if (products or 0) > 0 else empty + 1
        if status in ("blocked", "exhausted") or empty >= run:
            stop = page
            reason = status if status in ("blocked", "exhausted") else "empty run"
            break
    return (last if stop is None else stop, reason or "max pages", kept)


@pytest.mark.parametrize("run,limit,block", [(2, None, 3), (2, None, 1), (3, None, 4), (1, None, 5),
                                             (4, 25, 2), (2, 20, 1000), (5, None, 3)])
def test_cutoff_of_blocks_is_that_of_a_page_after_page_crawl(spark, run, limit, block):
    rnd = random.Random(run * 100 + block)
    data, expected = [], {}
    for k in range(60):
        p_empty, p_hard = rnd.choice([0.1, 0.5, 0.8]), rnd.choice([0, 0.03])
        pages = [(p, 0 if rnd.random() < p_empty else rnd.randrange(1, 9),
                  "blocked" if rnd.random() < p_hard else "ok")
                 for p in rnd.sample(range(1, 60), rnd.randrange(1, 50))]
        if limit is None or any(p <= limit for p, _, _ in pages):
            expected[f"kw{k}"] = plain_cutoff(pages, run, limit)
        data += [(f"kw{k}", *page) for page in pages]
    stats = spark.createDataFrame(
        data, "search_keyword string, page_scraped int, products bigint, status string")
    got = {r.search_keyword: (r.stop_page, r.stop_reason, r.products_kept)
           for r in crawl_cutoff(stats.repartition(3), run, limit, block).collect()}
    assert got == expected


def test_pages_above_the_limit_are_left_out(spark):
    stats = spark.createDataFrame([("a", p, 5, "ok") for p in range(1, 31)] + [("b", 21, 5, "ok")],
                                  "search_keyword string, page_scraped int, products bigint, "
                                  "status string")
    assert [tuple(r) for r in crawl_cutoff(stats).collect()] == [("a", 20, "max pages", 100)]
    assert {r.stop_page for r in crawl_cutoff(stats, max_pages=None).collect()} == {30, 21}


# ---- first sightings

def awkward_crawl(spark):
    rnd = random.Random(4)
    made = [dict(id=rnd.choice([1, -1]) * (i + 1) * 10 ** 14, asin=rnd.choice([None, "", "A", "B", "C", "D", "E"]),
                 search_keyword=rnd.choice([None, "zz", "aa", *KEYWORDS[:3]]),
                 page_scraped=rnd.choice([None, -2147483648, 1, 2, 2147483647])) for i in range(120)]
    made += [dict(id=7, asin="only", search_keyword="zz", page_scraped=1),
             dict(id=6, asin="only", search_keyword="aa", page_scraped=9),
             dict(id=5, asin="none", search_keyword=None, page_scraped=9),
             dict(id=4, asin="none", search_keyword="", page_scraped=1)]
    return raw_rows(spark, made)


def test_first_seen_fetches_the_window_form_rows(spark):
    raw = awkward_crawl(spark)
    assert rows(first_seen(raw)) == rows(_first_in_window(raw, "asin", CRAWL_ORDER, KEYWORDS))
    assert first_seen(raw.limit(0)).count() == 0
    one = raw.filter("search_keyword = 'zz'")
    assert rows(first_seen(one)) == rows(_first_in_window(one, "asin", CRAWL_ORDER, KEYWORDS))


def test_first_seen_sorts_no_wide_rows(spark):
    from bazaarlens.plans.registry import QUERIES
    plan = QUERIES["first_seen"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "min_by" in plan
    wide = [x for x in plan.splitlines() if "FileScan parquet" in x and "product_name" in x]
    assert len(wide) == 1
    sorts = plan[plan.index("WindowGroupLimit"):] if "WindowGroupLimit" in plan else ""
    assert "product_name" not in sorts


# ---- the stream

def batches(sink):
    out = {}
    for folder in glob.glob(os.path.join(sink, "batch=*")):
        out[int(folder.rsplit("=", 1)[1])] = folder
    return [out[k] for k in sorted(out)]


def land(spark, folder, *frames):
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(folder)


def test_a_batch_hands_on_new_or_improved_winners_only(spark):
    first = raw_rows(spark, [dict(id=10, asin="A", page_scraped=3), dict(id=11, asin="B"),
                             dict(id=12, asin="A", page_scraped=4), dict(id=13, asin=None)])
    second = raw_rows(spark, [dict(id=5, asin="A", page_scraped=2),      # late, but earlier
                              dict(id=99, asin="B"),                     # later: no change
                              dict(id=20, asin="C"), dict(id=21, asin=None)])
    third = raw_rows(spark, [dict(id=4, asin="A", page_scraped=1), dict(id=30, asin="B"),
                             dict(id=31, asin="A", page_scraped=2)])
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    emitted = []
    for df in (first, second, third):        # each start is a restart from the checkpoint
        land(spark, landing, df)
        start_first_seen(spark, landing, sink, ckpt).awaitTermination()
        new = batches(sink)[len(emitted):]
        assert len(new) == 1
        emitted += [{(r.asin, r.id, r.is_new) for r in spark.read.parquet(new[0]).collect()}]
    assert emitted == [{("A", 10, True), ("B", 11, True), (None, 13, True)},
                       {("A", 5, False), ("C", 20, True)}, {("A", 4, False)}]
    everything = first.unionByName(second).unionByName(third)
    assert rows(read_first_seen(spark, sink)) == rows(first_seen(everything))


def test_the_stream_keeps_its_keys_in_the_state_store(spark):
    before = spark.conf.get(STORE_SETTING, None)
    raw = read_raw(spark, SF_SMALL)
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    raw.orderBy(F.desc("page_scraped")).repartition(3).write.parquet(landing)
    q = start_first_seen(spark, landing, sink, ckpt, batch_files=1)
    q.awaitTermination()
    assert spark.conf.get(STORE_SETTING, None) == before
    state = q.lastProgress.stateOperators[0]
    assert state.numRowsTotal == raw.select("asin").distinct().count()
    assert any("rocksdb" in k for k in state.customMetrics)
    assert len(batches(sink)) == 3
    saved = spark.read.format("statestore").load(ckpt)
    assert saved.count() == state.numRowsTotal
    assert rows(read_first_seen(spark, sink)) == rows(first_seen(raw))


def test_a_batch_that_is_run_again_counts_once(spark):
    """The commit of the last batch is lost, as after a crash: it is run again
    with its time stamp and overwrites its folder."""
    raw = read_raw(spark, SF_SMALL)
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    raw.repartition(2).write.parquet(landing)
    start_first_seen(spark, landing, sink, ckpt, batch_files=1).awaitTermination()
    for f in glob.glob(os.path.join(ckpt, "commits", "*1")) \
            + glob.glob(os.path.join(ckpt, "commits", ".1*")):
        os.remove(f)
    start_first_seen(spark, landing, sink, ckpt, batch_files=1).awaitTermination()
    assert rows(read_first_seen(spark, sink)) == rows(first_seen(raw))


# ---- checkpoints

@pytest.mark.parametrize("stop", [0, 1, 4, 7])
def test_a_stopped_crawl_ends_as_an_unbroken_one(spark, stop):
    raw = read_raw(spark, SF_SMALL)
    path = scratch_path(spark, "crawl")
    assert checkpoint_crawl(raw, path, at_most=stop) == list(KEYWORDS[:stop])
    assert finished_keywords(spark, path) <= set(KEYWORDS[:stop])
    rest = checkpoint_crawl(raw, path)
    assert rest[-1] is None and set(KEYWORDS[stop:]) <= set(rest)
    assert rows(read_checkpoint(spark, path)) == rows(first_seen(raw))


def test_checkpoint_of_awkward_rows_and_a_lost_step(spark):
    raw = awkward_crawl(spark)
    path = scratch_path(spark, "crawl")
    checkpoint_crawl(raw, path)
    expected = rows(first_seen(raw))
    assert rows(read_checkpoint(spark, path)) == expected
    assert checkpoint_crawl(raw, path)[-1] is None        # nothing is lost by looking again
    assert rows(read_checkpoint(spark, path)) == expected
    # a writer that died leaves a private folder only: it is not a partition
    os.makedirs(os.path.join(path, ".spark-staging-x", "search_keyword=laptops"))
    assert rows(read_checkpoint(spark, path)) == expected
    assert read_checkpoint(spark, scratch_path(spark, "none")).count() == 0


# ---- keys

def test_two_loads_continue_the_keys(spark):
    raw = read_raw(spark, SF_SMALL)
    table = os.path.join(scratch_path(spark, "loads"), "table")
    n, odd = raw.count(), raw.filter("id % 3 = 1")
    assert high_water_mark(spark, table) == 0
    assert keyed_load(odd, ["id"], table) == (1, odd.count())
    assert keyed_load(raw.filter("id % 3 <> 1").repartition(5), [F.desc("id")], table) == \
        (odd.count() + 1, n)
    assert keyed_load(raw.limit(0), ["id"], table) == (n + 1, n)
    got = spark.read.parquet(table).orderBy("row_id").select("row_id", "id").collect()
    assert [r.row_id for r in got] == list(range(1, n + 1))
    assert [r.id for r in got[:odd.count()]] == sorted(r.id for r in odd.collect())
    assert high_water_mark(spark, table) == n


def test_files_are_ordered_by_number(spark):
    names = [f"part-{n:05d}-abc-c{c:03d}.snappy.parquet"
             for n in (0, 5, 99999, 100000, 1000001) for c in (0, 1, 999, 1000)]
    df = spark.createDataFrame([(x,) for x in reversed(names)], "f string")
    assert [r.f for r in df.orderBy(*file_order("f")).collect()] == names


# ---- order of products

def test_equal_pairs_are_split_over_range_partitions(spark):
    from bazaarlens.operators.marts import vw_top_products
    from bazaarlens.plans.registry import QUERIES
    cleaned = QUERIES["cleaned"](spark, SF_SMALL)
    hot = cleaned.withColumn("rating", F.expr("if(id % 3 = 0, 4.5, rating)").cast("decimal(3,1)")) \
        .withColumn("discount_percent",
                    F.expr("if(id % 3 = 0, 10.0, discount_percent)").cast("decimal(5,1)"))
    top = vw_top_products(hot.withColumn("product_name", F.col("id").cast("string")))
    got = [(-r.rating, -r.discount_percent, int(r.product_name)) for r in top.collect()]
    assert got == sorted(got)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert any("rangepartitioning" in x and "id#" in x for x in plan.splitlines())
