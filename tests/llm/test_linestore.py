"""Line de-duplication state: insertions and deletions are reversible."""

import random

from pyspark.sql import functions as F

from bazaarlens.llm.cuckoo import CuckooFilter, built
from bazaarlens.llm.linededup import LineStore, dedup_lines, drop_lines, keys_of, line_keys
from tests.llm.helpers import docs_frame


def digest(n):
    return keys_of(f"line {n}")[1][0]


def test_filter_holds_all_keys_and_forgets_deleted_ones():
    keys = [digest(n) for n in range(3000)]
    f = built(keys)
    assert f.contains(keys).all()
    others = [digest(n) for n in range(10_000, 20_000)]
    assert f.contains(others).mean() < 0.01
    for k in keys[:1500]:
        assert f.delete(k)
    assert f.contains(keys[1500:]).all()
    assert f.contains(keys[:1500]).mean() < 0.01
    assert CuckooFilter.from_bytes(f.to_bytes()).contains(keys[1500:]).all()


def test_full_filter_says_so():
    f = CuckooFilter(1)
    assert not all([f.insert(digest(n)) for n in range(200)])


def _gone(store, docs):
    keys = line_keys(docs).select(F.explode("keys").alias("key")).distinct()
    return {bytes(r.key) for r in store.dropped(keys).collect()}


def test_deletion_undoes_insertion(spark):
    rnd = random.Random(5)

    def batch(start, n):
        return docs_frame(spark, [(start + i, "\n".join(
            f"L{rnd.randint(0, 40)}" for _ in range(8)), "en", "s", 1) for i in range(n)])

    first, second = batch(0, 30).cache(), batch(100, 30).cache()
    store = LineStore(spark, min_docs=10)
    store.insert(first)
    before, refs = _gone(store, first), sorted(map(str, store.refs.collect()))
    store.insert(second)
    both = first.unionByName(second)
    counts = {}
    for r in both.collect():
        for k in set(keys_of(r.text)[1]):
            counts[k] = counts.get(k, 0) + 1
    assert _gone(store, both) == {k for k, n in counts.items() if n >= 10}
    store.delete(second)
    assert _gone(store, first) == before
    assert sorted(map(str, store.refs.collect())) == refs


def test_stage_keeps_columns_and_clashing_names(spark):
    docs = docs_frame(spark, [(i, f"same\nown {i}", "en", "s", 9) for i in range(10)])
    docs = docs.withColumn("rk", F.lit("x")).withColumn("keys", F.lit(1)) \
        .withColumn("n_lines", F.lit(7)).withColumn("kept_text", F.lit("y"))
    out = dedup_lines(spark, docs.drop("kept_text", "n_lines"))
    assert out.columns == docs.drop("kept_text", "n_lines").columns
    assert {(r.doc_id, r.text, r.n_chars, r.rk, r.keys) for r in out.collect()} == \
        {(i, f"own {i}", len(f"own {i}"), "x", 1) for i in range(10)}
    assert drop_lines(spark, docs).count() == 10
    assert dedup_lines(spark, docs.limit(0).drop("kept_text", "n_lines")).count() == 0


def _counts(store):
    return {bytes(r.key): r.refs for r in store.refs.collect()}


def test_insertions_and_deletions_commute(spark, tmp_path, monkeypatch):
    """Any order of insertions and deletions equals a recount; a saved state goes
    on in another session; shards grow with the exact table."""
    import bazaarlens.llm.linededup as L
    monkeypatch.setattr(L, "SHARD_REFS", 8)
    rnd = random.Random(11)
    batches = [[(b * 100 + i, "\n".join(f"L{rnd.randint(0, 30)}" for _ in range(5)), "en", "s", 1)
                for i in range(6)] for b in range(4)]
    frames = [docs_frame(spark, rows) for rows in batches]
    store = LineStore(spark, min_docs=3)
    assert _gone(store, frames[0]) == set()                # nothing held, nothing dropped
    assert drop_lines(spark, frames[0], state=store).filter("n_dropped > 0").count() == 0
    store.delete(frames[0])                                # before its insertion
    store.insert(frames[1])
    store.insert(frames[0])
    store.insert(frames[2])
    shards = store.n_shards
    store.save(str(tmp_path / "state"))
    again = LineStore.open(spark.newSession(), str(tmp_path / "state"))
    assert again.min_docs == 3 and again.n_shards == shards
    again.delete(frames[1])
    again.insert(frames[3])
    held = [r for b in (2, 3) for r in batches[b]]
    expected = {}
    for r in held:
        for k in set(keys_of(r[1])[1]):
            expected[k] = expected.get(k, 0) + 1
    assert _counts(again) == expected
    assert _gone(again, frames[3]) == {k for k in set().union(
        *[keys_of(r[1])[1] for r in batches[3]]) if expected[k] >= 3}
    empty = LineStore(spark)
    empty.save(str(tmp_path / "empty"))
    assert LineStore.open(spark, str(tmp_path / "empty")).refs is None
