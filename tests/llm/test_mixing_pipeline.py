"""Mixing targets and stage; the pipeline against a plain version."""

import collections
import hashlib
import re

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from bazaarlens.llm import bpe, mixing, quality
from bazaarlens.llm.common import store
from bazaarlens.llm.registry import QUERIES
from bazaarlens.llm.linededup import keys_of
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_docs, docs_frame, write_tables
from tests.llm.test_neardup import brute


def reshared(sizes, share=1.5):
    """Targets by repeated resharing, as the rule is worded."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = budget - sum(2 * sizes[s] for s in full)
        total = sum(weight[s] for s in rest)
        target = {s: left * weight[s] / total for s in rest}
        over = {s for s in rest if target[s] > 2 * sizes[s]}
        if not over:
            return target | {s: 2.0 * sizes[s] for s in full}
        full |= over


def test_targets_and_takes(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mixing.mix(spark, docs, block_docs=3).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = reshared(sizes)
    taken, biggest = collections.Counter(), collections.Counter()
    for r in rows:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert all(0 <= p <= 1 for p in r.positions)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s]
    again = mixing.mix(spark, docs.repartition(7), block_docs=1000).collect()
    key = lambda r: (r.doc_id, r.size, r.taken, tuple(r.positions))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_training_order_follows_the_schedule(spark):
    docs = docs_frame(spark, [(i, "w " * 5, "en", s, 1) for i in range(400)
                              for s in ("a", "b", "c")])
    takes = mixing.training_order(mixing.mix(spark, docs)).collect()
    assert [t.position for t in takes] == sorted(t.position for t in takes)
    early = collections.Counter(t.source for t in takes if t.position < 0.5)
    whole = collections.Counter(t.source for t in takes)
    assert early["b"] > 0.55 * whole["b"] and early["c"] < 0.45 * whole["c"]


def test_stage_repeats_and_drops(spark):
    docs = docs_frame(spark).selectExpr("*", "doc_id as position", "text as ord", "n_chars as size")
    plans = mixing.mix(spark, docs).groupBy("doc_id", "size").agg(F.sum("taken").alias("t")).collect()
    out = mixing.mix_documents(spark, docs)
    assert out.columns == docs.columns
    words = collections.Counter()
    for r in out.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        words[(r.doc_id, n)] += n
    assert words == collections.Counter({(p.doc_id, p.size): p.t for p in plans if p.t})
    assert mixing.mix_documents(spark, docs.limit(0)).count() == 0


def plain_pipeline(docs, kept_ids, library):
    """The stages after the quality rules, in plain Python."""
    docs = [d for d in docs if d[0] in kept_ids]
    held = collections.Counter(k for d in docs for k in set(keys_of(d[1] or "")[1]) - {b""})
    gone = {k for k, n in held.items() if n >= 10}
    cut = []
    for i, text, source in docs:
        lines, keys = keys_of(text or "")
        cut.append((i, "\n".join(x for x, k in zip(lines, keys) if k not in gone), source))
    comps, _, _ = brute([(d[0], d[1]) for d in cut], 5)
    cut = [d for d, c in zip(cut, comps) if c == d[0]]
    sizes = collections.Counter()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    for d in cut:
        sizes[d[2]] += size(d[1])
    target = reshared(sizes)
    out = collections.Counter()
    for s in sizes:
        at = 0
        for d in sorted((d for d in cut if d[2] == s),
                        key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()):
            n = size(d[1])
            for k in range(2):
                if n and at + k * sizes[s] + n / 2 <= target[s]:
                    ids = library.encode_ordinary(d[1])
                    out[(d[0], tuple(ids), hashlib.sha256(d[1].encode()).hexdigest())] += 1
            at += n
    return out


def test_pipeline(spark):
    path, pattern = bpe.default_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, special_tokens={}, mergeable_ranks={
        t: i for i, t in enumerate(bpe.read_ranks(path))})
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_report(
        spark, docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect() if r.kept}
    want = plain_pipeline([(r.doc_id, r.text, r.source) for r in docs.collect()], kept, library)
    got = collections.Counter((r.doc_id, tuple(r.ids), r.decoded_sha256)
                              for r in QUERIES["pipeline"](spark, SF_SMALL).collect())
    assert got == want


def test_pipeline_on_awkward_documents(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    docs = docs_frame(spark).selectExpr("*", "text as n_words", "doc_id as kept", "lang as ids")
    folder = write_tables(spark, tmp_path / "a", documents=docs, labels=labels)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, now, folder), f"t-{name}")
        if name != "byte_bpe":
            assert out.columns == now.columns
        now = out
    empty = write_tables(spark, tmp_path / "e", documents=docs.limit(0), labels=labels.limit(0))
    assert corpus_pipeline.run(spark, empty).count() == 0
