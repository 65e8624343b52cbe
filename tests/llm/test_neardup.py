"""Near-duplicates against brute force; SuperMinHash; components."""

import collections
import hashlib
import random

import numpy as np
import pytest

from bazaarlens.llm import neardup as N
from bazaarlens.llm.components import components
from bazaarlens.llm.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_docs, docs_frame


def sets_of(rows, size):
    def one(t):
        w = tuple((t or "").encode().lower().split())
        return frozenset(w[i:i + size] for i in range(len(w) - size + 1)) if len(w) >= size \
            else frozenset([w] if w else [])
    return {k: one(t) for k, t in rows}


def brute(rows, size=2):
    """row number -> smallest doc_id reachable; rows are (doc_id, text)."""
    sets = sets_of(enumerate(t for _, t in rows), size)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for k, s in sets.items():
        seen = collections.Counter(j for x in s for j in holders[x])
        for j, n in seen.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(k), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(rows))], sets, [find(k) for k in range(len(rows))]


def check(spark, rows, size=2):
    """Links are between rows; rows that share an id are rows of their own."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in
                  N.near_duplicates(spark, docs, size).collect()), key=str)
    comps, sets, groups = brute(rows, size)
    # of a component without ids the texts of the first digest are kept
    md5 = [hashlib.md5(f"-:{t or ''}".encode()).hexdigest() for _, t in rows]
    bare = {}
    for k, c in enumerate(comps):
        if c is None:
            bare.setdefault(groups[k], []).append(md5[k])
    assert got == sorted(((i, len(sets[k]), c, i == c if c is not None else
                           not sets[k] or md5[k] == min(bare[groups[k]]))
                          for k, ((i, _), c) in enumerate(zip(rows, comps))), key=str)


def test_small_table(spark):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    comps, sets, _ = brute(docs)
    got = {r.doc_id: r for r in QUERIES["op9_minhash_neardup"](spark, SF_SMALL).collect()}
    for (i, _), c, k in zip(docs, comps, range(len(docs))):
        assert (got[i].component_id, got[i].n_shingles, got[i].kept) == (c, len(sets[k]), c == i)


def test_chains_and_groups(spark, monkeypatch):
    """A chain of slowly changing texts, a large group around one text, blocks
    and portions smaller than the groups."""
    monkeypatch.setattr(N, "PORTION", 7)
    monkeypatch.setattr(N, "BLOCK", 3)
    rnd = random.Random(4)
    words = [f"w{n}" for n in range(60)]
    rows, text = [], list(words)
    for i in range(25):
        rows.append((1000 - i, " ".join(text)))
        text[rnd.randrange(60)] = f"x{i}"
    for i in range(40):
        t = [f"b{n}" for n in range(80)]
        for _ in range(4):
            t[rnd.randrange(80)] = f"y{i}{rnd.random()}"
        rows.append((i, " ".join(t)))
    rows += [(2000 + i, " ".join(rnd.choices(words, k=30))) for i in range(20)]
    check(spark, rows)


def test_awkward_documents(spark):
    check(spark, [(r[0], r[1]) for r in awkward_docs()])
    check(spark, [(r[0], r[1]) for r in awkward_docs()], 5)


def test_shared_and_null_ids(spark):
    """Rows that share an id keep the links of each of their texts; rows without
    an id link, also with one another."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    check(spark, [(1, a), (2, a + " x"), (2, b), (3, b + " y"), (3, c)])
    check(spark, [(None, a), (None, a + " x"), (7, b), (None, b + " y"), (None, c), (None, c),
                  (None, None), (None, ""), (5, c + " z"), (None, "one"), (None, "one two")])
    rnd = random.Random(9)
    rows = []
    for _ in range(120):
        t = rnd.choice([a, b, c]).split()
        for _ in range(rnd.randrange(4)):
            t[rnd.randrange(40)] = f"x{rnd.randrange(50)}"
        rows.append((rnd.choice([None, rnd.randrange(20)]), " ".join(t)))
    check(spark, rows)


def test_empty_table(spark):
    assert N.near_duplicates(spark, docs_frame(spark).limit(0)).count() == 0


def test_stage_keeps_one_per_group(spark):
    docs = docs_frame(spark).selectExpr("*", "doc_id as rk", "text as nth", "n_chars as in0_")
    out = N.keep_first(spark, docs, 5)
    assert out.columns == docs.columns
    ids = sorted((r.doc_id for r in out.collect()), key=str)
    assert ids == sorted([1, 3, 4, 5, 6, 7, 8], key=str)   # the one without id copies 1


def test_planted_near_copies(spark):
    """Copies with 0 to 8 replaced words: the five-word stage drops exactly
    those that are 0.8 alike or more, and no other document."""
    rnd = random.Random(21)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, due = [], set()
    for g in range(60):
        words = [rnd.choice(vocabulary) for _ in range(200)]
        rows.append((g * 100, " ".join(words)))
        for k in range(9):
            copy = list(words)
            for at in rnd.sample(range(200), k):
                copy[at] = "new" + str(rnd.randrange(10 ** 9))
            a, b = ({tuple(w[i:i + 5]) for i in range(196)} for w in (words, copy))
            rows.append((g * 100 + k + 1, " ".join(copy)))
            if 100 * len(a & b) >= 80 * len(a | b):
                due.add(g * 100 + k + 1)
    assert 250 < len(due) < 450
    kept = {r.doc_id for r in N.keep_first(
        spark, spark.createDataFrame(rows, "doc_id bigint, text string"), 5).collect()}
    comps, _, _ = brute(rows, 5)
    assert kept == {i for (i, _), c in zip(rows, comps) if c == i}
    assert not kept & due


def test_super_minhash_estimates_with_low_variance():
    rnd = np.random.default_rng(0)
    est = []
    for _ in range(80):
        a = rnd.integers(0, 2**63, 100, dtype=np.uint64)
        b = np.concatenate([a[:89], rnd.integers(0, 2**63, 11, dtype=np.uint64)])
        est.append((N.super_minhash(np.unique(a)) == N.super_minhash(np.unique(b))).mean())
    j = 89 / 111
    assert abs(np.mean(est) - j) < 0.02
    assert np.std(est) < (j * (1 - j) / (N.BANDS * N.ROWS)) ** 0.5


def test_super_minhash_is_the_least_over_elements():
    items = np.unique(np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64))
    whole = N.super_minhash(items)
    parts = np.minimum(N.super_minhash(items[:11]), N.super_minhash(items[11:]))
    assert (whole == parts).all()


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(7)
    edges = {"path": [(i, i + 1) for i in range(200)], "star": [(999, i) for i in range(300)],
             "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)],
             "none": []}[shape]
    rnd.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    got = {r.node: r.component for r in components(df).collect()}
    uf = N.UnionFind()
    for a, b in edges:
        uf.union(a, b)
    assert got == {x: uf.find(x) for x in uf.parent if uf.find(x) != x}
