"""op13: Lyndon arrays and runs against their definitions; the query against a
plain version of the contract."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from bazaarlens.llm.q_runs import NAME, query, replay
from bazaarlens.llm.runs import collapse, find_runs, lyndon_array, periodic_runs
from tests.llm.helpers import awkward_docs, docs_frame, write_tables


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        words = [s[i:j] for j in range(i + 1, len(s) + 1)]
        out.append(max(len(w) for w in words if all(w < w[k:] for k in range(1, len(w)))))
    return out


def plain_runs(s, exponent=4, least=6):
    """Every period by direct comparison; smallest periods only."""
    out = []
    for q in range(1, len(s)):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            n = j - i + q
            w = s[i:j + q]
            if j > i and n >= max(least, exponent * q) and not any(
                    w[d:] == w[:n - d] for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(seed, count):
    rnd = random.Random(seed)
    for _ in range(count):
        k, s = rnd.choice([1, 2, 3, 4]), []
        for _ in range(rnd.randrange(0, 6)):
            p = [rnd.randrange(k) for _ in range(rnd.randrange(1, 7))]
            s += (p * rnd.randrange(1, 9))[:rnd.randrange(1, 40)]
        yield s


def test_lyndon_array():
    for s in sequences(1, 400):
        assert lyndon_array(s).tolist() == plain_lyndon(s), s


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (3, 5), (2, 6), (4, 4)])
def test_runs_of_sequences(exponent, least):
    for s in sequences(exponent * 10 + least, 500):
        assert find_runs(s, exponent, least) == plain_runs(s, exponent, least), s


def test_long_words_and_stretches():
    words = [f"w{i}" for i in range(3000)]
    text = words + words[:500] * 5 + ["x"] * 4000 + words
    assert find_runs(text) == [(3000, 2500, 500), (5500, 4000, 1)]
    assert collapse(text, find_runs(text)) == words + words[:500] + ["x"] + words
    with pytest.raises(ValueError):
        find_runs(text, exponent=1)


def plain_row(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a, p = g % n, 0
        p = 1 + (n - a) // (3 + g % 8)
        old = list(words)
        for i in range(a, n):
            words[i] = old[a + (i - a) % p]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in
           ("".join(f"{a},{b},{c}\n" for a, b, c in runs),
            " ".join(w for i, w in enumerate(words) if i not in drop))]
    return (doc_id, len(runs), *(best or (None,) * 3),
            1000 * best[1] // best[2] if best else None, *sha)


def test_query_is_the_contract(spark, tmp_path):
    rnd = random.Random(5)
    rows = [r for r in awkward_docs() if r[0] != 6] + [(6, "a b " * 900 + "c", "en", "a", 1)]
    for i in range(11, 150):
        w = [rnd.choice("abcdefghij") * rnd.randrange(1, 3) for _ in range(rnd.randrange(0, 90))]
        sep = rnd.choice([" ", "\n", "\t ", "\x1c \r\n"])
        rows.append((i, sep.join(w) + sep.join(w[:3] * rnd.randrange(9)), "en", "a", 1))
    docs = docs_frame(spark, rows).withColumn("runs", F.lit(1)).withColumn("best", F.lit("x"))
    got = query(spark, write_tables(spark, tmp_path, documents=docs))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes[:6]] == ["bigint"] * 6
    expected = [plain_row(r[0], r[1]) for r in rows]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))
    assert sum(r[1] > 0 for r in expected) > 30
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5


def test_operator_and_empty_table(spark, tmp_path):
    docs = docs_frame(spark)
    got = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert [tuple(r) for r in got[6].runs] == [(0, 20000, 5)]
    assert got[6].collapsed == "lorem ipsum dolor sit amet" and got[6].n_words == 20000
    assert got[3].runs == [] and got[3].collapsed == "" and got[4].n_words == 0
    assert query(spark, write_tables(spark, tmp_path, documents=docs.limit(0))).count() == 0
    assert NAME == "op13_periodic_runs" and replay(None, [b"a"]) == [b"a"]
