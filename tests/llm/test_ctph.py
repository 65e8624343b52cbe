"""op11: fingerprints against a plain version that reads a text letter by letter;
the query against the contract; what the likeness separates."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import bazaarlens.llm.ctph as C
from bazaarlens.llm.q_ctph import NAME, query
from bazaarlens.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, awkward_docs, docs_frame, write_tables

M = 2 ** 64


def mixed(x):
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 % M
    return ((x ^ x >> 27) * 0x94D049BB133111EB % M) >> 32


def plain_fingerprint(text):
    c = [ord(x) + 1 for x in text]

    def ends(size):
        out = []
        for i in range(len(c)):
            roll = sum(c[i - k] * pow(0xD1342543DE82EF95, k, M) for k in range(7) if i >= k) % M
            if mixed(roll) % size == size - 1:
                out.append(i + 1)
        return out

    def signature(size):
        at, found = [], set(ends(size)) | {len(c)}
        for i in range(1, len(c) + 1):
            if i in found or i - (at[-1] if at else 0) == 2 * size:
                at.append(i)
        if len(at) > 128:
            at = at[:127] + at[-1:]
        out, start = "", 0
        for e in at:
            h = sum(x * pow(0x9E3779B97F4A7C15, j, M) for j, x in enumerate(c[start:e])) % M
            out += C.TOKENS[mixed(h) & 4095]
            start = e
        return out

    if not c:
        return "3::"
    size = 3
    while size * 64 < len(c):
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def plain_likeness(one, other):
    if one == other:
        return 1.0

    def part(a, b):
        x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
        if not x or not y:
            return 0.0
        row = list(range(len(y) + 1))
        for i, u in enumerate(x, 1):
            above, row[0] = row[0], i
            for j, v in enumerate(y, 1):
                above, row[j] = row[j], above if u == v else 1 + min(row[j], row[j - 1])
        return 1 - row[-1] / (len(x) + len(y))

    (s, *a), (t, *b) = one.split(":"), other.split(":")
    both = [(p, q) for i, p in enumerate(a) for j, q in enumerate(b)
            if int(s) << i == int(t) << j]
    return max([part(p, q) for p, q in both], default=0.0)


def texts():
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(2, 9)))
             for _ in range(500)]
    out = ["", "a", "ab", "é🙂", "a" * 900, "ab" * 700, "line one two\n" * 90, "\x00" * 50]
    return out + [" ".join(rnd.choices(words, k=rnd.choice([1, 5, 30, 200, 500])))
                  for _ in range(25)]


def test_fingerprint_is_the_plain_one():
    for t in texts():
        assert C.fingerprint(t) == plain_fingerprint(t), t[:40]


@pytest.mark.parametrize("block", [7, 64, 1000])
def test_blocks_change_nothing(monkeypatch, block):
    expected = [C.fingerprint(t) for t in texts()]
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "_tables", {})
    assert [C.fingerprint(t) for t in texts()] == expected


def test_likeness_is_the_edit_distance():
    prints = [C.fingerprint(t) for t in texts()]
    for a in prints:
        for b in prints:
            assert C.likeness(a, b) == pytest.approx(plain_likeness(a, b), abs=1e-12)
            assert C.likeness(a, b) == C.likeness(b, a) and 0 <= C.likeness(a, b) <= 1


def expected_rows(rows):
    """Contract: (n_chars, edited digest, fingerprints, likenesses) per row."""
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
    rows = sorted(rows, key=key)
    out = []
    for (i, t, *_), (_, u, *_) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        new = t[:len(t) - half] + u[:half]
        own, ed = C.fingerprint(t), C.fingerprint(new)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), own, ed,
                    C.likeness(own, ed), C.likeness(own, C.fingerprint(u))))
    return sorted(map(str, out))


def test_query_is_the_contract(spark, tmp_path):
    rows = awkward_docs() + [(100 + i, t, "en", "a", 1) for i, t in enumerate(texts())]
    rows += [(200, "hot " * (i % 40), "en", "a", 1) for i in range(200)]
    rows += [(None, "no id " * (i % 3), "en", "a", 1) for i in range(9)]
    docs = docs_frame(spark, rows).withColumn("row", F.lit(1)).withColumn("tie", F.lit("x"))
    got = query(spark, write_tables(spark, tmp_path / "d", documents=docs.repartition(5)))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint",
                           "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(str(tuple(r)) for r in got.collect()) == expected_rows(rows)
    one = docs_frame(spark, [(1, LONG, "en", "a", 1)])
    assert sorted(str(tuple(r)) for r in C.neighbours(one).collect()) == \
        expected_rows([(1, LONG)])
    empty = write_tables(spark, tmp_path / "e", documents=docs.limit(0))
    assert query(spark, empty).count() == 0 and NAME == "op11_fingerprints"


def test_small_tables(spark):
    rows = [tuple(r) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
            .collect()]
    got = query(spark, SF_SMALL).collect()
    assert sorted(str(tuple(r)) for r in got) == expected_rows(rows)
    long = [r for r in got if r.n_chars >= 200]
    assert sum(r.near_edited >= 0.25 for r in long) >= 0.97 * len(long)
    assert sum(r.near_next < 0.25 for r in long) >= 0.97 * len(long)


def test_fingerprints_alone(spark):
    docs = docs_frame(spark)
    got = {r.doc_id: r.fingerprint for r in C.fingerprints(docs).collect()}
    assert got[3] == got[4] == "3::" and got[6] == C.fingerprint(LONG)
