"""op12: against its SQL on the small tables, and against a plain count at small
thresholds, where every language goes through several rounds."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import bazaarlens.llm.phrases as P
from bazaarlens.llm.q_phrases import NAME, ORACLE, query
from tests.llm.helpers import awkward_docs, docs_frame, oracle_rows, spark_rows, write_tables


def plain_phrases(rows, min_count, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang or "und" if lang is None else lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, count in f.items():
        found = []
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        drop = {p[i:i + s] for p, a in good.items() for s in range(2, len(p))
                for i in range(len(p) - s + 1) if 100 * a >= 80 * count[p[i:i + s]]}
        for p, a in good.items():
            if p not in drop:
                score, k = min((P.SCALE * a // (count[p[:k]] + count[p[k:]]), k)
                               for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        n = sum(c for p, c in count.items() if len(p) == 1)
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(seed, n_docs):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "Z\x1cz", "I", "\x00"]
    fixed = ["w1 w2 w3 w4 w5", "w3 É w4", "I w7 I w7", "w9 w9 w9 w9 w9 w9"]
    rows = []
    for i in range(n_docs):
        text = ""
        for _ in range(rnd.randrange(0, 12)):
            part = rnd.choice(fixed) if rnd.random() < 0.4 else " ".join(
                rnd.choices(words, [20 // (k + 1) + 1 for k in range(16)], k=rnd.randrange(1, 7)))
            text += part + rnd.choice([" ", "  ", "\t", ". ", ",", "\n", "; ", "\x0b", "?"])
        rows.append((i, text, rnd.choice(["en", "en", "en", "de", None, ""]), "a", 1))
    return rows


@pytest.mark.parametrize("min_count,top,bits", [(2, 5, 24), (3, 40, 24), (2, 1000, 24), (2, 12, 4)])
def test_plain_version(spark, monkeypatch, min_count, top, bits):
    """Also with a table so small that nearly all cells are shared."""
    monkeypatch.setattr(P, "TABLE_BITS", bits)
    monkeypatch.setattr(P, "CHUNK", 500)
    rows = corpus(min_count * 100 + top, 150)
    docs = docs_frame(spark, rows).withColumn("n", F.lit(1)).withColumn("rank", F.lit("x"))
    got = P.phrases(spark, docs.repartition(3), min_count=min_count, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == \
        plain_phrases([r[1:3] for r in rows], min_count, top)


def test_rounds_go_on_until_settled(spark):
    """Pairs at the first floor are all covered by longer phrases."""
    rows = [(i, " ".join(f"a{i} b{i} c{i} d{i}." for _ in range(3)), "en", "a", 1)
            for i in range(30)]
    rows += [(100 + i, "x y. x z. x y. x x. z y. z z.", "en", "a", 1) for i in range(3)]
    got = P.phrases(spark, docs_frame(spark, rows), min_count=3, top=34).collect()
    assert sorted(tuple(r) for r in got) == plain_phrases([r[1:3] for r in rows], 3, 34)


def test_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    row = spark.range(1).select(P.ratio(F.lit(a), F.lit(2 * a + 1)).alias("s")).first()
    assert row.s == P.SCALE * a // (2 * a + 1) and P.SCALE * a > 2 ** 63


def test_query_on_awkward_documents(spark, tmp_path):
    rows = awkward_docs() + [(500 + i, "All rights reserved, the MIT licence. " * 4, None, "a", 1)
                             for i in range(20)]
    folder = write_tables(spark, tmp_path / "d", documents=docs_frame(spark, rows))
    got = query(spark, folder)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert spark_rows(got) == oracle_rows(ORACLE, folder)
    assert got.count() > 10 and NAME == "op12_phrases"
    empty = write_tables(spark, tmp_path / "e", documents=docs_frame(spark).limit(0))
    assert query(spark, empty).count() == 0


def test_tokens_are_numbered_without_an_object_each():
    """Numbers of tokens in order of appearance, 0 between pieces and texts."""
    from bazaarlens.llm import phrases as P
    chunk = P._Chunk(b"en")
    chunk.texts += [b"A\tb  a.c", b"", "É é\x1c B\x0bb".encode()]
    numbers, names = chunk.numbered()
    assert names.to_pylist() == [b"\n", b"a", b"b", b"c", "É".encode(), "é\x1c".encode()]
    assert [list(map(int, x.split())) for x in " ".join(map(str, numbers)).split("0") if x.strip()] \
        == [[1, 2, 1], [3], [4, 5, 2], [2]]
    assert P._Chunk(b"en").numbered()[1].to_pylist() == [b"\n"]
