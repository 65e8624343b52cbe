"""Quality measures and certified cutoffs against plain definitions."""

import math
import random
import re
import zlib

import numpy as np

from bazaarlens.llm import quality as Q
from bazaarlens.llm.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward_docs, docs_frame, write_tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)} \
        if len(words) < 3000 else None
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup,
            None if covered is None else len(covered))


def compare(report, docs):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in report), key=str)
    want = []
    for i, t in docs:
        p = plain(t)
        want.append((i, *p[:4], p[4] if p[4] is not None else p[0]))   # the long text repeats
    assert got == sorted(want, key=str)
    for r in report:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_small_table(spark):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs = [(i, t) for i, t in docs if len(t) < 12000]
    ids = {i for i, _ in docs}
    report = [r for r in QUERIES["op8_quality_rules"](spark, SF_SMALL).collect() if r.doc_id in ids]
    compare(report, docs)


def test_awkward_documents(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (None, 1, 1), (99, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    folder = write_tables(spark, tmp_path / "a", documents=docs_frame(spark), labels=labels)
    report = QUERIES["op8_quality_rules"](spark, folder).collect()
    compare(report, [(r[0], r[1]) for r in awkward_docs()])
    assert all(r.kept != r.base_failed for r in report)   # no label count certifies anything
    folder = write_tables(spark, tmp_path / "e", documents=docs_frame(spark).limit(0),
                          labels=labels.limit(0))
    assert QUERIES["op8_quality_rules"](spark, folder).count() == 0


def test_binomial_bound():
    for n, k, p in ((10, 3, 0.4), (700, 2, 0.01), (50, 0, 0.1)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(Q.binomial_cdf(k, n, p) - exact) < 1e-9


def test_cutoff_is_certified_and_useful():
    good, bad = np.zeros(101, int), np.zeros(101, int)
    good[:10], good[60] = 500, 5
    bad[50:60] = 30
    c = Q.choose_cutoff(good, bad, 0.01, 0.001, 20)
    k = good[c + 1:].sum()
    assert Q.binomial_cdf(int(k), int(good.sum()), 0.01) <= 0.001
    assert bad[c + 1:].sum() == 300
    assert Q.choose_cutoff(good // 500, bad, 0.01, 0.001, 20) is None    # too few labels
    assert Q.choose_cutoff(good, bad * 0, 0.01, 0.001, 20) is None       # nothing to gain


def test_false_rejection_is_limited(spark):
    """On fresh documents of the same kind at most alpha_total of the good go."""
    rnd = random.Random(9)

    def text(good):
        words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(10**6)}" for _ in range(80)]
        for i in range(0, 80, 80 if good else 4):
            words[i] += "###"
        return " ".join(words)

    rows = [(i, text(i % 5 > 0), "en", "s", 1) for i in range(8000)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(7000)],
                                   "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in Q.quality_filter(spark, docs.withColumnRenamed("n_chars", "n_words"),
                                               labels).collect()}
    fresh = range(7000, 8000)
    assert sum(i not in kept for i in fresh if i % 5) <= 0.01 * 800
    assert sum(i in kept for i in fresh if i % 5 == 0) <= 0.05 * 200


def test_all_rules_together_lose_at_most_one_percent(spark):
    """Four rules that each lose a few good documents: the sum is limited, not each."""
    plain_row, rows = (100, 400, 0, 0, 0, 10), []
    odd = [(100, 400, 280, 0, 0, 10), (100, 400, 0, 7, 0, 10), (100, 400, 0, 0, 45, 10),
           (100, 1800, 0, 0, 0, 10)]
    for i in range(4000):
        rows.append((i, "en", *(odd[i % 4] if i < 36 else plain_row)))
    rows += [(4000 + i, "en", *odd[i % 4]) for i in range(1200)]
    measured = spark.createDataFrame(
        rows, "doc_id bigint, lang string, " + ", ".join(f"{m} bigint" for m in Q.MEASURES))
    labels = spark.createDataFrame([(i, int(i < 4000)) for i in range(5200)],
                                   "doc_id bigint, quality int")
    kept = {r.doc_id for r in Q.judge(measured, Q.cutoffs_wide(
        Q.learn_cutoffs(measured, labels))).filter("kept").collect()}
    lost = sum(i not in kept for i in range(4000))
    assert Q.binomial_cdf(lost, 4000, 0.01) <= 0.05


def labelled_docs():
    """Documents of three languages: enough labels, few but enough for all rules
    together, and too few. Most have a label, some labels are repeated or null."""
    rnd = random.Random(4)
    docs, labels = [], []
    for lang, n in (("en", 1600), ("de", 560), ("fr", 90)):
        for _ in range(n):
            i, bad = len(docs), rnd.random() < 0.12
            words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(10**4)}" for _ in range(60)]
            if bad and i % 2:
                words = [w + "x" * 12 for w in words]
            elif bad:
                words = [w + "#" * rnd.randrange(1, 4) for w in words]
            elif rnd.random() < 0.02:
                words[rnd.randrange(60)] += "##"
            lines = [" ".join(words[k:k + 12]) for k in range(0, 60, 12)]
            if rnd.random() < 0.1:
                lines.append(lines[0])
            docs.append((i, "\n".join(lines), lang, "s", 1))
            if rnd.random() < 0.97:
                labels += [(i, None if i % 50 == 7 else int(not bad), 0)] * (1 + (i % 9 == 0))
    return docs, labels


def plain_verdicts(docs, labels):
    """Ids of the documents kept, point by point of the path."""
    truth = {}
    for i, q, _ in labels:
        if q is not None:
            truth[i] = max(q, truth.get(i, 0))
    idx, langs = {}, {}
    for i, text, lang, _, _ in docs:
        n, chars, symbols, dup, rep = plain(text)
        lines = len([x for x in text.split("\n") if WORD.search(x)])
        if n >= 50 and 100 * rep <= 50 * n:
            idx[i] = {"symbols": symbols / chars / 0.01, "dup_lines": dup / lines / 0.01,
                      "repeats": rep / n / 0.01, "word_length": chars / n / 0.25}
            idx[i] = {r: min(100, math.floor(v)) for r, v in idx[i].items()}
            langs[i] = lang
    orders = {i for i in truth if zlib.crc32(f"order:{i}".encode()) % 10 == 0}
    part = {}
    for lang in set(langs.values()):
        of = [i for i in truth if langs.get(i) == lang]
        part[lang] = ([i for i in of if truth[i] and i in orders],
                      [i for i in of if truth[i] and i not in orders],
                      [i for i in of if not truth[i]])
    sizes = {lang: len(p[1]) for lang, p in part.items()}
    able = [a for a in sizes if 0.99 ** sizes[a] <= 0.05 / sum(n >= sizes[a] for n in sizes.values())]
    used = {}
    for lang in able:
        good, test, bad = part[lang]
        targets = []
        for r in ("symbols", "dup_lines", "repeats", "word_length"):
            gain = {c: sum(idx[i][r] > c for i in bad) - 200 * sum(idx[i][r] > c for i in good)
                    for c in range(101)}
            c = max(k for k in gain if gain[k] == max(gain.values()))
            if gain[c] > 0:
                targets.append((-gain[c], r, c))
        point, best = {}, 0
        steps = [(r, c) for _, r, target in sorted(targets) for c in range(99, target - 1, -1)]
        for r, c in steps:
            point[r] = c
            gone = [sum(any(idx[i][x] > v for x, v in point.items()) for i in ids)
                    for ids in (test, bad)]
            n = len(test)
            chance = sum(math.comb(n, k) * 0.01**k * 0.99 ** (n - k) for k in range(gone[0] + 1))
            if chance > 0.05 / len(able):
                break
            if gone[1] - 20 * gone[0] > best:
                best, used[lang] = gone[1] - 20 * gone[0], dict(point)
    return able, used, {i for i, v in idx.items()
                        if not any(v[r] > c for r, c in used.get(langs[i], {}).items())}


def test_learned_verdicts_match_a_plain_version(spark, tmp_path):
    docs, labels = labelled_docs()
    able, used, want = plain_verdicts(docs, labels)
    assert sorted(able) == sorted(used) == ["de", "en"]       # de has too few for each rule alone
    frame = docs_frame(spark, docs)
    truth = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    measured = Q.features(frame, ["doc_id", "lang"])
    got = {}
    for r in Q.learn_cutoffs(measured, truth).collect():
        got.setdefault(r.stratum, {})[r.rule] = r.cutoff
    assert got == used
    folder = write_tables(spark, tmp_path / "q", documents=frame, labels=truth)
    report = QUERIES["op8_quality_rules"](spark, folder).collect()
    assert {r.doc_id for r in report if r.kept} == want
    assert {r.doc_id for r in Q.quality_filter(spark, frame, truth).collect()} == want
    assert len(want) < len(docs)


def test_rare_strata_do_not_weaken_others():
    assert Q.certifiable(427, [427, 440, 1800], 0.01, 0.05)
    assert not Q.certifiable(307, [307, 427, 440, 1800], 0.01, 0.05)
