"""Toxicity: kernel, held-out accuracy, awkward rows."""

import itertools
import random
import unicodedata
import zlib

import numpy as np
import pytest

from bazaarlens.llm import toxicity as X
from bazaarlens.llm.registry import QUERIES
from tests.llm.helpers import awkward_docs, docs_frame, write_tables

INSULTS = ["blorgface", "snarkle", "vilepup"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    parts = ["ta", "ri", "no", "me", "su", "ka", "lo", "den", "fi", "gru"]
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(2):
                words[rnd.randrange(60)] = rnd.choice(INSULTS)
        rows.append((i, ". ".join(" ".join(words[k:k + 10]) for k in range(0, 60, 10)),
                     int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(600)
    weights, curve = X.train([r[1] for r in rows], [bool(r[2]) for r in rows])
    table = np.zeros(X.N_CODES, np.float32)
    table[list(weights)] = list(weights.values())
    return lambda t: X.probability(X.peaks(t, table), curve), table


def test_explicit_features_equal_the_kernel():
    """Table lookup along a text equals the kernel sum over shared subsequences."""
    rnd = random.Random(2)
    text = "".join(rnd.choice("abc de") for _ in range(60))
    mark = X.codes_of("abcde")[1:].tobytes()
    table = np.zeros(X.N_CODES, np.float32)
    for k, v in X.kernel_vector(mark).items():
        table[k] = v
    want = 0.0
    for _, numbers, weight in X.subsequences(X.codes_of(text)):
        want += weight * float(table[numbers].sum())
    assert abs(float(X.weigh(X.codes_of(text), table).sum()) - want) < 1e-3


def test_held_out_accuracy(model):
    score, _ = model
    fresh = corpus(400, seed=77)
    hits = [(score(t) >= 0.5) == bool(y) for _, t, y in fresh]
    assert np.mean(hits) > 0.97


def test_inserted_characters_score_higher_than_clean_text(model):
    score, table = model
    clean = X.peaks("tarino meka sulo denfi gruta", table)[0]
    for word in ("snarkle", "snaxrkle", "s-narkle", "vilep.up", "blorg face"):
        assert X.peaks(word, table)[0] > clean + 0.3


def test_long_texts_are_scored_whole(model, monkeypatch):
    _, table = model
    text = "tarino meka sulo. " * 400 + "you snarkle " + "denfi gruta. " * 400
    whole = X.peaks(text, table)[0]
    monkeypatch.setattr(X, "PIECE", 500)
    assert abs(X.peaks(text, table)[0] - whole) < 1e-4
    assert whole > 1


def plain_peaks(text, weights):
    """Worst stretches by the definition: the decision value of a start is the
    weighted sum over all letter subsequences of length 3 and 4 from it that
    span at most SPAN + 1 characters (SPAN for three letters)."""
    codes = [int(c) for c in X.codes_of(text)]
    starts = []
    for i in range(len(codes)):
        total = 0.0
        for n in (3, 4):
            reach = X.SPAN - 1 if n == 3 else X.SPAN
            for rest in itertools.combinations(range(i + 1, min(len(codes), i + reach + 1)), n - 1):
                picked = [codes[i]] + [codes[j] for j in rest]
                if 0 not in picked:
                    number = 0
                    for c in picked:
                        number = number * X.SYMBOLS + c
                    total += X.DECAY ** (rest[-1] - i + 1) * weights.get(number, 0.0)
        starts.append(total)
    runs = [sum(starts[i:i + X.STRETCH]) for i in range(len(starts))]
    tiles = [max(runs[i:i + X.TILE]) for i in range(0, len(runs), X.TILE)]
    return sorted(tiles + [0.0] * X.PEAKS, reverse=True)[:X.PEAKS]


def test_scores_equal_a_plain_scorer():
    rows = corpus(300, seed=5)
    weights, curve = X.train([r[1] for r in rows], [bool(r[2]) for r in rows])
    table = np.zeros(X.N_CODES, np.float32)
    table[list(weights)] = list(weights.values())
    texts = [t for _, t, _ in corpus(40, seed=6)] + \
        ["", "a", "s.n.a.r.k.l.e", "snärkle Éa", "ｓｎａｒｋｌｅ vile", "x" * 90, "привет snarkle"]
    for text in texts:
        want = plain_peaks(text, weights)
        got = X.peaks(text, table)
        assert np.allclose(got, want, atol=1e-3), text
        assert abs(X.probability(got, curve) - X.probability(np.array(want), curve)) < 1e-3


def test_letters_of_all_scripts_have_codes(model):
    score, _ = model
    clean = "tarino meka sulo denfi gruta. " * 6
    for styled in ("ｓｎａｒｋｌｅ", "ＳＮＡＲＫＬＥ", "𝐬𝐧𝐚𝐫𝐤𝐥𝐞"):
        assert unicodedata.normalize("NFKC", styled).lower() == "snarkle"
        assert score(clean + styled) == score(clean + "snarkle")
    for letters in ("дурак", "ηλίθιε", "أحمق", "笨蛋", "바보", "\U00020000\U00020001"):
        assert (X.codes_of(letters)[1:] >= X.SCRIPT).sum() >= 2
        assert X.codes_of(letters).max() < X.SYMBOLS
    assert (X.codes_of("ДУРАК") == X.codes_of("дурак")).all()
    assert not X.codes_of("🙂 1,2 \U000E0041")[1:].any()


def test_toxic_words_of_another_script_are_learned():
    to = {ord(a): b for a, b in zip("abcdefghijklmnoprstuvwxyz", "абцдефгхийклмнопрстувшжыз")}
    rows = [(i, t.translate(to), y) for i, t, y in corpus(600, seed=8)]
    weights, curve = X.train([r[1] for r in rows], [bool(r[2]) for r in rows])
    table = np.zeros(X.N_CODES, np.float32)
    table[list(weights)] = list(weights.values())
    fresh = [(t.translate(to), y) for _, t, y in corpus(300, seed=78)]
    hits = [(X.probability(X.peaks(t, table), curve) >= 0.5) == bool(y) for t, y in fresh]
    assert np.mean(hits) > 0.9


def test_one_class_only():
    weights, curve = X.train(["abc def"], [False])
    assert not weights and X.probability(np.zeros(X.PEAKS), curve) < 0.01
    assert X.probability(np.zeros(X.PEAKS), X.train([], [])[1]) < 0.01


def test_query(spark, tmp_path):
    rows = corpus(500)
    docs = [(i, t, "en", "s", len(t)) for i, t, _ in rows] + \
        [(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in awkward_docs()]
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    folder = write_tables(spark, tmp_path / "a", documents=docs_frame(spark, docs), labels=labels)
    out = QUERIES["op10_toxicity"](spark, folder).collect()
    assert len(out) == len(docs)
    truth = {i: y for i, _, y in rows}
    for r in out:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    empty = write_tables(spark, tmp_path / "e", documents=docs_frame(spark).limit(0),
                         labels=labels.limit(0))
    assert QUERIES["op10_toxicity"](spark, empty).count() == 0
