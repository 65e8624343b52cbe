"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 10).

Kernel. Two stretches of text are compared by the letter subsequences of
length 3 and 4 they share, each weighted by ``DECAY`` to the number of
characters it spans, gaps included, up to a span of ``SPAN``. Letters inserted
into a word, or signs between its letters, therefore leave most of an
insult's subsequences in place, at a lower weight.

Nystroem. The landmarks are letter groups that toxic training documents hold
far more often than clean ones, and frequent groups of clean ones. With the
landmarks' kernel matrix K, a stretch x has the features K^(-1/2) k(x), on
which a linear SVM is trained. Its decision value is a weighted sum of
k(x, landmark), and so a weighted sum over x's subsequences: the model comes
down to one weight per subsequence, and a text of any length is scored by
looking up the subsequences that start at each character.

Training. Labels are of documents. A document is a bag of sentences: each
sentence of a clean document is clean, and of a toxic one at least the worst
sentence is toxic. The SVM is trained on the worst stretch of each bag (for
clean documents, of several sentences), found again after each round. A
document's worst stretches (``PEAKS`` of them) give its score by a logistic
curve fitted to the training documents.

Only labelled rows outside the held-out fold (crc32 of the id's decimal text,
modulo 5, is 0) are learned from; text is the only input of a score. The
sample is bounded by ``MAX_TOXIC`` and ``MAX_CLEAN`` documents of up to
``MAX_CHARS`` code points, drawn by digest of the id.

Letters are compared without case and in their compatibility form, so
full-width and styled Latin letters are the plain ones. Letters of other
scripts share the ``SYMBOLS - SCRIPT`` codes that remain, by a digest of the
code point; vowel signs and other marks are no letters.

Null and empty texts have the decision value 0 of a text without
subsequences. Null and repeated ids are allowed; of an id's rows one text is
learned from (a null id is not held out
and carries no label); conflicting labels of an id count as toxic. Without
both classes in the sample every score is the share of toxic labels (0.0
without labels).
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.common import Rows, arrow_map, store

FOLDS = 5
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1_500, 3_000, 20_000   # bounds of the training sample
GRAM_SIZES = (4, 5)        # letter groups that may become landmarks
START_SIZES = (4, 5, 6, 7, 8)   # those at the start of a word
LANDMARKS = 192
BACKGROUND = 32            # of these, frequent groups of clean text
LEAST_RATIO = 5
DECAY, SPAN = 0.7, 5
STRETCH = 10               # characters whose subsequences are summed
PEAKS, TILE = 3, 24        # a text is judged by its worst stretches, one a tile
ROUNDS = 3
SENTENCES = 3              # worst sentences of a document that are trained on
CLEAN_QUANTILE = 0.995     # toxic documents' further sentences must exceed clean ones' so far
PIECE = 1 << 18            # characters scored at a time

# Letter codes 1-26 a to z, then START (the sign before a word),
# OTHER Latin letters, accented ones by base, letters of other scripts from
# SCRIPT on; 0 is everything else.
START, OTHER = 27, 28
ACCENTED = "eaioun"
SCRIPT, SYMBOLS = 35, 48
LATIN, PLANES, IDEOGRAPHS = 0x250, 0x20000, 0x40000   # ends of ranges of code points


def script_code(points):
    """Code of letters (code points) of scripts other than Latin."""
    return SCRIPT + (points * 0x9E3779B1 >> 16) % (SYMBOLS - SCRIPT)


def _letter_codes() -> np.ndarray:
    """Code of each code point below PLANES; case is dropped."""
    out = np.zeros(PLANES, np.uint8)
    for cp in range(LATIN):
        low = chr(cp).lower()
        base = unicodedata.normalize("NFD", low)[0]
        if not low[0].isalpha():
            continue
        if low == base and "a" <= base <= "z":
            out[cp] = ord(base) - 96
        elif base in ACCENTED:
            out[cp] = OTHER + 1 + ACCENTED.index(base)
        else:
            out[cp] = OTHER
    for cp in range(LATIN, PLANES):
        if not chr(cp).isalpha():
            continue
        low = ord(unicodedata.normalize("NFKC", chr(cp)).lower()[0])
        base = ord(unicodedata.normalize("NFD", chr(low))[0])
        if low < LATIN:
            out[cp] = out[low]
        elif base < LATIN:   # a Latin letter with marks beyond the first blocks
            accent = ACCENTED.find(chr(base))
            out[cp] = OTHER + 1 + accent if accent >= 0 else OTHER
        else:
            out[cp] = script_code(base)
    return out


CODES = _letter_codes()


def codes_of(text: str) -> np.ndarray:
    """One code per character, and one in front of the text."""
    points = np.frombuffer((" " + text).encode("utf-32-le", "replace"), np.uint32)
    c = CODES[np.minimum(points, PLANES - 1)] * (points < PLANES)
    if len(points) and points.max() >= PLANES:
        far = (points >= PLANES) & (points < IDEOGRAPHS)
        c[far] = script_code(points[far].astype(np.int64))
    c[:-1][(c[:-1] == 0) & (c[1:] > 0)] = START
    return c


def _patterns() -> list[tuple[tuple[int, ...], float]]:
    """Offsets of subsequences of 3 and 4 letters with their weights."""
    out = []
    for a in range(1, SPAN - 1):
        for b in range(a + 1, SPAN):
            out.append(((a, b), DECAY ** (b + 1)))
            for c in range(b + 1, SPAN + 1):
                out.append(((a, b, c), DECAY ** (c + 1)))
    return out


PATTERNS = _patterns()
N_CODES = SYMBOLS ** 4     # shorter subsequences have 0 as their leading letter


def subsequences(codes: np.ndarray):
    """(start position, subsequence number, weight) arrays, one pattern at a
    time; positions whose subsequence holds a non-letter are left out."""
    n = len(codes)
    c = codes.astype(np.int32)
    for offsets, weight in PATTERNS:
        m = n - offsets[-1]
        if m <= 0:
            continue
        number, ok = c[:m], c[:m] > 0
        for o in offsets:
            nxt = c[o:o + m]
            number = number * SYMBOLS + nxt
            ok = ok & (nxt > 0)
        at = np.flatnonzero(ok)
        yield at, number[at], weight


def kernel_vector(letters: bytes) -> Counter:
    """Explicit kernel features of a letter group."""
    out: Counter = Counter()
    for _, numbers, weight in subsequences(np.frombuffer(letters, np.uint8)):
        for k in numbers.tolist():
            out[k] += weight
    return out


def weigh(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per start position, the summed weight of the subsequences that start there."""
    out = np.zeros(len(codes), np.float32)
    c = codes.astype(np.int32)
    n = len(c)
    pairs = {}   # letters are nonzero in the table's subsequences, others weigh 0
    for a in range(1, SPAN):
        m = n - a
        if m > 0:
            pairs[a] = c[:m] * SYMBOLS + c[a:]
    for offsets, weight in PATTERNS:
        m = n - offsets[-1]
        if m <= 0:
            continue
        number = pairs[offsets[0]][:m] * SYMBOLS + c[offsets[1]:offsets[1] + m]
        if len(offsets) == 3:
            number = number * SYMBOLS + c[offsets[2]:offsets[2] + m]
        out[:m] += np.float32(weight) * table[number]
    out[c == 0] = 0   # no letter starts there, though its 4-letter numbers look like 3-letter ones
    return out


def stretches(starts: np.ndarray) -> np.ndarray:
    """Sum over each run of STRETCH start positions, by first position."""
    total = np.concatenate([[0.0], np.cumsum(starts, dtype=np.float64)])
    ends = np.minimum(np.arange(len(starts)) + STRETCH, len(starts))
    return total[ends] - total[:-1]


def peaks(text: str, table: np.ndarray) -> np.ndarray:
    """Decision values of a whole text's PEAKS worst stretches, worst first,
    one per tile of TILE characters; worked on in overlapping pieces."""
    best, step = np.zeros(PEAKS), PIECE - TILE
    for at in range(0, max(1, len(text)), step):
        part = codes_of(text[at:at + PIECE])
        value = stretches(weigh(part, table))[:step if at + PIECE < len(text) else None]
        tiles = np.maximum.reduceat(value, np.arange(0, len(value), TILE))
        best = np.sort(np.concatenate([best, tiles]))[::-1][:PEAKS]
    return best


def train_svm(x: np.ndarray, y: np.ndarray, reg: float = 1e-3, rounds: int = 30):
    """Linear SVM with squared hinge loss, classes balanced, by Newton steps;
    returns weights and offset."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(x1.shape[1])
    ridge = np.full(len(w), reg)
    ridge[-1] = 1e-9
    for _ in range(rounds):
        active = y * (x1 @ w) < 1
        xa, sa = x1[active], share[active]
        new = np.linalg.solve((xa * sa[:, None]).T @ xa + np.diag(ridge),
                              xa.T @ (sa * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], w[-1]


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the offset) of a logistic curve, softened targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-4 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(values: np.ndarray, curve) -> float:
    z = float(np.dot(values, curve[:-1]) + curve[-1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def sentences(text: str) -> list[tuple[int, int]]:
    """Bounds of sentences: they end at a full stop, ! or ? or line end."""
    marks = [i + 1 for i, ch in enumerate(text) if ch in ".!?\n"]
    bounds = [0] + marks + [len(text)]
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def grams_of(text: str) -> set[bytes]:
    """Distinct letter groups of a text, as codes: inside words, and from the
    start of words on (with the START sign)."""
    raw = codes_of(text).tobytes()
    words = {bytes([START]) + w for x in raw.split(b"\0") for w in x.split(bytes([START])) if w}
    out = {w[i:i + n] for w in words for n in GRAM_SIZES for i in range(1, len(w) - n + 1)}
    return out | {w[:n] for w in words for n in START_SIZES if len(w) >= n}


def pick_landmarks(toxic: list[set[bytes]], clean: list[set[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """(landmarks, first weights): the groups that toxic documents hold
    LEAST_RATIO times as often, by the significance of the difference, weighed
    by log odds; then frequent groups of clean documents, weighed 0."""
    t, c = Counter(g for s in toxic for g in s), Counter(g for s in clean for g in s)
    nt, nc = len(toxic), len(clean)

    def odds(g):
        return math.log((t[g] + 0.5) / (nt + 1)) - math.log((c[g] + 0.5) / (nc + 1))

    def significance(g):
        p, q, both = t[g] / nt, c[g] / nc, (t[g] + c[g]) / (nt + nc)
        return (p - q) / math.sqrt(max(both * (1 - both), 1e-12) * (1 / nt + 1 / nc))

    marked: list[bytes] = []
    for g in sorted((g for g in t if odds(g) > math.log(LEAST_RATIO) and significance(g) > 4),
                    key=lambda g: (-significance(g), -len(g), g)):
        # a part or an extension of a landmark found in the same documents adds nothing
        if not any((g in m or m in g) and abs(t[g] - t[m]) <= 0.05 * t[m] for m in marked):
            marked.append(g)
        if len(marked) == LANDMARKS - BACKGROUND:
            break
    plain = [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))
             if g not in marked][:BACKGROUND]
    return marked + plain, np.array([odds(g) for g in marked] + [0.0] * len(plain))


def train(texts: list[str], toxic: list[bool]) -> tuple[dict[int, float], list[float]]:
    """(weight per subsequence, logistic curve) from a bounded sample."""
    y = np.where(toxic, 1.0, -1.0)
    share = float(np.mean(toxic)) if len(texts) else 0.0
    if not (y > 0).any() or not (y < 0).any():
        p = min(max(share, 1e-9), 1 - 1e-9)
        return {}, [0.0] * PEAKS + [math.log(p / (1 - p))]
    grams = [grams_of(t) for t in texts]
    marks, first = pick_landmarks([g for g, v in zip(grams, y) if v > 0],
                                  [g for g, v in zip(grams, y) if v < 0])
    vectors = [kernel_vector(m) for m in marks]
    number = {k: i for i, k in enumerate(sorted({k for v in vectors for k in v}))}
    land = np.zeros((len(vectors), len(number)))
    for i, v in enumerate(vectors):
        for k, z in v.items():
            land[i, number[k]] = z
    norm = np.linalg.norm(land, axis=1, keepdims=True)
    land /= norm
    values, basis = np.linalg.eigh(land @ land.T)
    keep = values > 1e-8
    root = (basis[:, keep] / np.sqrt(values[keep])) @ basis[:, keep].T   # K^(-1/2)
    project = root @ land                       # subsequence -> feature
    place = np.full(N_CODES, -1, np.int32)
    place[list(number)] = np.arange(len(number))
    codes = [codes_of(t) for t in texts]
    bounds = [sentences(t) for t in texts]

    # first guess: landmarks weigh by their log odds
    table = np.zeros(N_CODES, np.float32)
    table[list(number)] = (first / norm[:, 0]) @ land

    def features(parts: np.ndarray) -> np.ndarray:
        """Nystroem features of stretches, one row of letter codes each."""
        out = []
        for at in range(0, len(parts), 500):
            c = parts[at:at + 500].astype(np.int32)
            found = np.zeros(len(c) * len(number))
            for offsets, weight in PATTERNS:
                digits = [c[:, :STRETCH]] + [c[:, o:o + STRETCH] for o in offsets]
                code, ok = digits[0], digits[0] > 0
                for d in digits[1:]:
                    code, ok = code * SYMBOLS + d, ok & (d > 0)
                k = np.where(ok, place[code], -1)
                row, _ = np.nonzero(k >= 0)
                found += np.bincount(row * len(number) + k[k >= 0],
                                     minlength=len(found)) * weight
            out.append(found.reshape(len(c), -1) @ project.T)
        return np.vstack(out)

    width = STRETCH + SPAN
    for _ in range(ROUNDS):
        tops = []   # (value, document, position) of each document's worst sentences
        for n, (c, spans) in enumerate(zip(codes, bounds)):
            if len(c):
                value = stretches(weigh(c, table))
                value = value[1:]   # codes stand one behind their characters
                ends = np.array([a for a, _ in spans])
                best = np.maximum.reduceat(value, ends)
                for k in np.argsort(-best, kind="stable")[:SENTENCES]:
                    a, b = spans[k]
                    tops.append((float(best[k]), n, a + int(value[a:b].argmax())))
        clean = np.array([v for v, n, _ in tops if y[n] < 0])
        least = np.quantile(clean, CLEAN_QUANTILE) if len(clean) else 0.0
        chosen, seen = [], set()
        for v, n, at in tops:
            if y[n] < 0 or n not in seen or v > least:
                chosen.append((n, at))
            seen.add(n)
        parts = np.zeros((len(chosen), width), np.uint8)
        for row, (n, at) in zip(parts, chosen):
            part = codes[n][at:at + width]
            row[:len(part)] = part
        w, _ = train_svm(features(parts), np.array([y[n] for n, _ in chosen]))
        table[:] = 0
        table[list(number)] = w @ project
    curve = fit_logistic(np.array([peaks(t, table) for t in texts]), y)
    return {k: float(table[k]) for k in number}, curve.tolist()


def held_out(doc_id: str = "doc_id"):
    """True for the fold that is never learned from; null ids are not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame):
    """Model (weights, curve) from the bounded sample, trained in one task."""
    truth = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out()))
    fits = (F.col("text") != "") & (F.char_length("text") <= MAX_CHARS)
    # ids and labels travel, texts do not: the chosen ids, bounded by the
    # constants above, go to the texts
    known = (docs.filter(fits).select("doc_id").join(truth, "doc_id").distinct())
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = store(known.filter("toxic >= 1").orderBy(order).limit(MAX_TOXIC).unionByName(
        known.filter("toxic < 1").orderBy(order).limit(MAX_CLEAN)), "toxic-ids")
    sample = store(docs.filter(fits).select("doc_id", "text")
                   .join(F.broadcast(chosen), "doc_id")
                   .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
                   .select("doc_id", "text", "toxic"), "toxic-sample")
    schema = pa.schema([("number", pa.int64()), ("weight", pa.float64())])

    def run(batches):
        sample = sorted((t, i, v >= 1) for batch in batches for i, t, v in
                        zip(*[batch.column(k).to_pylist() for k in range(3)]))
        weights, curve = train([s[0] for s in sample], [s[2] for s in sample])
        out = [(-1 - k, v) for k, v in enumerate(curve)] + sorted(weights.items())
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                          pa.array([o[1] for o in out], pa.float64())],
                                         schema=schema)

    # one task: the sample is bounded by its constants
    model = arrow_map(sample.select("doc_id", "text", "toxic").coalesce(1), run,
                      "number bigint, weight double")
    found = {r.number: r.weight for r in model.collect()}   # landmarks' subsequences only
    curve = [found.pop(-1 - k) for k in range(PEAKS + 1)]
    return found, curve


def score(spark: SparkSession, docs: DataFrame, model) -> DataFrame:
    """Per document row: doc_id, value (of its worst stretch) and score."""
    sent = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("value", pa.float64()), ("score", pa.float64())])

    def run(batches):
        weights, curve = sent.value
        table = np.zeros(N_CODES, np.float32)
        table[list(weights)] = list(weights.values())
        rows = Rows(schema)
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                values = peaks(t.as_py() or "", table)
                if rows.add(24, i.as_py(), values[0], probability(values, curve)):
                    yield rows.take()
        yield from rows.rest()

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run,
                     "doc_id bigint, value double, score double")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(spark, docs, fit(spark, docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
