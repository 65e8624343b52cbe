"""Document fingerprints by context-triggered piecewise hashing (operator 11).

A rolling hash over the last ``WINDOW`` code points ends a chunk wherever it is
one less than a multiple of the block size (3 times a power of two), so chunk
borders depend on nearby text only and move along with it. A fingerprint is
``size:chunks at size:chunks at 2 * size``, two characters (12 bits of a
polynomial hash of the whole chunk) for each chunk.

- The block size follows the text's length alone: about ``CHUNKS`` / 2 to
  ``CHUNKS`` chunks. Where two block sizes pass without a border (repetitive
  text), a chunk ends there.
- A signature holds at most ``2 * CHUNKS`` chunks; the last one then is the whole
  rest of the text. Every code point of a text enters its fingerprint.
- ``likeness`` compares signatures of equal block size: 1 - (insertions and
  deletions between them) / (chunks of both), the greater value where both sizes
  agree, 0 where none does, 1 for equal fingerprints. Replacing half of a text
  at most halves its length, so the two stay comparable.

``neighbours`` puts documents in order of id (nulls last, rows of one id by
digest of the text, equal rows next to each other) and compares each with the
next and with its edited text. Rows are range-partitioned by id, digest and row
number, so that a hot id is split; each task streams its sorted rows, holding
two texts, and the last row of a task meets the first row of the next one in a
small second step. Texts are shuffled once. The row after the last is the first
one; a single row is its own neighbour.

Null and empty texts have the fingerprint ``3::``; a null id is kept; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import Rows, arrow_map, store

WINDOW = 7
CHUNKS = 64
SMALLEST = 3
BLOCK = 1 << 18        # code points worked on at a time

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
TOKENS = [a + b for a in ALPHABET for b in ALPHABET]

_WRAP = 1 << 64
_STEP = 0x9E3779B97F4A7C15              # odd: has an inverse modulo 2^64
_BACK = pow(_STEP, -1, _WRAP)
_ROLL = [np.uint64(pow(0xD1342543DE82EF95, k, _WRAP)) for k in range(WINDOW)]


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: dict[str, np.ndarray] = {}


def _table(name: str, base: int) -> np.ndarray:
    if name not in _tables:
        _tables[name] = _powers(base, BLOCK + 1)
    return _tables[name]


def _mixed(x: np.ndarray) -> np.ndarray:
    """32 well-mixed bits of each number."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(32)


def _borders(text: str):
    """Per block of the text: (first position, code points, ends of possible
    chunks in the block, level of each): a chunk of level k ends where the
    rolling hash plus one divides by 3 * 2^k."""
    before = np.zeros(WINDOW - 1, np.uint64)
    for base in range(0, len(text), BLOCK):
        c = np.frombuffer(text[base:base + BLOCK].encode("utf-32-le"), np.uint32).astype(np.uint64)
        c += np.uint64(1)
        wide = np.concatenate([before, c])
        n = len(c)
        roll = wide[WINDOW - 1:].copy()
        for k in range(1, WINDOW):
            roll += wide[WINDOW - 1 - k:WINDOW - 1 - k + n] * _ROLL[k]
        before = wide[-(WINDOW - 1):]
        v = _mixed(roll) + np.uint64(1)
        at = np.flatnonzero(v % np.uint64(SMALLEST) == 0)
        low = v[at]
        level = np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64)
        yield base, c, at + 1, level


def _cuts(ends: np.ndarray, last: int, stop: int, whole: int, size: int) -> np.ndarray:
    """Ends of chunks up to ``stop``: the given borders, and a cut every
    ``2 * size`` code points where the next border is farther away. ``last`` is
    the end before; the text's end (``whole``) ends the last chunk."""
    if stop < whole:
        fence = np.append(ends, stop + 1)     # only a limit for cuts
    elif len(ends) and ends[-1] == whole:
        fence = ends
    else:
        fence = np.append(ends, whole)
    start = np.concatenate([[last], fence[:-1]])
    extra = (fence - start - 1) // (2 * size)
    if extra.any():
        group = np.repeat(np.arange(len(fence)), extra + 1)
        turn = np.arange(len(group)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
        fence = np.where(turn < extra[group], start[group] + (turn + 1) * 2 * size, fence[group])
    return fence[:-1] if stop < whole else fence


def _longer(known: np.ndarray, more: np.ndarray) -> np.ndarray:
    """At most ``2 * CHUNKS`` chunks: all others join the last one."""
    both = np.concatenate([known, more])
    return both if len(both) <= 2 * CHUNKS else np.append(both[:2 * CHUNKS - 1], both[-1])


def _signature(sums: np.ndarray, back: np.ndarray) -> str:
    """Tokens of the chunks between ends, from the running sum at each end and
    the power that takes it back to the start of a text."""
    start = np.concatenate([np.zeros(1, np.uint64), sums[:-1]])
    shift = np.concatenate([np.ones(1, np.uint64), back[:-1]])
    return "".join([TOKENS[h] for h in (_mixed((sums - start) * shift) & np.uint64(4095)).tolist()])


def fingerprint(text: str) -> str:
    n, k = len(text), 0
    if not n:
        return f"{SMALLEST}::"
    while (SMALLEST << k) * CHUNKS < n:
        k += 1
    none = np.zeros(0, np.uint64)
    last, sums, back, total = [0, 0], [none, none], [none, none], 0
    up, down = _table("up", _STEP), _table("down", _BACK)
    for base, c, at, level in _borders(text):
        run = np.cumsum(c * up[:len(c)], dtype=np.uint64)
        if base:
            run *= np.uint64(pow(_STEP, base, _WRAP))
            run += np.uint64(total)
        total = int(run[-1])
        away = np.uint64(pow(_BACK, base, _WRAP))
        for j in (0, 1):
            ends = _cuts(at[level >= k + j] + base, last[j], base + len(c), n, SMALLEST << (k + j))
            if len(ends):
                last[j] = int(ends[-1])
                sums[j] = _longer(sums[j], run[ends - base - 1])
                back[j] = _longer(back[j], down[ends - base] * away)
    return f"{SMALLEST << k}:{_signature(sums[0], back[0])}:{_signature(sums[1], back[1])}"


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    places: dict[str, int] = {}
    for i, t in enumerate(a):
        places[t] = places.get(t, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for t in b:
        u = v & places.get(t, 0)
        if u:
            v = (v + u) | (v - u)
    return len(a) - (v & full).bit_count()


def _likeness(a: str, b: str) -> float:
    x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    if not x or not y:
        return 0.0
    edits = len(x) + len(y) - 2 * _common(x, y)
    return 1.0 - edits / (len(x) + len(y))


def likeness(one: str, other: str) -> float:
    """0 to 1: how much of two texts agrees, from their fingerprints."""
    if one == other:
        return 1.0
    (s, a, aa), (t, b, bb) = one.split(":"), other.split(":")
    s, t = int(s), int(t)
    if s == t:
        return max(_likeness(a, b), _likeness(aa, bb))
    if s == 2 * t:
        return _likeness(a, bb)
    if t == 2 * s:
        return _likeness(aa, b)
    return 0.0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint. No shuffle."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    return arrow_map(docs.select(F.col(doc_id), F.col(text)), work,
                     f"doc_id {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(key, text: str, own: str, following: str, next_print: str) -> tuple:
    new = edited(text, following)
    print_ = own if new == text else fingerprint(new)
    return (key, len(text), hashlib.sha256(new.encode()).hexdigest(), own, print_,
            likeness(own, print_), likeness(own, next_print))


_RESULT = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
           ("near_next", pa.float64())]
_RESULT_DDL = ("n_chars bigint, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")

# Rows of the first step: compared rows, and the first and last row of a task.
DONE, FIRST, LAST = 0, 1, 2


def _stream(batches):
    """Sorted rows (id, text, tie, row) of one task: each row compared with the
    next; the first and the last are also handed on with their texts."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    rows, before = None, None
    for batch in batches:
        if rows is None:
            rows = Rows(pa.schema([("doc_id", batch.schema.field(0).type), *_RESULT,
                                   ("kind", pa.int32()), ("part", pa.int32()),
                                   ("text", pa.string()), ("tie", pa.string()),
                                   ("row", pa.int64())]))
        for i in range(batch.num_rows):
            key, text, tie, row = (batch.column(k)[i].as_py() for k in range(4))
            text = text or ""
            if before and before[1] == text:
                own = before[2]
            else:
                own = fingerprint(text)
            if before is None:
                due = rows.add(len(text), key, len(text), None, own, None, None, None,
                               FIRST, part, text, tie, row)
            else:
                out = _compared(*before[:3], text, own)
                due = rows.add(len(own) * 2, *out, DONE, part, None, None, None)
            before = (key, text, own, tie, row)
            if due:
                yield rows.take()
    if before:
        key, text, own, tie, row = before
        rows.add(len(text), key, len(text), None, own, None, None, None, LAST, part, text, tie, row)
        yield from rows.rest()


def _close(batches):
    """The last row of each task compared with the first row of the next task."""
    for batch in batches:
        out = [_compared(*(c[i].as_py() for c in batch.columns)) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], batch.schema.field(0).type)]
            + [pa.array([r[k] for r in out], t) for k, (_, t) in enumerate(_RESULT, 1)],
            names=["doc_id"] + [name for name, _ in _RESULT])


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    kind = docs.schema[doc_id].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("row")]
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
                        F.monotonically_increasing_id().alias("row"))
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    first_step = store(arrow_map(ranged, _stream, f"doc_id {kind}, {_RESULT_DDL}, kind int, "
                                 "part int, text string, tie string, row bigint"), "ctph")
    names = ["doc_id", *[name for name, _ in _RESULT]]
    heads = first_step.filter(F.col("kind") == FIRST)
    # one narrow row a task: which task holds the rows that follow
    along = Window.orderBy(*order)
    following = heads.select("doc_id", "tie", "row", "part").select(
        "part", F.coalesce(F.lead("part").over(along),
                           F.first("part").over(along)).alias("next_part"))
    pairs = (first_step.filter(F.col("kind") == LAST).select("part", "doc_id", "text", "fingerprint")
             .join(following, "part")
             .join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"),
                                F.col("fingerprint").alias("next_print")), "next_part")
             .select("doc_id", "text", "fingerprint", "next_text", "next_print"))
    return (first_step.filter(F.col("kind") == DONE).select(*names)
            .unionByName(arrow_map(pairs, _close, f"doc_id {kind}, {_RESULT_DDL}")))
