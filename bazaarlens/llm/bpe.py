"""Byte-level BPE as a lazily determinised finite-state transducer (operator 3).

Encoding. A token sequence is the merge result of its bytes exactly when
every token encodes to itself and every neighbouring pair encodes to itself,
so BPE is a regular relation: a nondeterministic transducer guesses token
starts and checks each neighbouring pair. ``Transducer`` determinises it while
it reads: a state is the set of live guesses (trie node of the unfinished
token, token before it); transitions are computed on first use and kept, and
each tells the one token that ends there in the encoding of the prefix read.
A guess lives at most as long as the longest token, and the live guesses'
token boundaries soon agree; what stands before the last boundary they share
is settled. Every ``SETTLE`` bytes the settled tokens are emitted and only the
bytes after them are remembered, so memory does not grow with the length of a
piece. The state table is emptied when it outgrows ``MAX_STATES``; the result
does not depend on it.

Decoding streams: token bytes go through an incremental UTF-8 state machine
that hands on whole characters and holds back an unfinished one.

Null texts have no tokens and decode to no bytes; texts of any length are
worked on in windows that end where a word ends (by the split pattern's own
white space), which the split pattern never crosses. Empty tables give empty
results; other columns of the documents are kept, of which none may be named
like the result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.common import arrow_map

LEAF: dict[int, int] = {}  # of all trie nodes without children
MAX_STATES = 200_000  # per worker; about 0.5 kB each
MAX_PIECES = 250_000  # per generation; about 0.2 kB each
MAX_KEPT = 256  # characters of a piece that is kept with its ids
SETTLE = 4096  # bytes after which the settled tokens of a piece are emitted
WINDOW = 1 << 18  # characters worked on at a time


def default_vocabulary() -> tuple[str, str]:
    """(path of the rank file, split pattern) of the public vocabulary."""
    import public_tokenizers as P
    return P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank; ranks must be dense from 0."""
    pairs = {}
    with open(path, "rb") as f:
        for line in f:
            token, rank = line.split()
            pairs[int(rank)] = base64.b64decode(token)
    return [pairs[i] for i in range(len(pairs))]


class Merges:
    """Pair checks by the ranks: which merge rebuilds a token, and whether
    two neighbouring tokens stay apart."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.left = [-2] * len(tokens)    # halves of each token; -2: not yet known
        self.right = [-1] * len(tokens)
        self._apart: dict[int, bool] = {}

    def merge(self, piece: bytes, stop: int = 1 << 60) -> list[bytes]:
        """Merge by lowest rank, leftmost first; for single tokens only."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        rank = self.rank
        while len(parts) > 1:
            best, at = stop, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1], stop)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halve(self, token: int) -> int:
        """Fill in the two tokens whose merge makes ``token``; left is -1 for a byte."""
        t = self.tokens[token]
        parts = self.merge(t, token) if len(t) > 1 else []
        if len(parts) == 2:
            self.left[token], self.right[token] = self.rank[parts[0]], self.rank[parts[1]]
        else:
            self.left[token] = -1
        return self.left[token]

    def apart(self, left: int, right: int) -> bool:
        """True when ``left right`` is the merge result of its own bytes.

        Merges are undone from the latest: the pair stays apart unless, at
        some moment of the two merge histories, the pieces that face each
        other would merge before either side's next merge."""
        key = left << 32 | right
        got = self._apart.get(key)
        if got is None:
            if len(self._apart) > 4 * MAX_STATES:
                self._apart.clear()
            got = self._apart[key] = self._check(left, right)
        return got

    def _check(self, left: int, right: int) -> bool:
        tokens, rank, halves, ends = self.tokens, self.rank, self.left, self.right
        limit = 1 << 60  # a facing merge of lower rank than this would have come first
        while True:
            joined = rank.get(tokens[left] + tokens[right])
            if joined is not None and joined < limit:
                return False
            in_left = halves[left]
            if in_left == -2:
                in_left = self._halve(left)
            in_right = halves[right]
            if in_right == -2:
                in_right = self._halve(right)
            if in_left >= 0 and (in_right < 0 or left > right):
                limit, left = left, ends[left]
            elif in_right < 0:
                return True
            else:  # of equal ranks the left one merges first
                limit, right = right + 1, in_right


class Transducer:
    """The lazily determinised encoder of one vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.merges = Merges(tokens)
        self.size = [len(t) for t in tokens]
        self.child: list[dict[int, int]] = [{}]   # trie
        self.ends: list[int] = [-1]
        self.depth = array("H", [0])
        for i, t in enumerate(tokens):
            node = 0
            for b in t:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = len(self.child)
                    self.child.append({})
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.child[node][b] = nxt
                node = nxt
            self.ends[node] = i
        self.child = [c or LEAF for c in self.child]
        self._clear()

    def _clear(self, live: tuple = ((0, -1),)) -> int:
        """Forget all states but the first and one of the guesses ``live``,
        whose number (times 256) is returned."""
        start = ((0, -1),)
        self.states = list(dict.fromkeys((start, live)))
        self.number = {s: i << 8 for i, s in enumerate(self.states)}
        self.step: dict[int, tuple[int, int]] = {}   # by 256 * state + byte
        return self.number[live]

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """(256 * next state, token that ends here in the encoding of the prefix)."""
        closing, alive, child = -1, [], self.child
        for node, last in self.states[state >> 8]:
            nxt = child[node].get(byte)
            if nxt is None:
                continue
            if closing < 0:
                token = self.ends[nxt]
                if token >= 0 and (last < 0 or self.merges.apart(last, token)):
                    closing = token
            if child[nxt] is not LEAF:
                alive.append((nxt, last))
        if closing < 0:
            raise ValueError("the vocabulary lacks a byte")
        alive.append((0, closing))
        new = tuple(alive)
        at = self.number.get(new)
        if at is None:
            at = self.number[new] = len(self.states) << 8
            self.states.append(new)
        got = self.step[state | byte] = at, closing
        return got

    def _settled(self, state: int, closing: list[int]) -> int:
        """Last token boundary on which all live guesses agree, as a number of
        the bytes remembered: their starts are walked back until they meet."""
        n, size = len(closing), self.size
        starts = {n - self.depth[node] for node, _ in self.states[state >> 8]}
        while len(starts) > 1:
            last = max(starts)
            starts.remove(last)
            starts.add(last - size[closing[last - 1]])
        return starts.pop()

    def _walk_back(self, closing: list[int], at: int) -> list[int]:
        """Tokens of the first ``at`` bytes remembered."""
        ids, size = [], self.size
        while at:
            token = closing[at - 1]
            ids.append(token)
            at -= size[token]
        ids.reverse()
        return ids

    def _read(self, raw: bytes, state: int, closing: list[int]) -> int:
        """Next state after ``raw``; the token that ends at each byte is added
        to ``closing``."""
        if len(self.states) > MAX_STATES:
            state = self._clear(self.states[state >> 8])
        step, add = self.step.get, closing.append
        for b in raw:
            got = step(state | b)
            if got is None:
                got = self._move(state, b)
            state, token = got
            add(token)
        return state

    def emit(self, piece: bytes) -> Iterator[list[int]]:
        """Runs of ids of one match of the split pattern, as they are settled."""
        closing: list[int] = []
        state = self._read(piece[:SETTLE], 0, closing)
        for start in range(SETTLE, len(piece), SETTLE):
            done = self._settled(state, closing)
            yield self._walk_back(closing, done)
            del closing[:done]
            state = self._read(piece[start:start + SETTLE], state, closing)
        yield self._walk_back(closing, len(closing))

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        if len(piece) > SETTLE:
            return [i for run in self.emit(piece) for i in run]
        closing: list[int] = []
        self._read(piece, 0, closing)
        return self._walk_back(closing, len(closing))


class _Pieces(dict):
    """Ids of a piece as packed 32-bit integers, filled by the transducer. Two
    generations: when the young one is full it becomes the old one, and what
    is asked for again moves over; pieces not asked for meanwhile are gone."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MAX_PIECES:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.transducer.encode_piece(piece.encode())).tobytes()
            if len(piece) > MAX_KEPT:
                return ids
        self[piece] = ids
        return ids


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """Cuts of a text that no match of the split pattern crosses: each ends
    before white space (as the pattern's ``\\s`` has it) that follows
    something else."""
    if len(text) <= size:
        yield text
        return
    import regex
    word_end = regex.compile(r"\S\s")
    start, n = 0, len(text)
    while n - start > size:
        end = word_end.search(text, start + size - 1)
        if end is None:
            break
        yield text[start:end.start() + 1]
        start = end.start() + 1
    yield text[start:]


class Encoder:
    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        self.find = regex.compile(pattern).findall
        self.pieces = _Pieces(Transducer(tokens))

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """Ids window by window."""
        get = self.pieces.__getitem__
        for part in windows(text):
            yield np.frombuffer(b"".join(map(get, self.find(part))), np.int32)

    def encode(self, text: str) -> np.ndarray:
        parts = list(self.ids(text))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


# UTF-8 state machine. States: 0 between characters; 1-3 that many plain
# continuation bytes missing; 4-7 after E0, ED, F0, F4, whose next byte has a
# narrower range; 8 invalid.
def _utf8_table() -> np.ndarray:
    t = np.full((9, 256), 8, np.uint8)
    t[0, 0x00:0x80] = 0
    t[0, 0xC2:0xE0] = 1
    t[0, 0xE1:0xF0] = 2
    t[0, 0xF1:0xF4] = 3
    t[0, 0xE0], t[0, 0xED], t[0, 0xF0], t[0, 0xF4] = 4, 5, 6, 7
    t[1, 0x80:0xC0] = 0
    t[2, 0x80:0xC0] = 1
    t[3, 0x80:0xC0] = 2
    t[4, 0xA0:0xC0] = 1
    t[5, 0x80:0xA0] = 1
    t[6, 0x90:0xC0] = 2
    t[7, 0x80:0x90] = 2
    return t


class Decoder:
    """Token ids to bytes, handed on at character ends.

    The machine's moves are composed per token on first use; runs of tokens
    that are whole characters by themselves keep it in state 0."""

    TABLE = _utf8_table()

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.moves: list[dict[int, int]] = [{} for _ in range(9)]
        self.whole = np.array([self._run(0, t) == 0 for t in tokens])

    def _run(self, state: int, raw: bytes) -> int:
        for b in raw:
            state = int(self.TABLE[state, b])
        return state

    def _move(self, state: int, token: int) -> int:
        got = self.moves[state].get(token)
        if got is None:
            got = self.moves[state][token] = self._run(state, self.tokens[token])
        return got

    def stream(self, runs) -> Iterator[bytes]:
        """``runs``: arrays of ids. Yields bytes that end at a character end
        (the last may not); bytes that are no UTF-8 pass unchanged."""
        held, state = b"", 0
        for ids in runs:
            ids = np.asarray(ids, np.int64)
            raw = b"".join(map(self.tokens.__getitem__, ids.tolist()))
            at, n = 0, len(ids)
            odd = np.flatnonzero(~self.whole[ids]) if n else ids
            k = 0
            while at < n:
                if state == 0:
                    k = int(np.searchsorted(odd, at))
                    if k == len(odd):
                        break
                    at = int(odd[k])
                state = self._move(state, int(ids[at]))
                if state == 8:
                    state = 0
                at += 1
            raw = held + raw
            keep = 0
            if state:  # hold back the unfinished character
                keep = 1
                while keep < 4 and raw[-keep] & 0xC0 == 0x80:
                    keep += 1
            held = raw[len(raw) - keep:]
            if len(raw) > keep:
                yield raw[:len(raw) - keep]
        if held:
            yield held


def _resident(held: dict, what: str, make):
    """``make()`` once per Python worker: kept in the worker's broadcast copy."""
    if what not in held:
        held[what] = make()
    return held[what]


def _encoded(batches, held: dict, pattern: str, out: str) -> Iterator[pa.RecordBatch]:
    """Batches with ``out`` (ids) at the end in place of the first column (text)."""
    enc = _resident(held, "encoder " + pattern, lambda: Encoder(held["tokens"], pattern))
    for batch in batches:
        start, size, rows = 0, 0, []
        for i, t in enumerate(batch.column(0)):
            ids = enc.encode(t.as_py() or "")
            rows.append(ids)
            size += 4 * len(ids) + 32
            if size >= 1 << 22 or i + 1 == batch.num_rows:
                ends = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))
                rest = [c.slice(start, len(rows)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(rest + [lists],
                                                 names=batch.schema.names[1:] + [out])
                start, size, rows = i + 1, 0, []


def _decoded(batches, held: dict, at: int, out: str) -> Iterator[pa.RecordBatch]:
    """Batches with ``out`` (bytes of the ids in column ``at``) added at the end."""
    dec = _resident(held, "decoder", lambda: Decoder(held["tokens"]))
    for batch in batches:
        start, size, rows = 0, 0, []
        col = batch.column(at)
        for i in range(batch.num_rows):
            one = col[i].values
            runs = [] if one is None else [one.slice(k, WINDOW).to_numpy(zero_copy_only=False)
                                           for k in range(0, len(one), WINDOW)]
            rows.append(b"".join(dec.stream(runs)))
            size += len(rows[-1]) + 32
            if size >= 1 << 22 or i + 1 == batch.num_rows:
                rest = [c.slice(start, len(rows)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(rest + [pa.array(rows, pa.binary())],
                                                 names=batch.schema.names + [out])
                start, size, rows = i + 1, 0, []


def _vocabulary(spark: SparkSession, vocabulary: str | None):
    """Broadcast of one rank file; workers keep their machines in their copy."""
    return spark.sparkContext.broadcast({"tokens": read_ranks(vocabulary or default_vocabulary()[0])})


def _ddl(fields, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + list(more))


def _text_first(docs: DataFrame, text: str) -> tuple[DataFrame, list]:
    keep = [f for f in docs.schema.fields if f.name != text]
    return docs.select(F.col(text), *[F.col(f"`{f.name}`") for f in keep]), keep


def encode(spark: SparkSession, docs: DataFrame, text: str = "text", vocabulary: str | None = None,
           pattern: str | None = None, out: str = "ids") -> DataFrame:
    """The documents with ``out`` (array of int) in place of ``text``."""
    tokens, pattern = _vocabulary(spark, vocabulary), pattern or default_vocabulary()[1]
    src, keep = _text_first(docs, text)
    return arrow_map(src, lambda batches: _encoded(batches, tokens.value, pattern, out),
                     _ddl(keep, f"`{out}` array<int>"))


def decode(spark: SparkSession, coded: DataFrame, ids: str = "ids", vocabulary: str | None = None,
           out: str = "decoded") -> DataFrame:
    """Adds ``out`` (binary), the bytes of ``ids``; null ids decode to nothing."""
    tokens, at = _vocabulary(spark, vocabulary), coded.columns.index(ids)
    return arrow_map(coded, lambda batches: _decoded(batches, tokens.value, at, out),
                     _ddl(coded.schema.fields, f"`{out}` binary"))


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """Per document: doc_id, ids, decoded. Ids are decoded in the task that
    made them, batch by batch, so one Python worker a core does both."""
    tokens, pattern = _vocabulary(spark, vocabulary), pattern or default_vocabulary()[1]
    src, keep = _text_first(docs.select("doc_id", "text"), "text")

    def run(batches):
        held = tokens.value
        return _decoded(_encoded(batches, held, pattern, "ids"), held, 1, "decoded")

    return arrow_map(src, run, _ddl(keep, "ids array<int>", "decoded binary"))


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a round trip."""
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
