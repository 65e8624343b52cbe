"""Chat formatting with offset-aligned loss masks (operator 7).

A conversation's turns, in order, become one string:

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>

Control strings inside roles and texts are escaped reversibly: in ``<``,
backslashes, ``|`` one more backslash is put after the ``<``, so the escaped
text holds no ``<|`` and taking the backslash out restores it.

The whole rendering is encoded once, with byte offsets; the three marks are
single ids, so no token crosses a mark. The turn spans noted while rendering
(sorted) are met with the token spans by binary search: a token carries loss
when it lies inside the text of an assistant turn.

Turns are range-sorted by conversation and place, so a long conversation is
dealt over many tasks; each task renders, encodes and masks its turns in order
and lets them go as segments that end at a turn, of about ``SEGMENT``
characters. Segments are numbered in order across tasks. Reading back unescapes
and decodes every segment by itself, wherever it stands; only the bytes of
conversations in several segments (or on the edge of a task) are put in order,
for the two running digests that have to take them one after the other.

Null texts and roles are empty; turns are ordered by turn (nulls first), then
role, then text, so ties and repeated rows have one result; rows with null
conv_id are one conversation with null id.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.bpe import Decoder, Encoder, _resident, default_vocabulary, read_ranks
from bazaarlens.llm.common import Rows, arrow_map

# The marks of the template.
START, SEP, END = MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
LOSS_ROLE = "assistant"
SEGMENT = 1 << 18

_MARK = re.compile("(" + "|".join(map(re.escape, MARKS)) + ")")
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.S)

_SEGMENT_DDL = ("conv_id bigint, segment bigint, whole boolean, formatted string, "
                "ids array<int>, starts array<int>, loss array<boolean>")
_PART_DDL = ("conv_id bigint, segment bigint, whole boolean, turns binary, loss binary, "
             "n_turns bigint, loss_chars bigint, formatted_chars bigint, n_tokens bigint")
EDGE = 64  # characters of roles and texts by which equal turns are dealt to ranges


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(string, sorted byte spans of the texts that carry loss)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        start = at + len(head.encode())
        end = start + len(body.encode())
        if role == LOSS_ROLE:
            spans.append((start, end))
        parts += [head, body, END]
        at = end + len(END)
    return "".join(parts), spans


def encode_with_offsets(text: str, encoder: Encoder, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, byte offset of each token's start plus the end of the last)."""
    first_mark = len(sizes) - len(MARKS)
    number = {m: first_mark + k for k, m in enumerate(MARKS)}
    runs = [np.array([number[part]], np.int32) if part in number else encoder.encode(part)
            for part in _MARK.split(text) if part]
    ids = np.concatenate(runs) if runs else np.zeros(0, np.int32)
    return ids, np.concatenate([[0], np.cumsum(sizes[ids])])


def loss_mask(starts: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for tokens that lie inside a span; one binary search per token."""
    if not spans:
        return np.zeros(len(starts) - 1, bool)
    left, right = np.array(spans).T
    at = np.searchsorted(left, starts[:-1], "right") - 1
    return (at >= 0) & (starts[1:] <= right[np.maximum(at, 0)])


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """Turns in order, over ranges of (conversation, place); the range bounds
    hold the first ``EDGE`` characters of role and text, in the same order."""
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
                        F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    start = F.when(F.length("role") < EDGE, F.substring("text", 1, EDGE)).otherwise("")
    return (rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, EDGE), start)
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text", F.spark_partition_id().alias("part")))


def format_conversations(spark: SparkSession, turns: DataFrame, vocabulary: str | None = None,
                         pattern: str | None = None) -> DataFrame:
    """Segments (conv_id, segment, whole, formatted, ids, starts, loss) of all
    conversations. ``segment`` ascends within a conversation; ``whole`` marks
    segments that are known to be a conversation by themselves."""
    path, default = default_vocabulary()
    pattern = pattern or default
    tokens = spark.sparkContext.broadcast({"tokens": read_ranks(vocabulary or path)})
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("whole", pa.bool_()),
                        ("formatted", pa.string()), ("ids", pa.list_(pa.int32())),
                        ("starts", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))])

    def run(batches):
        held = tokens.value
        enc = _resident(held, "encoder " + pattern, lambda: Encoder(held["tokens"], pattern))
        sizes = np.array([len(t) for t in held["tokens"]] + [len(m) for m in MARKS])
        rows = Rows(schema)
        conv, began, turns_, chars, left = None, False, [], 0, 0
        edge = True      # in the task's first conversation, which may have begun elsewhere
        cut = False      # this conversation has left a segment already

        def leave(whole):
            text, spans = render(turns_)
            ids, starts = encode_with_offsets(text, enc, sizes)
            return rows.add(len(text) + 9 * len(ids), conv, part << 40 | left, whole, text, ids,
                            starts[:-1], loss_mask(starts, spans))

        for batch in batches:
            for c, role, text, part in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if began and (c != conv or chars > SEGMENT):
                    if leave(c != conv and not edge and not cut):
                        yield rows.take()
                    edge, cut = edge and c == conv, c == conv
                    turns_, chars, left = [], 0, left + 1
                conv, began = c, True
                turns_.append((role, text))
                chars += len(role) + len(text)
        if began:
            leave(False)
        yield from rows.rest()

    return arrow_map(_sorted_turns(turns), run, _SEGMENT_DDL)


def _read_segments(spark: SparkSession, segments: DataFrame, vocabulary: str | None) -> DataFrame:
    """Per segment: counts, and the bytes that its turns and its loss text give
    to the digests of its conversation (of a whole one: the digests)."""
    path, _ = default_vocabulary()
    tokens = spark.sparkContext.broadcast({"tokens": read_ranks(vocabulary or path)})
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("whole", pa.bool_()),
                        ("turns", pa.binary()), ("loss", pa.binary()), ("n_turns", pa.int64()),
                        ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()),
                        ("n_tokens", pa.int64())])

    def run(batches):
        vocab = tokens.value["tokens"] + [m.encode() for m in MARKS]
        dec = Decoder(vocab)
        rows = Rows(schema)
        for batch in batches:
            for c, segment, whole, text, ids, loss in zip(*batch.columns):
                text, whole = text.as_py(), whole.as_py()
                turns = [f"{unescape(role)}\n{unescape(body)}\n" for role, body in _TURN.findall(text)]
                ids = ids.values.to_numpy(zero_copy_only=False)
                mask = loss.values.to_numpy(zero_copy_only=False)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                said = [unescape(b"".join(dec.stream([ids[a:b]])).decode())
                        for a, b in zip(edges[::2], edges[1::2])]
                made = "".join(turns).encode(), "".join(said).encode()
                if whole:
                    made = [hashlib.sha256(m).digest() for m in made]
                if rows.add(len(made[0]) + len(made[1]) + 48, c.as_py(), segment.as_py(), whole, *made,
                            len(turns), sum(map(len, said)), len(text), len(ids)):
                    yield rows.take()
        yield from rows.rest()

    return arrow_map(segments.select("conv_id", "segment", "whole", "formatted", "ids", "loss"), run,
                     _PART_DDL)


def read_back(spark: SparkSession, segments: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of formatted conversations, from their strings, ids and masks
    alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_tokens. Segments may come in any order."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("n_tokens", pa.int64())])

    def run(batches):
        rows = Rows(schema)
        conv, began, counts = None, False, [0] * 4
        turns_hash = loss_hash = None

        def add(c, turns, loss, n):
            return rows.add(200, c, n[0], turns, n[1], loss, n[2], n[3])

        for batch in batches:
            cols = [batch.column(k) for k in (0, 2, 3, 4)]
            numbers = zip(*[batch.column(k).to_pylist() for k in (5, 6, 7, 8)])
            for (c, whole, turns, loss), n in zip(zip(*cols), numbers):
                c, turns, loss = c.as_py(), turns.as_py(), loss.as_py()
                if whole.as_py():
                    if add(c, turns.hex(), loss.hex(), n):
                        yield rows.take()
                    continue
                if not began or c != conv:
                    if began and add(conv, turns_hash.hexdigest(), loss_hash.hexdigest(), counts):
                        yield rows.take()
                    conv, began, counts = c, True, [0] * 4
                    turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
                turns_hash.update(turns)
                loss_hash.update(loss)
                counts = [a + b for a, b in zip(counts, n)]
        if began:
            add(conv, turns_hash.hexdigest(), loss_hash.hexdigest(), counts)
        yield from rows.rest()

    parts = (_read_segments(spark, segments, vocabulary)
             .repartition("conv_id").sortWithinPartitions("conv_id", "segment"))
    return arrow_map(parts, run, "conv_id bigint, n_turns bigint, turns_sha256 string, "
                                 "loss_chars bigint, loss_sha256 string, "
                                 "formatted_chars bigint, n_tokens bigint")
