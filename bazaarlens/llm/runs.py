"""Periodic runs in word sequences (operator 13).

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends. All runs of at least ``exponent`` periods
and ``least`` words are found by the runs theorem: for one of the two orders of
the words, the longest Lyndon word that starts at a run's root is that root.

1. ``lyndon_array`` is phase one of Baier's grouping suffix sorter. Suffixes
   start grouped by first word; groups are taken from the highest down, and
   each suffix of a group lengthens the context of the nearest suffix before it
   that stands in a lower group. When a group is taken, its context is the
   longest Lyndon word at each of its suffixes. It runs under the order of word
   numbers and under the reversed order.
2. Where the same length stands at three places a root apart, the root is
   extended to both sides through longest common extensions, by direct
   comparison of words in doubling blocks.

Only stretches whose 5-grams all occur twice in the text are sorted. That
loses nothing: a k-gram of a run stands in it twice, q apart, if the run has at
least 2q + k - 1 words, and runs of q = 1 have 6 words, those of q >= 2 have 4q;
the stretch around a run holds every word that could extend it. (Settings of
``exponent`` and ``least`` that allow shorter runs shorten the gram likewise.)

Every document is a row of its own; no shuffle. Memory is in proportion to the
longest text. Null and empty texts have no words, hence no runs and an empty
collapsed text; a null id is kept; repeated rows each get their result; an empty
table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import Rows, arrow_map

EXPONENT = 4   # least number of periods of a run
LEAST = 6      # least number of words of a run


def lyndon_array(ranks: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at each position (a proper prefix is
    smaller than the longer word)."""
    n = len(ranks)
    # positions 1..n in a linked list of those not yet taken; 0 and n+1 are its ends
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    found = np.zeros(n + 1, np.int64)
    members: list[list[int]] = []
    size: list[int] = []                  # words of a group's context
    group = [0] * (n + 1)
    by_rank: dict[int, int] = {}
    for i, r in enumerate(ranks, 1):
        g = by_rank.get(r)
        if g is None:
            g = by_rank[r] = len(members)
            members.append([])
            size.append(1)
        members[g].append(i)
        group[i] = g
    ascending = [by_rank[r] for r in sorted(by_rank)]
    below = [-1] * len(members)
    above = [-1] * len(members)
    for lo, hi in zip(ascending, ascending[1:]):
        below[hi], above[lo] = lo, hi
    now = ascending[-1] if ascending else -1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        members[now] = []
        length = size[now]
        # context repeats that each earlier suffix in a lower group gains
        gains: dict[int, list[int]] = {}
        last, repeats = 0, 0
        for i in own:
            found[i] = length
            p, r = left[i], right[i]
            right[p] = r
            left[r] = p
            if p == last:
                repeats += 1
            else:
                if last:
                    gains.setdefault(repeats, []).append(last)
                last, repeats = p, 1
        if last:
            gains.setdefault(repeats, []).append(last)
        for repeats in sorted(gains, reverse=True):
            split: dict[int, int] = {}
            for p in gains[repeats]:
                old = group[p]
                new = split.get(old)
                if new is None:
                    new = split[old] = len(members)
                    members.append([])
                    size.append(size[old] + repeats * length)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    below[up] = new       # a group above always exists: the one being taken
                    above[old] = new
                members[new].append(p)
                group[p] = new
        now = below[now]
    return found[1:]


def extension(w: np.ndarray, a: int, b: int) -> int:
    """Longest common extension to the right of positions a < b."""
    n, done, step = len(w), 0, 32
    while b + done < n:
        m = min(step, n - b - done)
        differ = w[a + done:a + done + m] != w[b + done:b + done + m]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done += m
        step *= 2
    return done


def _stretches(w: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Maximal stretches [a, b) all of whose grams occur twice or more."""
    m = len(w) - gram + 1
    if m < 2:
        return []
    h = np.zeros(m, np.uint64)
    for k in range(gram):                 # equal grams always share a number
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k:m + k].astype(np.uint64)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(m + 2, np.int8)
    twice[order[1:][same] + 1] = 1
    twice[order[:-1][same] + 1] = 1
    edge = np.flatnonzero(np.diff(twice))
    return [(int(a), int(b) + gram - 1) for a, b in zip(edge[::2], edge[1::2])]


def _runs_of(w: np.ndarray, exponent: int, least: int) -> set[tuple[int, int, int]]:
    """Runs of one stretch, positions from its start."""
    n, out = len(w), set()
    back = w[::-1]
    for ranks in (w, -w):
        lam = lyndon_array(ranks.tolist())
        i = np.flatnonzero(np.arange(n) + (exponent - 1) * lam <= n)
        for k in range(1, exponent - 1):
            at = i + k * lam[i]
            i = i[(w[i] == w[at]) & (lam[i] == lam[at])]
        ends: dict[int, int] = {}         # by period: end of the last run found
        for a, q in zip(i.tolist(), lam[i].tolist()):
            if a + q <= ends.get(q, 0):
                continue
            start = a - extension(back, n - a - q, n - a)
            end = a + q + extension(w, a, a + q)
            if end - start >= max(least, exponent * q):
                out.add((start, end - start, q))
                ends[q] = end
    return out


def find_runs(words: list, exponent: int = EXPONENT,
              least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    n = len(words)
    ids: dict = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    # a gram of k words stands twice in every run, q apart: k <= length - 2 q + 1
    gram = min(5, *(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 3)))
    out = []
    for a, b in _stretches(w, gram):
        out += [(a + start, length, q)
                for start, length, q in _runs_of(w[a:b], exponent, least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        cover[start + q] += 1
        cover[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  exponent: int = EXPONENT, least: int = LEAST,
                  edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs (array of start, length, period by
    start, then period) and collapsed (kept words joined by one blank).

    ``edit(id, words)`` may rewrite a document's words before the search."""
    kind = docs.schema[doc_id].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches):
        rows = None
        for batch in batches:
            if rows is None:
                rows = Rows(pa.schema([("doc_id", batch.schema.field(0).type),
                                       ("n_words", pa.int64()), ("runs", pa.list_(run)),
                                       ("collapsed", pa.string())]))
            raw = batch.column(1).cast(pa.binary())
            for key, t in zip(batch.column(0).to_pylist(), raw):
                words = (t.as_py() or b"").split()
                if edit:
                    words = edit(key, words)
                runs = find_runs(words, exponent, least)
                kept = b" ".join(collapse(words, runs)).decode()
                if rows.add(len(kept) + 24 * len(runs), key, len(words),
                            [dict(zip(("start", "length", "period"), r)) for r in runs], kept):
                    yield rows.take()
        if rows is not None:
            yield from rows.rest()

    return arrow_map(docs.select(F.col(doc_id), F.col(text)), work,
                     f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,"
                     "length:bigint,period:bigint>>, collapsed string")
