"""Phrase collocation mining by best-first branch-and-bound growth (operator 12).

Phrases are contiguous words of a piece (text between ``.,;:!?`` and line
breaks), counted with overlaps, per language. A candidate has 2 to ``MAX_WORDS``
words and a count a of at least ``min_count``; its score is the least over its
cuts of floor(``SCALE`` * a / (l + r)), l and r the counts of both parts. The
first ``top`` candidates of a language that no longer candidate of nearly the
same count covers are returned.

Growth. Counts of sub-phrases are never below the phrase's own, so for a prefix p
with first word w every phrase that starts with p scores at most
floor(SCALE * f(p) / (f(w) + f(p))), and the like holds for suffixes. Prefixes
are expanded best bound first, in batches: a batch opens all prefixes and
suffixes whose bound reaches a floor score per language. A phrase of three words
is counted if its first or last pair is open; one of four if both its triples are
open, or if one of them scores the floor or more (its survival must be known).
So every candidate at or above the floor, all parts of its score and all longer
candidates that could cover it are counted exactly. A language is settled when
``top`` survivors reach the floor (ties included, as the floor itself is
included) or when the floor is 0 and everything is open; else its floor goes
down to the pair at twice the rank, and it is counted again.

Counting. Tasks number the words of about five million bytes at a time, count
n-grams with NumPy and hand on (lang, phrase, count); Spark adds up, so a hot
word, pair or language is one row a chunk. Which words are frequent and which
pairs and triples are open reaches the tasks as flags in a table of
``2**TABLE_BITS`` bytes indexed by phrase hash, of the same size for any
corpus: two phrases in one cell cost a needless count, never a result (counts
below ``min_count`` are dropped and scores use exact strings). All state between
rounds is in tables below ``spark.checkpoint.dir``.

Null and empty texts have no words, a null language is ``und``, repeated rows
count each, an empty table gives an empty table; other columns are not read.
Memory of a task: a chunk of texts, at least the longest text.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import arrow_map, drop_stored, store

MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
COVER = 80              # percent of a phrase's count that a longer candidate needs to cover it
MAX_WORDS = 4
TABLE_BITS = 24
MAX_LANGS = 10_000      # a list of languages up to here is broadcast
CHUNK = 5 << 20         # bytes of text numbered and counted at a time

# A-Z to lower case, tabs to blanks, and separators of pieces to line feeds.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r",
                         b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_BREAK = b"\n"

WORD, OPEN_PREFIX, OPEN_SUFFIX, PAIR, SETTLE = 1, 2, 4, 8, 16   # flags of the table

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _word_hash(lang: bytes, word: bytes) -> int:
    return int.from_bytes(blake2b(lang + b"\0" + word, digest_size=8).digest(), "little")


def _joined(h: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a phrase one word longer."""
    x = (h ^ (h >> np.uint64(29))) * _A + following
    return (x ^ (x >> np.uint64(32))) * _B


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _phrase_hash(lang: bytes, phrase: bytes) -> int:
    """The same hash of one phrase in plain integers."""
    wrap, h = (1 << 64) - 1, None
    for x in phrase.split(b" "):
        x = _word_hash(lang, x)
        if h is None:
            h = x
        else:
            h = (((h ^ h >> 29) * int(_A)) + x) & wrap
            h = ((h ^ h >> 32) * int(_B)) & wrap
    return h


class _Chunk:
    """Texts of one language; their tokens are numbered by Arrow and NumPy, with
    no Python object per token. Number 0 is a break."""

    def __init__(self, lang: bytes):
        self.lang, self.texts = lang, []

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """Numbers of all tokens, in order, and the token of each number."""
        # a break before the first text and after each
        text = np.frombuffer(_BREAK.join([b"", *self.texts, b""]).translate(_LOWER), np.uint8)
        blank, edge = text == 32, text == _BREAK[0]
        first = edge.copy()              # bytes that begin a token if they are no blanks
        first[1:] |= blank[:-1] | edge[:-1]
        kept = ~blank
        offsets = np.append(np.flatnonzero(first[kept]), np.count_nonzero(kept))
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1,
            [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text[kept])])
        found = found.dictionary_encode()
        return found.indices.to_numpy().astype(np.int64), found.dictionary

    def counts(self, n: int, flags: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
        """The phrases of n words that the flags ask for, and their counts."""
        w, names = self.numbered()
        base = len(names)
        written = names[1:].cast(pa.string())   # number 1 first
        if n == 1:
            return written, np.bincount(w, minlength=base)[1:]
        word = np.array([0] + [_word_hash(self.lang, x) for x in names[1:].to_pylist()],
                        np.uint64)
        usable = (flags[_cell(word)] & WORD) > 0
        usable[0] = False
        m = len(w) - n + 1
        if m < 1:
            return written[:0], w[:0]
        good = usable[w]
        at = good[:m].copy()
        for k in range(1, n):
            at &= good[k:m + k]
        at = np.flatnonzero(at)
        hashes = [word[w[at + k]] for k in range(n)]

        def flagged(first: int, last: int) -> np.ndarray:
            h = hashes[first]
            for k in range(first + 1, last):
                h = _joined(h, hashes[k])
            return flags[_cell(h)]

        if n > 2:
            head, tail = flagged(0, n - 1), flagged(1, n)
            if n == 3:
                ask = ((head & PAIR > 0) & (tail & PAIR > 0)
                       & ((head & OPEN_PREFIX > 0) | (tail & OPEN_SUFFIX > 0)))
            else:
                ask = (((head & OPEN_PREFIX > 0) & (tail & OPEN_SUFFIX > 0))
                       | (head & SETTLE > 0) | (tail & SETTLE > 0))
            at = at[ask]
        # number the n-grams by joining one word at a time; numbers stay below 2^63
        g = w[at]
        for k in range(1, n):
            known, g = np.unique(g, return_inverse=True)
            g = g * np.int64(base) + w[at + k]
        _, first, count = np.unique(g, return_index=True, return_counts=True)
        at = at[first]
        return pc.binary_join_element_wise(*[written.take(pa.array(w[at + k] - 1))
                                             for k in range(n)], " "), count


def _count(docs: DataFrame, n: int, flags: np.ndarray | None) -> DataFrame:
    """lang, phrase, n_words, f over all documents (lang, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(flags)   # 2**TABLE_BITS bytes at most

    def run(batches):
        chunks: dict[bytes, _Chunk] = {}
        size = 0

        def flush():
            for lang, chunk in chunks.items():
                found, count = chunk.counts(n, shared.value)
                for k in range(0, len(found), 100_000):
                    part = found[k:k + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang.decode(), pa.string()), len(part)), part,
                         pa.array(count[k:k + 100_000], pa.int64())],
                        names=["lang", "phrase", "f"])

        for batch in batches:
            langs, texts = (c.cast(pa.binary()) for c in batch.columns)
            for lang, text in zip(langs.to_pylist(), texts):
                if not text.is_valid:
                    continue
                if lang not in chunks:
                    chunks[lang] = _Chunk(lang)
                chunks[lang].texts.append(text.as_py())
                size += len(chunks[lang].texts[-1])
                if size >= CHUNK:
                    yield from flush()
                    chunks.clear()
                    size = 0
        yield from flush()

    parts = arrow_map(docs, run, "lang string, phrase string, f bigint")
    return (parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
            .select("lang", "phrase", F.lit(n).alias("n_words"), "f"))


def _flag_table(spark: SparkSession, asked: list[tuple[DataFrame, Column]]) -> np.ndarray:
    """One byte per cell: the flags of all phrases (lang, phrase) asked for.
    At most one row a cell reaches the driver."""
    def cells(batches):
        for batch in batches:
            langs, phrases = (c.cast(pa.binary()).to_pylist() for c in batch.columns[:2])
            h = np.array([_phrase_hash(*x) for x in zip(langs, phrases)], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_cell(h).astype(np.int32)),
                                              batch.column(2)], names=["cell", "flag"])

    table = np.zeros(1 << TABLE_BITS, np.uint8)
    rows = None
    for df, flag in asked:
        part = df.select("lang", "phrase", flag.cast("tinyint").alias("flag"))
        rows = part if rows is None else rows.unionByName(part)
    found = (arrow_map(rows.filter("flag <> 0"), cells, "cell int, flag tinyint")
             .groupBy("cell").agg(F.bit_or("flag").alias("flag"))).toArrow()
    if found.num_rows:
        table[found.column("cell").to_numpy()] = found.column("flag").to_numpy().astype(np.uint8)
    return table


def ratio(count: Column, below: Column) -> Column:
    """floor(SCALE * count / below), exact beyond 64 bits."""
    wide = count.cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, below.cast("decimal(27,0)")).cast("bigint")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, phrase, n_words, a, l, r, score: the lowest-scoring cut, ties to the
    shortest first part. A candidate with a part that ``counts`` (lang, phrase, f)
    lacks is left out."""
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "n_words", F.col("f").alias("a"), cut).select(
        "*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first_part"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("n_words")), " ").alias("last_part"))
    part = counts.select("lang", "phrase", "f")
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("first_part"),
                                  F.col("f").alias("l")), ["lang", "first_part"])
            .join(part.select("lang", F.col("phrase").alias("last_part"),
                              F.col("f").alias("r")), ["lang", "last_part"]))
    best = F.min(F.struct(ratio(F.col("a"), F.col("l") + F.col("r")).alias("score"),
                          "k", "l", "r"))
    return (cuts.groupBy("lang", "phrase", "n_words", "a")
            .agg(best.alias("best"), F.count(F.lit(1)).alias("cuts"))
            .filter(F.col("cuts") == F.col("n_words") - 1)
            .select("lang", "phrase", "n_words", "a", "best.l", "best.r", "best.score"))


def _bounded(counted: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the bounds of all phrases that start (prefix_bound) or end
    (suffix_bound) with each phrase."""
    word = words.select("lang", "phrase", "f")
    first, last = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    return (counted.withColumn("w", first)
            .join(word.select("lang", F.col("phrase").alias("w"), F.col("f").alias("fw")),
                  ["lang", "w"])
            .withColumn("prefix_bound", ratio(F.col("f"), F.col("fw") + F.col("f")))
            .drop("w", "fw").withColumn("w", last)
            .join(word.select("lang", F.col("phrase").alias("w"), F.col("f").alias("fw")),
                  ["lang", "w"])
            .withColumn("suffix_bound", ratio(F.col("f"), F.col("fw") + F.col("f")))
            .drop("w", "fw"))


def _covered(longer: DataFrame) -> DataFrame:
    """(lang, phrase, cover): for each phrase one word shorter, the greatest
    count of a longer candidate that holds it. A longer one still counts no more
    than the one between, so one word more is enough to look at."""
    words = F.split("phrase", " ")
    shorter = F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("n_words") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("n_words") - 1), " "))).alias("short")
    return (longer.select("lang", "f", "n_words", "phrase").select("lang", "f", shorter)
            .groupBy("lang", F.col("short").alias("phrase")).agg(F.max("f").alias("cover")))


def _floors(pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    """(lang, floor, rank): the score of the language's pair at ``rank``; 0 if
    it has no so many pairs. Pairs are counted by score first, so a language
    comes to its window as at most ``SCALE`` / 2 + 1 rows."""
    down = Window.partitionBy("lang").orderBy(F.col("score").desc())
    at = (pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
          .withColumn("so_far", F.sum("n").over(down))
          .join(ranks.select("lang", "rank"), "lang").filter(F.col("so_far") >= F.col("rank"))
          .groupBy("lang").agg(F.max("score").alias("floor")))
    return (ranks.select("lang", "rank").join(at, "lang", "left")
            .select("lang", F.coalesce("floor", F.lit(0)).cast("bigint").alias("floor"), "rank"))


def phrases(spark: SparkSession, docs: DataFrame, lang: str = "lang", text: str = "text",
            min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each
    language by score and a descending, then phrase by bytes."""
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).alias("text"))
    frequent = F.col("f") >= min_count
    words = store(_count(docs, 1, None), "phrases-words")
    totals = store(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-totals")
    often = store(words.filter(frequent), "phrases-often")
    drop_stored(spark, words)
    is_word = (often, F.lit(WORD))
    pairs = store(_count(docs, 2, _flag_table(spark, [is_word])).filter(frequent), "phrases-2")
    pair_scores = store(_bounded(pairs, often).join(
        _scored(pairs, often).select("lang", "phrase", "a", "l", "r", "score"),
        ["lang", "phrase"]), "phrases-pairs")
    drop_stored(spark, pairs)

    ranks = totals.select("lang", F.lit(2 * top).cast("bigint").alias("rank"))
    settled = None
    while True:
        floors = store(_floors(pair_scores, ranks), "phrases-floors")
        settled_now, open_langs = _round(spark, docs, often, pair_scores, floors, frequent, top,
                                         is_word)
        settled = settled_now if settled is None else store(
            settled.unionByName(settled_now), "phrases-settled")
        if open_langs.limit(1).count() == 0:
            break
        ranks = store(open_langs.select("lang", (F.col("rank") * 2).alias("rank")),
                      "phrases-ranks")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (settled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(totals, "lang")
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                    "n", "score"))


def _round(spark: SparkSession, docs: DataFrame, often: DataFrame, pair_scores: DataFrame,
           floors: DataFrame, frequent: Column, top: int,
           is_word: tuple[DataFrame, Column]) -> tuple[DataFrame, DataFrame]:
    """One batch of the search at the languages' floors: the survivors of the
    languages that it settles, and (lang, rank) of those it leaves open."""
    reaches = lambda bound, flag: F.when(F.col(bound) >= F.col("floor"), flag).otherwise(0)
    texts = docs
    if floors.count() <= MAX_LANGS:   # texts of settled languages need no second count
        texts = docs.join(F.broadcast(floors.select("lang")), "lang", "left_semi")
    texts = texts.select("lang", "text")
    pairs = pair_scores.join(floors.select("lang", "floor"), "lang")
    opened = (F.lit(PAIR).bitwiseOR(reaches("prefix_bound", OPEN_PREFIX))
              .bitwiseOR(reaches("suffix_bound", OPEN_SUFFIX)))
    triples = store(_count(texts, 3, _flag_table(spark, [is_word, (pairs, opened)]))
                    .filter(frequent), "phrases-3")
    parts = often.select("lang", "phrase", "f").unionByName(
        pair_scores.select("lang", "phrase", "f"))
    # both parts of every triple are counted: its pairs passed, its words are frequent
    triple_scores = store(
        _bounded(triples, often).join(
            _scored(triples, parts).select("lang", "phrase", "a", "l", "r", "score"),
            ["lang", "phrase"]).join(floors.select("lang", "floor"), "lang"), "phrases-triples")
    opened = (reaches("prefix_bound", OPEN_PREFIX).bitwiseOR(reaches("suffix_bound", OPEN_SUFFIX))
              .bitwiseOR(reaches("score", SETTLE)))
    fours = store(_count(texts, 4, _flag_table(spark, [is_word, (triple_scores, opened)]))
                  .filter(frequent), "phrases-4")
    # a four counted only to settle a triple may lack a part: it scores below the floor
    four_scores = _scored(fours, parts.unionByName(triples.select("lang", "phrase", "f")))

    columns = ["lang", "phrase", "a", "l", "r", "score"]
    cover = _covered(triples).unionByName(_covered(fours))
    found = (pairs.select(*columns).unionByName(triple_scores.select(*columns))
             .join(cover, ["lang", "phrase"], "left")
             .filter(F.col("cover").isNull() | (100 * F.col("cover") < COVER * F.col("a")))
             .select(*columns).unionByName(four_scores.select(*columns))
             .join(floors, "lang").filter(F.col("score") >= F.col("floor")))
    survivors = store(found, "phrases-survivors")
    enough = store(floors.join(survivors.groupBy("lang").agg(F.count(F.lit(1)).alias("found")),
                               "lang", "left")
                   .select("lang", "rank", ((F.coalesce("found", F.lit(0)) >= top)
                                            | (F.col("floor") == 0)).alias("done")),
                   "phrases-done")
    settled = survivors.join(enough.filter("done").select("lang"), "lang", "left_semi") \
        .select(*columns)
    for used in (triples, triple_scores, fours):
        drop_stored(spark, used)
    return settled, enough.filter(~F.col("done"))
