"""Near-duplicate documents by SuperMinHash (operator 9).

Each whole text becomes the set of its distinct 2-word shingles (64-bit
digests). SuperMinHash signs the set: one permutation of the signature's
positions per element, correlated over positions, stopped as soon as no
position can still fall. Bands of the signature are buckets; documents of a
bucket are compared exactly on their full sets, links are joined by
union-find in tasks and by star contraction across them.

``BANDS`` x ``ROWS`` = 30 x 5: a pair at similarity 0.8 shares no bucket with
probability (1 - 0.8 ** 5) ** 30 = 7e-6; each more alike pair with less.

Identical sets are one class first (one row a task leaves the map side), so
exact copies are never compared. Within a bucket no pair list is made:

1. every member is compared with the bucket's first class (its pivot), once
   per pivot however many buckets they share;
2. in buckets that still hold several components, members outside the
   bucket's main component are compared with all members, in blocks: a block
   of these is indexed in memory and all members stream past it.

So every pair that shares a bucket is compared or already connected. A
pivot's or block's members are dealt in salted portions of bounded size.

Texts without words, and null texts, have an empty set and link with nothing;
one word is a set of that word; repeated rows are copies of one another. Links
are between classes of equal sets, numbered by themselves: rows that share an id
but not the text are different vertices, and rows without an id take part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import Rows, arrow_map, guarded, row_key, store
from bazaarlens.llm.components import UnionFind, components

BANDS, ROWS = 30, 5
SHINGLE = 2
SIMILARITY = (80, 100)     # intersection * 100 >= union * 80
PORTION = 500              # members that one unit of comparison streams
BLOCK = 500                # documents that one unit holds in memory
MAX_WORDS = 200_000

_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: bytes, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle digests of a UTF-8 text (A-Z lower-cased)."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    mixed = scramble(h[:len(h) - n + 1] + _U(n))
    for k in range(1, n):
        mixed = scramble(mixed * _GOLD + h[k:len(h) - n + 1 + k])
    return np.unique(mixed)


def super_minhash(items: np.ndarray, m: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signature of distinct 64-bit items as m integers.

    Item x walks a permutation of the positions; its j-th stop gets the value
    j plus a fraction, and a position keeps its least value. All items step
    together; once every position holds a value below j + 1 the walk ends,
    for no later stop can lower one."""
    best = np.full(m, np.iinfo(np.int64).max, np.int64)
    n = len(items)
    if not n:
        return best
    rows = np.arange(n)
    perm = None
    for j in range(m):
        r = scramble(items + _U(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF))
        value = (r >> _U(32)).astype(np.int64) + (j << 32)
        k = j + ((r & _U(0xFFFFFFFF)) * _U(m - j) >> _U(32)).astype(np.int64)
        if j == 0:
            first = k
            stop = k
        else:
            if perm is None:
                perm = np.broadcast_to(np.arange(m, dtype=np.int16), (n, m)).copy()
                perm[rows, first] = 0
                perm[:, 0] = first
            stop = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
            perm[:, j] = stop
        np.minimum.at(best, stop, value)
        if int(best.max()) < (j + 1) << 32:
            break
    return best


def bands_of(signature: np.ndarray) -> list[int]:
    """One bucket key per band."""
    raw = signature.astype("<i8").tobytes()
    step = 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[i * step:(i + 1) * step], seed=i) - (1 << 63)
            for i in range(BANDS)]


def signed(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, rk, n_shingles, klass, bands) of every document row; ``klass`` is the digest of
    the whole set (null for an empty one)."""
    schema = pa.schema([("doc_id", pa.int64()), ("rk", pa.string()), ("n_shingles", pa.int64()),
                        ("klass", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        hashes, rows = WordHashes(), Rows(schema)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for i, rk, t in zip(batch.column(0), batch.column(1), texts):
                s = shingles(t.as_py() or b"", hashes, size)
                klass = bands = None
                if len(s):
                    klass = hashlib.md5(s.tobytes(), usedforsecurity=False).digest()
                    bands = bands_of(super_minhash(s))
                if rows.add(300, i.as_py(), rk.as_py(), len(s), klass, bands):
                    yield rows.take()
        yield from rows.rest()

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), row_key().alias("rk"), "text"),
                     run, "doc_id bigint, rk string, n_shingles bigint, klass binary, "
                          "bands array<bigint>")


def linked(a: int, b: int, both: int) -> bool:
    return SIMILARITY[1] * both >= SIMILARITY[0] * (a + b - both)


class Block:
    """Sets held in memory behind one index, to be matched against others."""

    def __init__(self, ids: list[int], comps: list[int], sets: list[np.ndarray]):
        self.ids, self.comps, self.sizes = ids, comps, np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")
        self.items, self.owner = items[order], owner[order]

    def matches(self, items: np.ndarray) -> np.ndarray:
        """Indexes of the held sets that are linked to ``items``."""
        lo = np.searchsorted(self.items, items, "left")
        hi = np.searchsorted(self.items, items, "right")
        n = hi - lo
        total = int(n.sum())
        if not total:
            return np.zeros(0, np.int64)
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        both = np.bincount(self.owner[at], minlength=len(self.ids))
        return np.flatnonzero(SIMILARITY[1] * both >=
                              SIMILARITY[0] * (self.sizes + len(items) - both))


def compare(units: DataFrame, size: int) -> DataFrame:
    """Links (a, b) found in units of comparison.

    ``units``: (unit, salt, held, id, comp, text). Within a (unit, salt) the
    held rows come first and are indexed; the others stream past. Links inside
    what a unit already knows to be one component are not emitted."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        hashes = WordHashes()
        unit, held, block, known = None, [], None, None
        a, b = [], []

        def note(x, cx, y, cy):
            if x != y and known.union(cx, cy):
                a.append(x)
                b.append(y)

        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(5)]
            texts = batch.column(5).cast(pa.binary())
            for k, (u, s, h, i, c) in enumerate(zip(*cols)):
                if (u, s) != unit:
                    unit, held, block, known = (u, s), [], None, UnionFind()
                items = shingles(texts[k].as_py() or b"", hashes, size)
                if h:
                    held.append((i, c, items))
                    continue
                if block is None:
                    if not held:
                        continue
                    block = Block(*map(list, zip(*held)))
                for z in block.matches(items):
                    note(block.ids[z], block.comps[z], i, c)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             schema=schema)
            a, b = [], []

    dealt = (units.select("unit", "salt", "held", "id", "comp", "text")
             .repartition("unit", "salt").sortWithinPartitions("unit", "salt", F.desc("held")))
    return arrow_map(dealt, run, "a bigint, b bigint")


def _portions(n):
    return F.greatest(F.ceil(n / PORTION), F.lit(1)).cast("int")


def _salt(id_col, n):
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), n).cast("int")


def link_classes(spark: SparkSession, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(node, component) over the stored ``classes`` of equal sets: vertex (a
    number), rk of the row that stands for the class, n_shingles, bands."""
    slots = store(classes.select(F.col("vertex").alias("id"), "rk", F.col("n_shingles").alias("n"),
                                 F.explode("bands").alias("band")), "band-slots")
    shared = (slots.groupBy("band").agg(F.count(F.lit(1)).alias("members"),
                                        F.min("id").alias("pivot"))
              .filter("members > 1"))
    slots = store(slots.join(store(shared, "band-shared"), "band"), "band-members")

    # whole texts of the classes that share a bucket: one shuffle of the corpus
    wanted = store(slots.select("id", "rk").distinct(), "band-ids")
    texts = docs.select(row_key().alias("rk"), "text")
    texts = texts.join(wanted.hint("shuffle_hash"), "rk")
    alike = Window.partitionBy("id").orderBy("rk")   # repeated rows: one is enough
    texts = store(texts.withColumn("nth", F.row_number().over(alike)).filter("nth = 1")
                  .select("id", "text"), "band-texts")

    def meet(rows: DataFrame) -> DataFrame:
        return rows.join(texts, "id")

    # 1. members against their buckets' pivots, once per pair
    pairs = store(slots.filter(F.col("id") != F.col("pivot")).select("id", "pivot").distinct(),
                  "pivot-pairs")
    portions = store(pairs.groupBy("pivot").agg(_portions(F.count(F.lit(1))).alias("portions")),
                     "pivot-portions")
    held = portions.select(F.col("pivot").alias("unit"), F.col("pivot").alias("id"),
                           F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("salt"),
                           F.lit(True).alias("held"))
    stream = (pairs.join(portions, "pivot")
              .select(F.col("pivot").alias("unit"), "id", _salt("id", F.col("portions"))
                      .alias("salt"), F.lit(False).alias("held")))
    units = held.unionByName(stream).withColumn("comp", F.col("id"))
    found = store(compare(meet(units), size), "pivot-links")
    comps = components(found)

    # 2. buckets that still hold several components
    now = store(slots.select("id", "band", "members").join(
        comps.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("comp", F.coalesce("component", "id")).drop("component"), "band-comps")
    parts = now.groupBy("band", "comp").agg(
        F.count(F.lit(1)).alias("part"), F.expr("bit_xor(xxhash64(id, 1))").alias("x"),
        F.expr("bit_xor(xxhash64(id, 2))").alias("y"))
    split = (parts.groupBy("band").agg(
        F.count(F.lit(1)).alias("n_comps"), F.sum("part").alias("members"),
        F.max_by("comp", F.struct("part", "comp")).alias("main"),
        F.max("part").alias("main_part"), F.expr("bit_xor(x)").alias("x"),
        F.expr("bit_xor(y)").alias("y")).filter("n_comps > 1")
        .groupBy("x", "y", "members", "main")       # buckets with the same members: one of them
        .agg(F.min("band").alias("band"), F.first("main_part").alias("main_part")))
    split = store(split.withColumn("blocks", F.ceil((F.col("members") - F.col("main_part")) / BLOCK)
                                   .cast("int"))
                  .withColumn("portions", _portions(F.col("members")))
                  .select("band", "main", "blocks", "portions"), "band-split")
    rest = now.drop("members").join(split, "band")
    block = F.pmod(F.xxhash64("id", F.lit(23)), F.col("blocks")).cast("int")
    numbers = F.sequence(F.lit(0), F.col("portions") - 1)
    unit = F.xxhash64("band", "block")
    stray = F.col("comp") != F.col("main")
    held = (rest.filter(stray).withColumn("block", block)
            .select(unit.alias("unit"), F.explode(numbers).alias("salt"), F.lit(True).alias("held"),
                    "id", "comp"))
    stream = (rest.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(unit.alias("unit"), _salt("id", F.col("portions")).alias("salt"),
                      F.lit(False).alias("held"), "id", "comp"))
    more = compare(meet(held.unionByName(stream)), size)
    return components(store(found.unionByName(more), "all-links"))


def near_duplicates(spark: SparkSession, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per document row: doc_id, rk, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable by links. A document
    without id is kept only if no document with an id is reachable; of a component
    without ids the text whose digest comes first is kept, with a null component."""
    marks = store(signed(docs, size), "signed")
    first = Window.partitionBy("klass").orderBy(F.col("doc_id").asc_nulls_last(), "rk")
    classes = store(marks.filter(F.col("klass").isNotNull())
                    .withColumn("nth", F.row_number().over(first)).filter("nth = 1")
                    .select("klass", "doc_id", "rk", "n_shingles", "bands",
                            F.monotonically_increasing_id().alias("vertex")), "classes")
    comps = link_classes(spark, docs, classes, size)
    grouped = store(classes.select("klass", "doc_id", "rk", F.col("vertex").alias("node"))
                    .join(comps, "node", "left")
                    .select("klass", "doc_id", "rk", F.coalesce("component", "node").alias("group")),
                    "class-groups")
    # stored apart, so that the join of a large component's classes can be split
    least = store(grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"),
                                               F.min("rk").alias("first_rk")), "class-least")
    named = store(grouped.select("klass", "group").join(least, "group")
                  .select("klass", "component_id", "first_rk"), "class-components")
    rows = marks.select("doc_id", "rk", "n_shingles", "klass").join(named, "klass", "left")
    kept = (F.when(F.col("klass").isNull(), F.lit(True))
            .when(F.col("component_id").isNull(), F.col("rk") == F.col("first_rk"))
            .otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
    return rows.select("doc_id", "rk", "n_shingles",
                       F.coalesce("component_id", "doc_id").alias("component_id"),
                       kept.alias("kept"))


def keep_first(spark: SparkSession, docs: DataFrame, size: int) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, and of
    rows alike in id and text one. The text is shuffled once more, by digest."""
    safe, name, cols = guarded(docs)
    plain = docs.select("doc_id", "text")
    kept = near_duplicates(spark, plain, size).filter("kept").select("rk").distinct()
    rk = row_key(name["doc_id"], name["text"])
    nth = Window.partitionBy("rk").orderBy("rk")
    rows = (safe.withColumn("rk", rk).join(store(kept, "kept-keys").hint("shuffle_hash"), "rk")
            .withColumn("nth", F.row_number().over(nth)).filter("nth = 1"))
    return rows.select(*[F.col(name[c]).alias(c) for c in cols])
