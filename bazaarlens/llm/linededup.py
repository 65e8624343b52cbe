"""Reversible line de-duplication (operator 4).

State of a ``LineStore``, all in tables below ``spark.checkpoint.dir``:

- ``refs`` (key, refs): the exact number of documents that hold each line key;
- ``filters`` (shard, blob): one cuckoo filter per shard of the keys that at
  least ``min_docs`` documents hold. Shards are ranges of the key digest, so
  a hot line is one key of one shard and shards stay even.

``insert`` and ``delete`` add or subtract documents: reference counts are
merged exactly, and only keys that cross the threshold are inserted into or
deleted from their shard's filter, so a deletion undoes an insertion. Counts may
be negative: a deletion that comes before its insertion is remembered. A filter
that is full, or an exact table that has outgrown its shards, makes all filters
anew with more shards. ``save`` and ``LineStore.open`` keep the state under a
name for later sessions; a store that holds nothing drops nothing.
``dropped`` asks the filters first and confirms every positive against the
exact table; false positives of the filter never reach a document.

Keys are the 128-bit digest of the stripped, A-Z-lower-cased line. Null and
empty texts are one empty line; an empty key is never counted. Every row is
a document of its own (repeated rows count each).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.common import Rows, arrow_map, guarded, row_key, store
from bazaarlens.llm.cuckoo import CuckooFilter, built

WS = " \t\n\x0b\x0c\r"
SHARD_KEYS = 50_000    # keys a shard's filter is sized for
SHARD_REFS = 200_000   # keys of the exact table that fall to one shard's task


def _md5(raw: bytes) -> bytes:
    return hashlib.md5(raw, usedforsecurity=False).digest()


def keys_of(text: str) -> tuple[list[str], list[bytes]]:
    """The lines of a text and the digest of each line's key (b"" if empty)."""
    lines = text.split("\n")
    keys = [x.strip(WS).encode().lower() for x in lines]
    return lines, [_md5(k) if k else b"" for k in keys]


def line_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: its distinct line keys."""
    schema = pa.schema([("keys", pa.list_(pa.binary()))])

    def run(batches):
        rows = Rows(schema)
        for batch in batches:
            for t in batch.column(0):
                ks = set(keys_of(t.as_py() or "")[1]) - {b""}
                if ks and rows.add(40 * len(ks), sorted(ks)):
                    yield rows.take()
        yield from rows.rest()

    return arrow_map(docs.select(F.col(text)), run, "keys array<binary>")


def _count(keys: DataFrame) -> DataFrame:
    """Documents per key; counted map side first, so a hot line is one row a task."""
    return (keys.select(F.explode("keys").alias("key")).groupBy("key")
            .agg(F.count(F.lit(1)).alias("refs")))


def _shard(n: int):
    """Shard of a key: its leading 32 bits, uniform by construction."""
    lead = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("bigint")
    return F.floor(lead * F.lit(n) / F.lit(float(1 << 32))).cast("int")


class LineStore:
    """Exact counts and sharded filters; see the module's description."""

    def __init__(self, spark: SparkSession, min_docs: int = 10):
        self.spark, self.min_docs = spark, min_docs
        self.refs: DataFrame | None = None
        self.filters: DataFrame | None = None
        self.n_shards = 0

    def insert(self, docs: DataFrame, text: str = "text") -> None:
        self._change(_count(line_keys(docs, text)))

    def delete(self, docs: DataFrame, text: str = "text") -> None:
        """Take documents out again; pass the texts that were inserted."""
        self._change(_count(line_keys(docs, text)).withColumn("refs", -F.col("refs")))

    def _change(self, delta: DataFrame) -> None:
        if self.refs is None:
            self.refs = store(delta.filter("refs <> 0"), "line-refs")
            return self._rebuild()
        old = self.refs.select("key", F.col("refs").alias("old"), F.lit(0).cast("bigint").alias("d"))
        new = delta.select("key", F.lit(0).cast("bigint").alias("old"), F.col("refs").alias("d"))
        merged = store(old.unionByName(new).groupBy("key").agg(
            F.sum("old").alias("old"), (F.sum("old") + F.sum("d")).alias("refs")), "line-merge")
        self.refs = store(merged.filter("refs <> 0").select("key", "refs"), "line-refs")
        if self.refs.count() > 2 * SHARD_REFS * self.n_shards:
            return self._rebuild()
        hot_before, hot = F.col("old") >= self.min_docs, F.col("refs") >= self.min_docs
        moves = merged.filter(hot_before != hot).select(
            "key", F.when(hot, F.lit(1)).otherwise(F.lit(2)).alias("op"))
        self._update(moves)

    def save(self, folder: str) -> None:
        """Keep the state in a new folder of a shared file system."""
        if self.refs is not None:
            self.refs.write.parquet(f"{folder}/refs")
            self.filters.write.parquet(f"{folder}/filters")
        self.spark.range(1).select(F.lit(self.min_docs).alias("min_docs"),
                                   F.lit(self.n_shards).alias("n_shards")) \
            .write.parquet(f"{folder}/settings")      # written last: the state is whole

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineStore:
        """The state that ``save`` kept; changes are not written back to the folder."""
        kept = spark.read.parquet(f"{folder}/settings").first()
        out = cls(spark, kept.min_docs)
        if kept.n_shards:
            out.n_shards = kept.n_shards
            out.refs = spark.read.parquet(f"{folder}/refs")
            out.filters = spark.read.parquet(f"{folder}/filters")
        return out

    def _hot(self) -> DataFrame:
        return self.refs.filter(F.col("refs") >= self.min_docs).select("key")

    def _rebuild(self) -> None:
        """Filters anew from the exact table, with shards for its size."""
        self.n_shards = max(1, -(-self._hot().count() // SHARD_KEYS),
                            -(-self.refs.count() // SHARD_REFS))
        self.filters = None
        self._update(self._hot().withColumn("op", F.lit(1)))

    def _update(self, moves: DataFrame) -> None:
        rows = moves.select(_shard(self.n_shards).alias("shard"), "op", "key",
                            F.lit(None).cast("binary").alias("blob"))
        if self.filters is not None:
            rows = rows.unionByName(self.filters.select(
                "shard", F.lit(0).alias("op"), F.lit(None).cast("binary").alias("key"), "blob"))
        schema = pa.schema([("shard", pa.int32()), ("blob", pa.binary()), ("full", pa.bool_())])

        def run(batches):
            for shard, blob, ops in _by_shard(batches):
                if blob is None:
                    f, full = built([k for o, k in ops if o == 1]), False
                else:
                    f = CuckooFilter.from_bytes(blob)
                    for k in (k for o, k in ops if o == 2):
                        f.delete(k)
                    full = not all([f.insert(k) for o, k in ops if o == 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([f.to_bytes()], pa.binary()),
                     pa.array([full])], schema=schema)

        had = self.filters is not None
        made = store(arrow_map(_dealt(rows), run, "shard int, blob binary, full boolean"),
                     "line-filters")
        self.filters = made.select("shard", "blob")
        if had and made.filter("full").limit(1).count():
            self._rebuild()

    def dropped(self, keys: DataFrame) -> DataFrame:
        """Of distinct keys (column ``key``) those to drop: filter, then exact table."""
        if self.filters is None:
            return keys.select("key").filter(F.lit(False))
        asked = keys.select(_shard(self.n_shards).alias("shard"), F.lit(1).alias("op"), "key",
                            F.lit(None).cast("binary").alias("blob"))
        rows = asked.unionByName(self.filters.select(
            "shard", F.lit(0).alias("op"), F.lit(None).cast("binary").alias("key"), "blob"))
        schema = pa.schema([("key", pa.binary())])

        def run(batches):
            shard, f = None, None
            for batch in batches:
                out = []
                cols = [batch.column(k) for k in range(4)]
                start, n = 0, batch.num_rows
                shards, ops = cols[0].to_pylist(), cols[1].to_pylist()
                while start < n:
                    if ops[start] == 0:
                        shard, f = shards[start], CuckooFilter.from_bytes(cols[3][start].as_py())
                        start += 1
                        continue
                    end = start
                    while end < n and ops[end] == 1 and shards[end] == shards[start]:
                        end += 1
                    if shards[start] == shard:
                        ks = cols[2].slice(start, end - start).to_pylist()
                        out += [k for k, hit in zip(ks, f.contains(ks)) if hit]
                    start = end
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=schema)

        maybe = arrow_map(_dealt(rows), run, "key binary")
        return maybe.join(self._hot(), "key", "left_semi")


def _dealt(rows: DataFrame) -> DataFrame:
    """Each shard in one partition, its filter before its keys."""
    return rows.repartition("shard").sortWithinPartitions("shard", "op")


def _by_shard(batches):
    """(shard, blob, [(op, key)]) of rows sorted by shard; a shard holds about
    SHARD_KEYS keys, by construction of the shards."""
    shard, blob, ops = None, None, []
    for batch in batches:
        for s, o, k, b in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if s != shard:
                if shard is not None:
                    yield shard, blob, ops
                shard, blob, ops = s, None, []
            if o == 0:
                blob = b
            else:
                ops.append((o, k))
    if shard is not None:
        yield shard, blob, ops


def drop_lines(spark: SparkSession, docs: DataFrame, state: LineStore | None = None,
               min_docs: int = 10, text: str = "text") -> DataFrame:
    """The documents with ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    Without a ``state`` the documents themselves are the corpus. The text is
    shuffled once, to meet its dropped keys; keys travel as digests. The join
    of a hot line's documents is a plain skewed equi-join that Spark splits."""
    safe, name, cols = guarded(docs)
    body = name[text]
    rk = row_key(name["doc_id"], body) if "doc_id" in name else row_key(body, body)
    schema = pa.schema([("rk", pa.string()), ("keys", pa.list_(pa.binary()))])

    def with_keys(batches):
        rows = Rows(schema)
        for batch in batches:
            for r, t in zip(batch.column(0), batch.column(1)):
                ks = set(keys_of(t.as_py() or "")[1]) - {b""}
                if ks and rows.add(40 * len(ks), r.as_py(), sorted(ks)):
                    yield rows.take()
        yield from rows.rest()

    held = store(arrow_map(safe.select(rk.alias("rk"), body), with_keys,
                           "rk string, keys array<binary>"), "line-keys")
    if state is None:
        state = LineStore(spark, min_docs)
        state._change(_count(held))
    pairs = held.select("rk", F.explode("keys").alias("key"))
    gone = store(state.dropped(pairs.select("key").distinct()), "line-gone")
    hits = (pairs.join(gone, "key", "left_semi").groupBy("rk")
            .agg(F.collect_set("key").alias("gone_keys")))
    joined = safe.withColumn("rk", rk).join(hits.hint("shuffle_hash"), "rk", "left").drop("rk")
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in safe.schema.fields]
                    + ["kept_text string", "n_lines bigint", "n_dropped bigint"])
    at = safe.columns.index(body)

    def cut(batches):
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for t, g in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                t, g = t.as_py() or "", g.as_py()
                if not g:
                    kept.append(t)
                    n_lines.append(t.count("\n") + 1)
                    n_dropped.append(0)
                    continue
                g = set(g)
                lines, keys = keys_of(t)
                stay = [x for x, k in zip(lines, keys) if k not in g]
                kept.append("\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()),
                                      pa.array(n_dropped, pa.int64())],
                names=batch.schema.names[:-1] + ["kept_text", "n_lines", "n_dropped"])

    out = arrow_map(joined, cut, ddl)
    return out.select(*[F.col(name[c]).alias(c) for c in cols if c not in
                        ("kept_text", "n_lines", "n_dropped")],
                      "kept_text", "n_lines", "n_dropped")


def dedup_lines(spark: SparkSession, docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The documents with repeated lines cut from their text; other columns as they were, but
    ``n_chars``, where present, is the new text's length."""
    cols = docs.columns
    out = drop_lines(spark, docs, min_docs=min_docs)
    new = {"text": F.col("kept_text").alias("text"),
           "n_chars": F.char_length("kept_text").cast(dict(docs.dtypes).get("n_chars", "bigint"))
           .alias("n_chars")}
    return out.select(*[new.get(c, F.col(c)) for c in cols])
