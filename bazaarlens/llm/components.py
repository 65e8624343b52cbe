"""Connected components of a link table by alternating star contraction.

Large-star and small-star steps (each a minimum per key, then a join) until
every vertex points straight at its component's smallest vertex. Hubs stay
cheap: minima are taken map side first, and the join of a hub's links is a
plain equi-join of two stored tables, which Spark splits where it is skewed.
Every step is written below ``spark.checkpoint.dir``; no link or label passes
through the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import arrow_map, drop_stored, store

MAX_ROUNDS = 60


class UnionFind:
    """Disjoint sets by path halving; the smallest member is the root."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = parent.setdefault(x, x)
        while root != parent[root]:
            parent[root] = parent[parent[root]]
            root = parent[root]
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches):
    """A task's links as stars around the roots of its own union-find."""
    links = UnionFind()
    seen = 0
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out():
        pairs = [(x, links.find(x)) for x in links.parent]
        pairs = [(x, r) for x, r in pairs if x != r]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            links.union(x, y)
        seen += batch.num_rows
        if seen > 1_000_000:   # bounded memory: hand on what is known, start anew
            yield out()
            links.parent.clear()
            seen = 0
    yield out()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every vertex that is not its component's smallest.

    ``links``: two bigint columns. A vertex without a row is its own component."""
    spark = links.sparkSession
    a, b = links.columns
    edges = store(arrow_map(links.filter(F.col(a) != F.col(b)).select(a, b), _forest,
                            "a bigint, b bigint").distinct(), "links")
    for _ in range(MAX_ROUNDS):
        # done: one pointer per vertex, and no vertex pointed at points on
        state = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        chained = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if not state.filter("n > 1").limit(1).count() and not chained.limit(1).count():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.min("b").alias("m"))
                      .select("a", F.least("a", "m").alias("m")), "links-min")
        large = store(both.join(least, "a").filter(F.col("b") > F.col("a"))
                      .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
                      "links-large")
        drop_stored(spark, edges)
        drop_stored(spark, least)
        least = store(large.groupBy("a").agg(F.min("b").alias("m")), "links-min")
        edges = store(large.join(least, "a").filter(F.col("b") != F.col("m"))
                      .select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        drop_stored(spark, large)
        drop_stored(spark, least)
    else:
        raise RuntimeError("the star contraction did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
