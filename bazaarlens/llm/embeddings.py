"""Embedding near-duplicates by spherical k-means cells (operator 5).

Vectors are scaled to unit length in double precision. Per (label, dimension)
spherical k-means, fitted on a bounded sample, gives cells; every vector has
the cell of its nearest centroid as home. Two vectors may only be compared in
the home cell of one of them, so each vector also visits every cell that can
hold a partner: a partner y with cosine >= ``threshold`` is at most
``sqrt(2 - 2 * threshold)`` away, and y lies on its own centroid's side of the
plane that halves two centroids, so x visits cell b exactly when its distance
to the plane between its home and b is no larger. No link is lost by that, at
any quality of the centroids.

Within a cell, blocks of home vectors are held and all members stream past as
matrix products, so a cell of any size is worked off in pieces of bounded
size; each home vector meets all its partners in its home cell, which gives
its exact number of links. Equal vectors are one class first. Links are
reduced to stars per block before they leave a task; components are formed by
star contraction.

Vectors that are null, empty, zero, or hold null or non-finite components,
and rows with null label or null id, link with nothing. Vectors of different
lengths do not link. Repeated rows are vectors of their own.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import Rows, arrow_map, ship, store
from bazaarlens.llm.components import components

THRESHOLD = 0.93
CELL_VECTORS = 1_000     # classes that a cell is meant to hold
MAX_CELLS = 4_096        # bound of the centroid table, which all tasks get
SAMPLE_PER_CELL = 48     # vectors k-means sees per cell
ROUNDS = 10
BLOCK = 1_000            # home vectors that one unit holds
PORTION = 4_000          # members that one unit streams
PRODUCTS = 1 << 20       # cosines with centroids held at a time (8 MB)

_UNIT_DDL = "vec_id bigint, label int, dim int, klass binary, unit binary"


def unit_vector(values) -> np.ndarray | None:
    """Unit vector in double precision, or None if it cannot link."""
    if values is None or not len(values):
        return None
    v = np.array([math.nan if x is None else x for x in values], np.float64)
    top = np.abs(v).max() if np.isfinite(v).all() else 0.0
    if not top > 0:
        return None
    v = v / top
    return v / math.sqrt(float(v @ v))


def unit_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, klass, unit): one row per input row; klass and unit
    are null where the vector cannot link."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int32()), ("dim", pa.int32()),
                        ("klass", pa.binary()), ("unit", pa.binary())])

    def run(batches):
        rows = Rows(schema)
        for batch in batches:
            for i, v, label in zip(*[batch.column(k) for k in range(3)]):
                i, label = i.as_py(), label.as_py()
                u = None if i is None or label is None else unit_vector(v.as_py())
                if u is None:
                    due = rows.add(32, i, label, None, None, None)
                else:
                    raw = u.tobytes()
                    klass = hashlib.md5(raw + b"%d" % label, usedforsecurity=False).digest()
                    due = rows.add(len(raw) + 48, i, label, len(u), klass, raw)
                if due:
                    yield rows.take()
        yield from rows.rest()

    src = vectors.select(F.col("vec_id").cast("bigint"), "embedding", F.col("label").cast("int"))
    return arrow_map(src, run, _UNIT_DDL)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids of unit rows; seeded by spread-out rows, fixed order."""
    chosen = [0]
    near = x @ x[0]
    for _ in range(1, k):
        nxt = int(np.argmin(near))
        chosen.append(nxt)
        near = np.maximum(near, x @ x[nxt])
    c = x[chosen].copy()
    block = max(1, PRODUCTS // len(c))
    for _ in range(rounds):
        home = np.concatenate([np.argmax(x[i:i + block] @ c.T, axis=1)
                               for i in range(0, len(x), block)])
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        size = np.linalg.norm(total, axis=1)
        c = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], c)
    return c


def fit_cells(classes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Centroids by (label, dim); groups that need one cell only are absent.

    The cells of all groups number at most MAX_CELLS: a cell is meant for
    max(CELL_VECTORS, 2 * classes / MAX_CELLS) classes, and a group gets
    ceil(size / that) cells if that is more than one. So the sample and the
    centroids that come to the driver are bounded whatever the input."""
    ship()
    sizes = store(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "emb-sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    per_cell = max(CELL_VECTORS, math.ceil(2 * total / MAX_CELLS))
    sizes = sizes.withColumn("k", F.ceil(F.col("n") / per_cell).cast("int")).filter("k > 1")
    rate = F.least(F.lit(1.0), SAMPLE_PER_CELL * F.col("k") / F.col("n"))
    drawn = F.pmod(F.xxhash64("klass"), F.lit(1 << 20)) < rate * (1 << 20)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("klass")
        x = np.stack([np.frombuffer(u) for u in pdf["unit"]])
        c = spherical_kmeans(x, min(int(pdf["k"].iloc[0]), len(x)))
        return pd.DataFrame({"label": pdf["label"].iloc[0], "dim": pdf["dim"].iloc[0],
                             "cell": np.arange(len(c)), "centroid": [r.tobytes() for r in c]})

    found = (classes.join(sizes, ["label", "dim"]).filter(drawn)
             .select("label", "dim", "k", "klass", "unit").groupBy("label", "dim")
             .applyInPandas(fit, "label int, dim int, cell int, centroid binary"))
    cells: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r.label, r.dim, r.cell)):
        cells.setdefault((r.label, r.dim), []).append(np.frombuffer(r.centroid))
    return {k: np.stack(v) for k, v in cells.items()}


def parts_of(groups: dict, cells: dict):
    """(group, some of its members): so many that their cosines with all of
    the group's centroids number PRODUCTS at most."""
    for key, members in groups.items():
        block = max(1, PRODUCTS // len(cells[key])) if key in cells else len(members)
        for i in range(0, len(members), block):
            yield key, members[i:i + block]


def place(spark: SparkSession, classes: DataFrame, cells: dict, threshold: float) -> DataFrame:
    """(cell, home, id, copies, unit): every class at home and as a visitor.
    ``cell`` is the text label:dim:number."""
    sent = spark.sparkContext.broadcast(cells)   # at most MAX_CELLS centroids
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    schema = pa.schema([("cell", pa.string()), ("home", pa.bool_()), ("id", pa.int64()),
                        ("copies", pa.int64()), ("unit", pa.binary())])

    def run(batches):
        rows = Rows(schema)
        gaps: dict = {}
        for batch in batches:
            ids, labels, dims, copies, units = [batch.column(k).to_pylist() for k in range(5)]
            groups: dict = {}
            for n, key in enumerate(zip(labels, dims)):
                groups.setdefault(key, []).append(n)
            for key, members in parts_of(groups, sent.value):
                name = f"{key[0]}:{key[1]}:"
                c = sent.value.get(key)
                if c is None:
                    visits = [(n, 0, True) for n in members]
                else:
                    if key not in gaps:
                        gaps[key] = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
                    x = np.stack([np.frombuffer(units[n]) for n in members])
                    s = x @ c.T
                    home = np.argmax(s, axis=1)
                    at_home = s[np.arange(len(members)), home]
                    near = (at_home[:, None] - s) <= reach * gaps[key][home] + 1e-12
                    near[np.arange(len(members)), home] = True
                    visits = [(members[i], int(b), b == home[i]) for i, b in zip(*near.nonzero())]
                for n, b, is_home in visits:
                    if rows.add(len(units[n]) + 40, name + str(b), bool(is_home), ids[n],
                                copies[n], units[n]):
                        yield rows.take()
        yield from rows.rest()

    return arrow_map(classes.select("id", "label", "dim", "copies", "unit"), run,
                     "cell string, home boolean, id bigint, copies bigint, unit binary")


def compare(placed: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): per held block, the links of each home vector (b null),
    and star edges of linked vectors (links null)."""
    sizes = store(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("m"),
                                             F.count_if("home").alias("h"))
                  .select("cell", F.greatest(F.ceil(F.col("h") / BLOCK), F.lit(1)).cast("int")
                          .alias("blocks"), F.ceil(F.col("m") / PORTION).cast("int")
                          .alias("portions")), "emb-cells")
    rows = placed.join(sizes, "cell")
    part = F.pmod(F.xxhash64("id"), F.col("portions")).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = (rows.filter("home").withColumn("block", block).withColumn("portion", upto("portions"))
            .withColumn("held", F.lit(True)))
    stream = (rows.withColumn("portion", part).withColumn("block", upto("blocks"))
              .withColumn("held", F.lit(False)))
    units = held.unionByName(stream).select("cell", "block", "portion", "held", "id", "copies",
                                            "unit")
    dealt = (units.repartition("cell", "block", "portion")
             .sortWithinPartitions("cell", "block", "portion", F.desc("held")))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def run(batches):
        rows = Rows(schema)
        unit, held, h = None, [], None
        ids = root = links = None

        def close():
            for i, n in zip(ids.tolist(), links.tolist()) if h is not None else ():
                if n:
                    rows.add(24, i, None, n)

        def meet(group):
            nonlocal root
            a_ids = np.array([g[0] for g in group], np.int64)
            a_copies = np.array([g[1] for g in group], np.int64)
            hit = (np.stack([np.frombuffer(g[2]) for g in group]) @ h.T) >= threshold
            hit &= a_ids[:, None] != ids[None, :]
            links[:] += hit.T @ a_copies
            for n in np.flatnonzero(hit.any(axis=1)):
                met = np.unique(root[hit[n]])
                rows.add(24, int(a_ids[n]), int(met[0]), None)
                for other in met[1:]:
                    rows.add(24, int(other), int(met[0]), None)
                    root[root == other] = met[0]

        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(7)]
            waiting = []
            for c, b, p, is_held, i, copies, u in zip(*cols):
                if (c, b, p) != unit:
                    if waiting:
                        meet(waiting)
                        waiting = []
                    close()
                    unit, held, h = (c, b, p), [], None
                if is_held:
                    held.append((i, u))
                    continue
                if h is None:
                    if not held:
                        continue
                    ids = np.array([x[0] for x in held], np.int64)
                    h = np.stack([np.frombuffer(x[1]) for x in held])
                    root, links = ids.copy(), np.zeros(len(held), np.int64)
                waiting.append((i, copies, u))
                if len(waiting) >= 512:
                    meet(waiting)
                    waiting = []
            if waiting:
                meet(waiting)
            yield from rows.rest()
        close()
        yield from rows.rest()

    return arrow_map(dealt, run, "a bigint, b bigint, links bigint")


def near_duplicates(spark: SparkSession, vectors: DataFrame,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = store(unit_rows(vectors), "emb-units")
    first = Window.partitionBy("klass").orderBy("vec_id")
    valid = rows.filter(F.col("klass").isNotNull())
    copies = valid.groupBy("klass").agg(F.count(F.lit(1)).alias("copies"))
    classes = store(valid.withColumn("nth", F.row_number().over(first)).filter("nth = 1")
                    .select("klass", "vec_id", "label", "dim", "unit").join(copies, "klass")
                    .withColumn("id", F.monotonically_increasing_id()), "emb-classes")
    placed = store(place(spark, classes, fit_cells(classes), threshold), "emb-placed")
    found = store(compare(placed, threshold), "emb-links")
    comps = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    links = (found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("id"))
             .agg(F.sum("links").alias("links")))
    # classes are the vertices of links (two may share a vec_id); a component is
    # named by its smallest vec_id at the end
    group = F.coalesce("component", "id").alias("group")
    joined = store(classes.select("klass", "vec_id", "id", "copies").join(links, "id", "left")
                   .join(comps.withColumnRenamed("node", "id"), "id", "left")
                   .select("klass", "vec_id", group,
                           (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")),
                   "emb-groups")
    least = store(joined.groupBy("group").agg(F.min("vec_id").alias("component")), "emb-least")
    named = joined.drop("vec_id").join(least, "group")
    out = rows.select("vec_id", "klass").join(store(named, "emb-named"), "klass", "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"),
                                 F.lit(True)).alias("kept"))
