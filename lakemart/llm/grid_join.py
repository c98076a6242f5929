"""Near-duplicate join of embeddings by epsilon grid order.

Vectors link when their cosine is THRESHOLD or more; for unit vectors that is
a Euclidean distance of at most eps = sqrt(2 - 2 * THRESHOLD).  The vectors
are rotated onto their principal axes, the first AXES of them are cut into
grid cells of width eps, and the vectors are sorted by cell, axis by axis.  In
this order two runs of vectors whose cells are two or more apart on any axis
are provably distant; the join halves runs recursively, skips such pairs and
compares the rest by exact double-precision products.

At scale
    1. Equal vectors are one entity with a number of copies (an aggregate, so
       any share of the rows may be the same vector).
    2. The axes come from a bounded sample (FIT_VECTORS); they steer the order
       and never decide a link.
    3. Entities are range-partitioned in grid order, ties broken by further
       coordinates and id, so a cell of any size is split; running counts cut
       the order into blocks of at most BLOCK_BYTES.
    4. Blocks meet through an equi-join on the cells of the first two axes,
       then only if their bounding boxes are within eps.  A pair of blocks is
       one task's group.
    5. A pair returns link counts per vector and a spanning forest of its
       links, never the links themselves; forests become components by star
       contraction.

Defined results: a vector that is NULL, empty, zero, or holds NULL or
non-finite components links with nothing (n_links 0, its own component, kept).
Vectors of different lengths never link.  Repeated rows are copies that link
with each other.  A NULL id takes part; its component is the least non-NULL id
there, and it is not kept.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged
from lakemart.llm.components import components
from lakemart.llm.ngram_join import Forest

THRESHOLD = 0.9
AXES = 6
FIT_VECTORS = 5000
BLOCK_BYTES = 4 << 20     # of a block's coordinates in double precision
LEAF = 256


def usable(vector: Column) -> Column:
    """Whether a vector takes part: finite, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce(vector.isNotNull() & ~bad & (norm > 0), F.lit(False))


def unit_rows(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors in double precision at length 1, zero-padded to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    out = np.zeros((len(vectors), width))
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = np.asarray(vectors.flatten()).astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    # Scaled first, so that squares neither overflow nor vanish.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def principal_axes(entities: DataFrame, width: int) -> np.ndarray:
    """All axes of a bounded sample, most variance first (columns)."""
    h = F.xxhash64("vector")
    sample = entities.groupBy(F.pmod(h, F.lit(FIT_VECTORS)).alias("b")).agg(
        F.min_by("vector", h).alias("vector")).orderBy("b").toArrow()
    if not sample.num_rows:
        return np.eye(width)
    x = unit_rows(sample["vector"], width)
    x = x - x.mean(axis=0)
    _, axes = np.linalg.eigh(x.T @ x)
    return axes[:, ::-1]


def in_grid_order(entities: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """(part, nth, entity, copies, dim, cells, vector), sorted by dim and cells."""
    k = min(AXES, axes.shape[1])
    shared = entities.sparkSession.sparkContext.broadcast(axes[:, :k])

    def place(batches):
        for batch in batches:
            cells = np.zeros((0, k), np.int32)
            if batch.num_rows:
                lead = shared.value
                cells = np.floor(unit_rows(batch.column(2), len(lead)) @ lead / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(
                [[int(d), *map(int, c)] for d, c in zip(np.diff(np.asarray(batch.column(2).offsets)), cells)],
                pa.list_(pa.int32()))], names=["entity", "copies", "vector", "cells"])

    def number(batches):
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(nth, nth + batch.num_rows)),
                *batch.columns], names=["part", "nth", *batch.schema.names])
            nth += batch.num_rows

    kind = entities.schema["vector"].dataType.simpleString()
    placed = entities.select("entity", "copies", "vector").mapInArrow(
        place, f"entity long, copies long, vector {kind}, cells array<int>")
    ordered = placed.repartitionByRange("cells", "vector").sortWithinPartitions("cells", "vector")
    return ordered.mapInArrow(number, f"part int, nth long, entity long, copies long, vector {kind}, cells array<int>")


def in_blocks(ordered: DataFrame, rows: int) -> DataFrame:
    """``ordered`` with the number of each row's block of ``rows`` rows."""
    totals = staged(ordered.groupBy("part").agg(F.count("nth").alias("n")), "grid-parts")
    # One row per part.
    base = totals.selectExpr("part", "sum(n) OVER (ORDER BY part ROWS UNBOUNDED PRECEDING) - n AS base")
    place = F.col("base") + F.col("nth")
    return ordered.join(staged(base, "grid-base"), "part").select(
        place.alias("place"), F.floor(place / rows).cast("long").alias("block"), "entity", "copies", "vector", "cells")


def meeting_blocks(blocked: DataFrame) -> DataFrame:
    """Pairs (x <= y) of blocks whose cells are not provably distant."""
    n = AXES + 1
    box = blocked.groupBy("block").agg(*[f(F.get("cells", F.lit(k))).alias(f"{name}{k}")
                                         for k in range(n) for name, f in (("lo", F.min), ("hi", F.max))])
    box = staged(box.na.fill(0), "grid-boxes")
    # A block covers a run of lengths, first and second cells; those of its
    # neighbours overlap it widened by one.
    def covered(df: DataFrame, wide: int) -> DataFrame:
        return (df.withColumn("dim", F.explode(F.sequence("lo0", "hi0")))
                .withColumn("c1", F.explode(F.sequence(F.col("lo1") - wide, F.col("hi1") + wide)))
                .withColumn("c2", F.explode(F.sequence(F.col("lo2") - wide, F.col("hi2") + wide))))

    x, y = covered(box, 1).alias("x"), covered(box, 0).alias("y")
    near = F.col("x.block") <= F.col("y.block")
    for k in range(n):
        gap = 0 if k == 0 else 1
        near = near & (F.col(f"x.lo{k}") <= F.col(f"y.hi{k}") + gap) & (F.col(f"y.lo{k}") <= F.col(f"x.hi{k}") + gap)
    return x.join(y, (F.col("x.dim") == F.col("y.dim")) & (F.col("x.c1") == F.col("y.c1"))
                  & (F.col("x.c2") == F.col("y.c2")) & near).select(
        F.col("x.block").alias("x"), F.col("y.block").alias("y")).distinct()


class Run:
    """Vectors of one side of a block pair, in grid order."""

    def __init__(self, table: pa.Table, width: int, axes: np.ndarray):
        self.entity, self.copies = table["entity"].to_numpy(), table["copies"].to_numpy()
        self.dim = np.diff(np.asarray(table["vector"].combine_chunks().offsets))
        self.unit = unit_rows(table["vector"], width)
        self.lead = self.unit @ axes[:, :2 * AXES]
        self.at = np.arange(len(self.entity))


def distant(a: np.ndarray, b: np.ndarray, eps: float) -> bool:
    """Whether the bounding boxes of two sets of points are farther apart than eps."""
    gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(gap @ gap) > eps * eps * (1 + 1e-9) + 1e-12


def join_runs(a: Run, b: Run | None, eps: float, found) -> None:
    """Recursive epsilon grid order join; ``found`` gets index arrays and the
    matrix of links of each pair of leaves.  ``b`` None: a with itself."""
    stack = [(0, len(a.at), 0, len(a.at if b is None else b.at))]
    other = a if b is None else b
    while stack:
        i, j, k, m = stack.pop()
        same = b is None and (i, j) == (k, m)
        if i >= j or k >= m or (b is None and i > k):
            continue
        if not same and distant(a.lead[i:j], other.lead[k:m], eps):
            continue
        if j - i <= LEAF and m - k <= LEAF:
            links = (a.unit[i:j] @ other.unit[k:m].T >= THRESHOLD) & (a.dim[i:j, None] == other.dim[None, k:m])
            if same:
                np.fill_diagonal(links, False)
            if links.any():
                found(i, j, k, m, links, same)
            continue
        h1, h2 = (i + j) // 2 if j - i > LEAF else j, (k + m) // 2 if m - k > LEAF else m
        if same:
            h2 = h1
        stack += [(s, t, u, v) for s, t in ((i, h1), (h1, j)) for u, v in ((k, h2), (h2, m))]


def join_pairs(rows: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """Rows (entity, n, other): partial link counts (other NULL) and forest
    edges (n NULL) of every pair of blocks."""
    shared = rows.sparkSession.sparkContext.broadcast(axes)

    def run(table: pa.Table) -> pa.Table:
        axes = shared.value
        pair = table["pair"][0].as_py()
        table = table.sort_by("place")
        side = table["block"].to_numpy()
        a = Run(table.filter(pa.array(side == pair["x"])), len(axes), axes)
        b = None if pair["x"] == pair["y"] else Run(table.filter(pa.array(side == pair["y"])), len(axes), axes)
        other = a if b is None else b
        entity = a.entity if b is None else np.concatenate([a.entity, b.entity])
        shift = 0 if b is None else len(a.entity)
        count = np.zeros(len(entity), dtype=np.int64)
        forest, edges = Forest(np.arange(len(entity))), []

        def found(i, j, k, m, links, same):
            count[i:j] += links @ other.copies[k:m]
            if not same:
                count[shift + k:shift + m] += links.T @ a.copies[i:j]
            _spread(links, i, shift + k, forest, edges)

        join_runs(a, b, eps, found)
        some = np.flatnonzero(count)
        return pa.table({
            "entity": pa.array(np.concatenate([entity[some], entity[[e[0] for e in edges]]]).astype(np.int64)),
            "n": pa.array([*count[some].tolist(), *[None] * len(edges)], pa.int64()),
            "other": pa.array([*[None] * len(some), *entity[[e[1] for e in edges]].tolist()], pa.int64())})

    return rows.groupBy("pair").applyInArrow(run, "entity long, n long, other long")


def _spread(links: np.ndarray, left: int, right: int, forest: Forest, edges: list) -> None:
    """A spanning forest of a leaf's links, added to ``forest`` and ``edges``.

    Rows that share a column are connected through it: each linked column is
    joined to its first row, and each row to its first column."""
    for way, flip in ((links, False), (links.T, True)):
        some = np.flatnonzero(way.any(axis=1))
        for u, v in zip(some.tolist(), way[some].argmax(axis=1).tolist()):
            x, y = (left + v, right + u) if flip else (left + u, right + v)
            if forest.join(x, y):
                edges.append((x, y))
    # Links between trees that are still apart.
    while True:
        rows = np.array([forest.root(left + u) for u in range(links.shape[0])])
        cols = np.array([forest.root(right + v) for v in range(links.shape[1])])
        apart = links & (rows[:, None] != cols[None, :])
        if not apart.any():
            return
        some = np.flatnonzero(apart.any(axis=1))
        for u, v in zip(some.tolist(), apart[some].argmax(axis=1).tolist()):
            if forest.join(left + u, right + v):
                edges.append((left + u, right + v))


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    eps = float(np.sqrt(2 - 2 * THRESHOLD)) * (1 + 1e-9)   # rounding never parts a link
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    ok = usable(F.col("vector"))
    # Equal vectors are one entity, numbered by its place in a staged table.
    classes = rows.filter(ok).groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    entities = staged(classes.withColumn("entity", F.monotonically_increasing_id()), "grid-entities")
    width = entities.agg(F.max(F.size("vector"))).first()[0] or 1
    axes = principal_axes(entities, width)
    ordered = staged(in_grid_order(entities, axes, eps), "grid-order")
    block_rows = max(LEAF, BLOCK_BYTES // (8 * width))
    blocked = staged(in_blocks(ordered, block_rows), "grid-blocks")
    pairs = staged(meeting_blocks(blocked), "grid-pairs")
    sides = pairs.select(F.struct("x", "y").alias("pair"), F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    found = staged(join_pairs(sides.join(blocked.drop("cells"), "block"), axes, eps), "grid-links")
    counts = found.filter(F.col("n").isNotNull()).groupBy("entity").agg(F.sum("n").alias("n"))
    classes_of = components(found.filter(F.col("n").isNull()), "entity", "other")
    known = staged(entities.join(counts, "entity", "left").join(
        classes_of.withColumnRenamed("node", "entity"), "entity", "left").select(
        "vector", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "entity").alias("component")), "grid-known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("vector", "n_links", "component_id")
    joined = rows.filter(ok).join(known, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
