"""Centroid clustering with heap-ordered bounds.

Lloyd's rounds over integer vectors, exact to the last unit, that look again
only at vectors whose cluster may have changed.  The gap of a vector is its
distance to the second nearest centroid less that to its own.  In a round, own
centroid and others move by their drifts, so the gap shrinks by no more than
the cluster's own drift and the largest of the others.  Each cluster adds these
amounts up; a vector enters its cluster's heap under its gap plus the sum at
that time, and stays right until the sum reaches that key.  A round pops the
expired vectors off the heaps, measures them against all centroids and pushes
them to the heap of their nearest one.

At scale the vectors stay where they are: a round maps the vectors' rows
(components, cluster, key) to new rows in the shared folder, batch by batch,
each batch with its own part of every cluster's heap.  Only the sums of the
vectors that moved leave a task (one row per cluster), and only centroids and
drifts (k rows) reach the driver and go back.

Squared distances are integers.  Products are made in doubles where no
intermediate value reaches 2**53, else in 64-bit integers; gaps are doubles with
a margin (SLACK) far above their rounding, so a tie is always measured exactly
and goes to the smaller centroid number.

Defined results: vectors that are NULL, of another dimension, or with NULL or
non-finite components are left out, and so are those with a component of
2**27 or more after scaling, whose squared distances no long holds; a NULL id
counts as empty text; repeated rows are vectors of their own (of equal hashes,
the smaller components come first); fewer vectors than clusters give that many
clusters, an empty table no rows; columns other than the id and the vector are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import drop_staged, staged

CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
SEED = 1
LARGEST = 1 << 27        # components stay below
SLACK = 1e-3             # gaps below count as expired
IN_DOUBLES = 1 << 22     # largest component whose products are exact in doubles


def usable(v: Column, dimensions: int, scale: int) -> Column:
    """Whether a vector takes part."""
    return F.coalesce((F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double") * scale) < LARGEST)), F.lit(False))


def as_integers(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int"))


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer centroids."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if largest < IN_DOUBLES and x.shape[1] <= 64 else np.int64
    a, c = x.astype(kind), centroids.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)


@dataclass(frozen=True)
class Round:
    """What a task must know: centroids, and each cluster's drift so far."""

    centroids: np.ndarray
    drifted: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and heap key of integer rows, measured against all centroids."""
        d = squared_distances(x, self.centroids)
        own = d.argmin(axis=1)
        rows = np.arange(len(x))
        near = np.sqrt(d[rows, own].astype(np.float64))
        if d.shape[1] == 1:
            return own, np.full(len(x), np.inf)
        d[rows, own] = np.iinfo(np.int64).max
        return own, np.sqrt(d.min(axis=1).astype(np.float64)) - near + self.drifted[own]

    def moved_to(self, centroids: np.ndarray) -> "Round":
        """The next round, with the drift that its centroids add."""
        step = np.sqrt(((centroids - self.centroids).astype(np.float64) ** 2).sum(axis=1))
        if len(step) < 2:
            return Round(centroids, self.drifted)
        first, second = np.sort(step)[::-1][:2]
        others = np.where(np.arange(len(step)) == step.argmax(), second, first)
        return Round(centroids, self.drifted + step + others)


def expired(cluster: np.ndarray, key: np.ndarray, now: Round) -> list[int]:
    """Rows popped off their clusters' heaps: those whose gap is used up."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(now.centroids))]
    for row, (c, k) in enumerate(zip(cluster.tolist(), key.tolist())):
        heaps[c].append((k, row))
    out = []
    for c, heap in enumerate(heaps):
        heapq.heapify(heap)
        until = float(now.drifted[c]) + SLACK
        while heap and heap[0][0] <= until:
            out.append(heapq.heappop(heap)[1])
    return sorted(out)


STATE = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("components", T.ArrayType(T.IntegerType())),
    T.StructField("cluster", T.IntegerType()), T.StructField("key", T.DoubleType()),
    T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("n", T.LongType()), T.StructField("scanned", T.LongType())])


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dimensions)


def assign(rows: DataFrame, now: Round, dimensions: int) -> DataFrame:
    """The vectors' next state, and with ``sums`` a row per task and cluster:
    what the cluster gained in components, vectors (``n``) and measured ones.

    ``rows`` holds vec_id and components, and after the first round the
    cluster and key of each vector.
    """
    fresh = "cluster" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(now.centroids)
        sums, n, scanned = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dimensions)
            if fresh:
                cluster, key = now.nearest(x)
                again = np.arange(len(x))
            else:
                cluster, key = batch.column(2).to_numpy().copy(), batch.column(3).to_numpy().copy()
                again = np.array(expired(cluster, key, now), dtype=np.int64)
                before = cluster[again]
                cluster[again], key[again] = now.nearest(x[again])
                moved = np.flatnonzero(cluster[again] != before)
                np.subtract.at(sums, before[moved], x[again[moved]].astype(np.int64))
                n -= np.bincount(before[moved], minlength=k)
            gained = again if fresh else again[moved]
            np.add.at(sums, cluster[gained], x[gained].astype(np.int64))
            n += np.bincount(cluster[gained], minlength=k)
            scanned += np.bincount(cluster[again], minlength=k)
            size = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), pa.array(key),
                pa.nulls(size, pa.list_(pa.int64())), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64())], names=STATE.names)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int32())), pa.array(np.arange(k, dtype=np.int32)),
            pa.nulls(k, pa.float64()), pa.array(sums.tolist(), pa.list_(pa.int64())), pa.array(n), pa.array(scanned)], names=STATE.names)

    return rows.mapInArrow(run, STATE)


def gains(state: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, np.ndarray, int]:
    """What all tasks report: sums and counts per cluster, measured vectors."""
    report = state.filter(F.col("sums").isNotNull())
    sums, n = np.zeros((k, dimensions), dtype=object), np.zeros(k, dtype=object)
    scanned = 0
    for r in report.groupBy("cluster").agg(
            F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dimensions)]).alias("sums"),
            F.sum("n").alias("n"), F.sum("scanned").alias("scanned")).collect():
        sums[r["cluster"]], n[r["cluster"]] = list(r["sums"]), r["n"]
        scanned += r["scanned"]
    return sums, n, scanned


@dataclass
class Clustering:
    """Final centroids and, per vector, vec_id, cluster and squared distance."""

    centroids: np.ndarray
    members: DataFrame
    scanned: list[int]          # vectors measured against all centroids, by round
    state: DataFrame | None = None


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of least hash of their id (rows of (vec_id, components))."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    best = vectors.select(key.alias("h"), "components").orderBy("h", "components").limit(k).collect()
    return np.array([r["components"] for r in best], dtype=np.int64)


def cluster_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS,
                    rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> Clustering:
    """``rounds`` rounds of assignment and update, then a last assignment."""
    v = F.col(vector_col)
    vectors = table.filter(usable(v, dimensions, scale)).select(
        F.col(id_col).cast("long").alias("vec_id"), as_integers(v, scale).alias("components"))
    start = first_centroids(vectors, k, seed)
    if not len(start):
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(start, empty, [])
    now = Round(start, np.zeros(len(start)))
    sums, n = np.zeros(start.shape, dtype=object), np.zeros(len(start), dtype=object)
    state, scanned = None, []
    for r in range(rounds + 1):
        rows = vectors if state is None else state.filter(F.col("sums").isNull()).select("vec_id", "components", "cluster", "key")
        last, state = state, staged(assign(rows, now, dimensions), f"heap-means-{r}")
        if last is not None:
            drop_staged(last)
        gained, more, seen = gains(state, len(start), dimensions)
        sums, n = sums + gained, n + more
        scanned.append(seen)
        if r < rounds:
            means = [[s // m for s in row] if m else now.centroids[c].tolist() for c, (row, m) in enumerate(zip(sums.tolist(), n.tolist()))]
            now = now.moved_to(np.array(means, dtype=np.int64))
    members = state.filter(F.col("sums").isNull()).select("vec_id", "components", "cluster")
    return Clustering(now.centroids, distances(members, now.centroids, dimensions), scanned, state)


def distances(members: DataFrame, centroids: np.ndarray, dimensions: int) -> DataFrame:
    """(vec_id, cluster, distance): squared distance to the own centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = _matrix(batch.column(1), dimensions).astype(np.int64) - centroids[batch.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array((apart * apart).sum(axis=1))],
                                             names=["vec_id", "cluster", "distance"])

    return members.mapInArrow(run, "vec_id long, cluster int, distance long")


def inertias(found: Clustering) -> DataFrame:
    """The members with the summed distances of their cluster and of all, and
    the digest of their centroid."""
    members = staged(found.members, "heap-means-members")
    if found.state is not None:
        drop_staged(found.state)
    per = {r["cluster"]: r["inertia"] for r in members.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    of = lambda values: F.get(F.array(*values), F.col("cluster")) if values else F.lit(None)
    return members.select(
        "vec_id", "cluster", "distance", of([F.lit(per.get(c, 0)).cast("long") for c in range(len(digests))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("long").alias("inertia"), of([F.lit(d) for d in digests]).cast("string").alias("centroid_sha256"))


def oracle_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same in DuckDB's SQL: plain rounds that measure every distance."""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x::DOUBLE * {scale}) < {LARGEST})) = {dimensions})""",
             f"c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS y FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v "
             f"ORDER BY h, x LIMIT {k}))"]
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (SELECT i, c, list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{r}),
a{r} AS MATERIALIZED (SELECT i, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM d{r} GROUP BY i)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT c, p, sum(e)::HUGEINT AS s, count(*) AS n
  FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS p FROM v JOIN a{r} USING (i)) GROUP BY c, p),
f{r} AS (SELECT c, list((CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END)::BIGINT ORDER BY p) AS y FROM m{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT was.c, coalesce(new.y, was.y) AS y FROM c{r} AS was LEFT JOIN f{r} AS new USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(y, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (i) JOIN c{rounds} USING (c)"""
