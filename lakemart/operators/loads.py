"""Keyed loads without MERGE.

Parquet tables reject MERGE/UPDATE, so every load is expressed as DataFrame
set logic and committed in a way that a retried or re-run job cannot
half-apply:

* ``VersionedTable`` — copy-on-write versions ``v=000001, v=000002, …``; the
  current version is the highest one whose ``_SUCCESS`` marker exists.  A
  failed write leaves no marker and is ignored, nothing is renamed (object
  stores have no cheap rename).
* ``upsert_partitioned`` — for partitioned tables only the partitions the
  batch touches are rewritten: merged rows are staged in the shared folder
  first (which cuts the read-while-overwrite loop), then swapped in with a
  dynamic partition overwrite.

A batch is written once to a staging folder beside the table, which is removed
when the load ends.

First-row-wins and latest-version picks always use a total order (the given
order columns, then every column) so results do not depend on task order.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import input_bytes

# Files of a partition of a swapped table hold up to about so much of it.
PARTITION_PIECE_BYTES = 128 << 20


def _hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem of ``path`` through the JVM gateway (any scheme the
    cluster mounts: hdfs, s3a, abfs, file), or None without a gateway."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def _arrow_fs(path: str):
    """Fallback for sessions without a JVM gateway (Spark Connect)."""
    from pyarrow import fs as pafs

    if "://" in path and not path.startswith("file://"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file://")


def path_exists(spark: SparkSession, path: str) -> bool:
    h = _hadoop_fs(spark, path)
    if h is not None:
        return bool(h[1].exists(h[0]))
    from pyarrow import fs as pafs

    fs, p = _arrow_fs(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    h = _hadoop_fs(spark, path)
    if h is not None:
        p, fs = h
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    from pyarrow import fs as pafs

    fs, p = _arrow_fs(path)
    if fs.get_file_info(p).type == pafs.FileType.NotFound:
        return []
    return [i.base_name for i in fs.get_file_info(pafs.FileSelector(p)) if i.type == pafs.FileType.Directory]


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` (table maintenance only)."""
    h = _hadoop_fs(spark, path)
    if h is not None:
        h[1].delete(h[0], True)
        return
    fs, p = _arrow_fs(path)
    fs.delete_dir(p)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file at ``path``."""
    h = _hadoop_fs(spark, path)
    if h is not None:
        h[1].create(h[0]).close()
        return
    fs, p = _arrow_fs(path)
    fs.open_output_stream(p).close()


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the smallest under ``order`` (ascending value
    expressions), then every column.

    ``min_by`` over a struct of all columns inside an aggregate: a hot key is
    reduced map-side instead of being sorted in one window partition.
    """
    rank = F.struct(*[e.alias(f"__o{i}") for i, e in enumerate(order or [])],
                    *[F.col(c).alias(f"__c_{c}") for c in df.columns])
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, rank).alias("__row")).select("__row.*")


def latest_per_key(df: DataFrame, keys: list[str], version_cols: list[str]) -> DataFrame:
    """L7 (ReplacingMergeTree + FINAL): the row with the highest version per
    key; ties broken by all columns.  ``max_by`` in an aggregate: partial
    per task, no per-key window."""
    order = F.struct(*[F.col(c) for c in version_cols], *[F.col(c) for c in df.columns])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("__row"))
            .select("__row.*"))


class DuplicateKeyError(ValueError):
    pass


class UnknownColumnError(ValueError):
    pass


def rows_without_keys(df: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among ``others``; NULL equals NULL."""
    return _met(df, others, keys, "left_anti")


def rows_with_keys(df: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is among ``others``; NULL equals NULL."""
    return _met(df, others, keys, "left_semi")


def _met(df: DataFrame, others: DataFrame, keys: list[str], how: str) -> DataFrame:
    names = [f"__key{i}" for i in range(len(keys))]
    right = others.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    same = reduce(lambda a, c: a & c, [df[k].eqNullSafe(right[n]) for k, n in zip(keys, names)])
    return df.join(right, same, how)


def reject_unknown_columns(batch: DataFrame, columns: list[str]) -> None:
    unknown = [c for c in batch.columns if c not in columns]
    if unknown:
        raise UnknownColumnError(f"the table has no columns {unknown}")


def reject_duplicate_keys(batch: DataFrame, keys: list[str]) -> None:
    if not batch.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty():
        raise DuplicateKeyError(f"batch has duplicate keys {keys}")


@contextmanager
def written_once(batch: DataFrame, path: str):
    """``batch`` written to ``path`` and read back for the time of a load, so
    its plan runs once however often the load reads it."""
    spark = batch.sparkSession
    batch.write.mode("overwrite").option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(batch.schema).parquet(path)
    finally:
        delete_path(spark, path)


class VersionedTable:
    """A keyed Parquet table kept as copy-on-write versions under ``root``.

    One writer per table at a time (jobs of a lake layer run in sequence);
    readers always see the last complete version.
    """

    _V = re.compile(r"^v=(\d+)$")

    def __init__(self, spark: SparkSession, root: str, schema=None):
        """``schema`` (DDL text or StructType) is used before the first version."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def versions(self) -> list[int]:
        out = []
        for name in list_dirs(self.spark, self.root):
            m = self._V.match(name)
            if m and path_exists(self.spark, f"{self.root}/{name}/_SUCCESS"):
                out.append(int(m.group(1)))
        return sorted(out)

    def current_version(self) -> int:
        v = self.versions()
        return v[-1] if v else 0

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:06d}"

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v == 0:
            if self.schema is None:
                raise ValueError(f"{self.root} has no version and no schema")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(self.path(v))

    def commit(self, df: DataFrame) -> int:
        """Write ``df`` as the next version; returns its number."""
        nxt = self.current_version() + 1
        df.write.mode("overwrite").parquet(self.path(nxt))
        return nxt

    # ---- loads --------------------------------------------------------

    def overwrite(self, df: DataFrame) -> int:
        """L5 full refresh (truncate + insert)."""
        return self.commit(df)

    def insert_if_absent(self, batch: DataFrame, keys: list[str],
                         order: list[Column] | None = None) -> int:
        """L1: ``INSERT … SELECT DISTINCT … ON CONFLICT (keys) DO NOTHING``.

        Returns the number of rows inserted (0 → no new version).  The first
        row per key inside the batch wins under ``order`` + all columns.  A
        NULL key matches a NULL key; a column the table lacks is rejected.
        """
        current = self.read()
        reject_unknown_columns(batch, current.columns)
        fresh = first_per_key(batch.select(*current.columns), keys, order)
        with written_once(rows_without_keys(fresh, current, keys), self._staging()) as new_rows:
            inserted = new_rows.count()  # Parquet footers: no data scan
            if inserted:
                self.commit(current.unionByName(new_rows))
        return inserted

    def upsert(self, batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> int:
        """L3/L4: ``ON CONFLICT (keys) DO UPDATE SET all = EXCLUDED``.

        Empty batch → no-op.  Duplicate keys inside the batch are rejected
        unless ``order`` says which row wins (the last under ``order``).  A
        NULL key matches a NULL key; a column the table lacks is rejected.
        """
        if self.current_version() == 0 and self.schema is None:
            current = self.spark.createDataFrame([], batch.schema)  # first load: columns from the batch
        else:
            current = self.read()
        reject_unknown_columns(batch, current.columns)
        if order is not None:
            batch = latest_per_key(batch.select(*[o.alias(f"__v{i}") for i, o in enumerate(order)], *current.columns),
                                   keys, [f"__v{i}" for i in range(len(order))])
        with written_once(batch.select(*current.columns), self._staging()) as rows:
            if rows.isEmpty():
                return self.current_version()
            if order is None:
                reject_duplicate_keys(rows, keys)
            return self.commit(rows_without_keys(current, rows, keys).unionByName(rows))

    def _staging(self) -> str:
        return f"{self.root}/_staging-{uuid.uuid4().hex[:12]}"

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete complete versions older than the newest ``keep`` (readers
        of the current version are unaffected).  Returns deleted versions."""
        old = self.versions()[:-keep] if keep > 0 else []
        for v in old:
            delete_path(self.spark, self.path(v))
        return old

    def upsert_if_changed(self, batch: DataFrame, keys: list[str],
                          order: list[Column] | None = None) -> int:
        """Upsert, but commit no new version when every batch row is already
        in the table (re-running a load changes nothing).

        The batch is compared only with the table rows of its own keys (a
        semi join; a small key set is broadcast), not with the whole table.
        """
        current = self.read()
        rows = batch.select(*current.columns)
        names = [f"__key{i}" for i in range(len(keys))]
        brought = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        same = reduce(lambda a, c: a & c, [current[k].eqNullSafe(brought[n]) for k, n in zip(keys, names)])
        if rows.exceptAll(current.join(brought, same, "left_semi")).isEmpty():
            return self.current_version()
        return self.upsert(batch, keys, order)


def load_df(spark: SparkSession, df: DataFrame, table_root: str, conflict_columns: list[str],
            order: list[Column] | None = None) -> int:
    """L4: generic keyed load — ``INSERT … ON CONFLICT (conflict_columns) DO
    UPDATE SET`` every other column, with the column list taken from ``df``.

    An empty DataFrame is a no-op; the first load creates the table.
    Returns the table's current version.
    """
    return VersionedTable(spark, table_root).upsert(df, conflict_columns, order=order)


class SummingTable:
    """An additive rollup: rows with the same key add up.

    Every batch is appended as plain Parquet under ``batch_id=<id>``; reading
    is a grouped sum.  Writing a batch id again replaces that batch, so a
    replayed batch counts once.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], measures: list[str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.measures = keys, measures

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(m).alias(m) for m in self.measures])

    def add(self, batch: DataFrame, batch_id: str | int | None = None) -> str:
        """Append a batch, summed by key; returns its id (a fresh one by default)."""
        name = uuid.uuid4().hex if batch_id is None else str(batch_id)
        self._summed(batch).write.mode("overwrite").parquet(f"{self.root}/batch_id={name}")
        return name

    def read_summed(self) -> DataFrame:
        return self._summed(self.spark.read.parquet(self.root).select(*self.keys, *self.measures))


def load_dimension(t: VersionedTable, batch: DataFrame, natural_key: list[str], id_col: str,
                   attrs: list[str]) -> int:
    """Insert-if-absent into a dimension with a surrogate key (BIGSERIAL).

    New natural keys (first row per key wins) get dense ids continuing after
    the current maximum; existing keys keep theirs.  Returns rows inserted.
    """
    from lakemart.operators.layout import dense_ids

    current = t.read()
    fresh = first_per_key(batch.select(*natural_key, *attrs), natural_key)
    with written_once(rows_without_keys(fresh, current, natural_key), t._staging()) as new:  # noqa: SLF001
        n = new.count()
        if n == 0:
            return 0
        # A struct key holds NULL parts without being NULL itself.
        keyed = new.withColumn("__nk", F.struct(*natural_key))
        start = current.select(F.coalesce(F.max(id_col), F.lit(0)) + 1).scalar()
        ids = dense_ids(keyed, "__nk", id_col, start=start)
        rows = keyed.join(ids, keyed["__nk"].eqNullSafe(ids["__nk"])).select(*[keyed[c] if c in keyed.columns else ids[c]
                                                                             for c in current.columns])
        t.commit(current.unionByName(rows))
    return n


def touched_partitions(target: DataFrame, batch: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows of ``target`` in the partitions that ``batch`` touches.

    One row of bounds becomes a static partition filter; inside them a semi
    join on the partition columns prunes at run time (dynamic partition
    pruning).  The plan is the same for any number of partitions.
    """
    bounds = batch.agg(*[f(c).alias(f"{n}_{c}") for c in partition_cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    between = reduce(lambda a, c: a & c, [F.col(c).between(bounds[f"lo_{c}"], bounds[f"hi_{c}"]) for c in partition_cols])
    touched = F.broadcast(batch.filter(between).select(*partition_cols).distinct())   # a row per partition: rows of one never meet in a task
    return target.filter(between).join(touched, partition_cols, "left_semi")


def upsert_partitioned(spark: SparkSession, table_path: str, batch: DataFrame, keys: list[str],
                       partition_cols: list[str], staging_path: str) -> None:
    """Partition-scoped upsert into a directory-partitioned Parquet table.

    Only partitions present in the batch are listed and read, merged (target
    rows without a batch key + batch rows), staged under ``staging_path`` and
    swapped in with a dynamic partition overwrite; other partitions are not
    touched.  Partition columns must be part of the key and not NULL;
    duplicate keys in the batch and columns the table lacks are rejected; a
    NULL in another key column matches NULL.
    """
    if not set(partition_cols) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    with written_once(batch, f"{staging_path.rstrip('/')}/batch") as rows:
        no_partition = reduce(lambda a, c: a | c, [F.col(c).isNull() for c in partition_cols])
        if not rows.filter(no_partition).isEmpty():
            raise ValueError(f"NULL in the partition columns {partition_cols}")
        reject_duplicate_keys(rows, keys)
        if rows.isEmpty():
            return
        merged = rows
        if path_exists(spark, table_path):
            target = spark.read.parquet(table_path)
            reject_unknown_columns(rows, target.columns)
            affected = touched_partitions(target, rows, partition_cols)
            merged = rows_without_keys(affected, rows, keys).unionByName(rows.select(*target.columns))
        with written_once(merged, f"{staging_path.rstrip('/')}/merged") as staged:
            # One partition may hold most rows: it is dealt out by key as well.
            parts = -(-input_bytes(staged) // PARTITION_PIECE_BYTES)
            if parts > 1:
                piece = F.pmod(F.xxhash64(*keys), F.lit(parts)).alias("__piece")
                dealt = staged.select("*", piece).hint("rebalance", *partition_cols, "__piece").drop("__piece")
            else:
                dealt = staged.hint("rebalance", *partition_cols)
            (dealt.write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(table_path))


def route_by_ranges(df: DataFrame, date_col: str, ranges: DataFrame, label_col: str = "partition_name",
                    reject_label: str = "rejected") -> DataFrame:
    """Route rows to declared, disjoint ``[lo, hi)`` date ranges; rows
    outside every range get ``reject_label``.

    An equi-join on the month: every range is listed once for each month it
    touches, and the bounds are compared only within a row's month."""
    month = F.explode(F.sequence(F.trunc("lo", "MM"), F.trunc(F.date_sub("hi", 1), "MM"), F.expr("interval 1 month")))
    r = ranges.filter("lo < hi").select(F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                                        F.col(label_col).alias("__label"), month.alias("__month"))
    inside = (F.col(date_col) >= F.col("__lo")) & (F.col(date_col) < F.col("__hi"))
    joined = df.join(r, (F.trunc(date_col, "MM") == F.col("__month")) & inside, "left")
    return joined.withColumn(label_col, F.coalesce("__label", F.lit(reject_label))).select(*df.columns, label_col)


def month_ranges(spark: SparkSession, first_month: str, months: int, prefix: str = "p") -> DataFrame:
    """Declared monthly ranges built from a rule: ``months`` months from
    ``first_month`` ('YYYY-MM-01'), labelled ``pYYYY_MM``."""
    base = F.lit(first_month).cast("date")
    seq = spark.range(months).select(F.add_months(base, F.col("id").cast("int")).alias("lo"))
    return seq.select("lo", F.add_months("lo", 1).alias("hi"),
                      F.concat(F.lit(prefix), F.date_format("lo", "yyyy_MM")).alias("partition_name"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b2: a.unionByName(b2), frames)
