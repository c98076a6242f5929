"""Physical layout: bucketed and partitioned writes, dense surrogate ids,
lineage cuts (SURVEY §2.8 L2, L10–L15, J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import ensure_checkpoint_dir


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str,
                   sort: bool = True) -> DataFrame:
    """Write ``df`` as a bucketed table at ``path`` and return it.

    Two tables bucketed by the same key into the same number of buckets join
    without an Exchange on either side (GP ``DISTRIBUTED BY``).  Rows are
    first hash-partitioned by the key into ``buckets`` partitions — the same
    hash the bucket id uses — so each task writes exactly one bucket and the
    table has one file per bucket instead of one per task and bucket.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key)
    if sort:
        writer = writer.sortBy(key)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


class CoLocated:
    """Two frames laid out for joins on one key.

    Both are bucketed by the key into the same number of buckets, so they join
    without an Exchange.  Keys that hold ``hot_share`` of the left rows or more
    (at most ``1 / hot_share`` of them) would each be one file and one task:
    their rows lie beside the buckets and join through ``salts`` sub-keys.
    """

    def __init__(self, left: DataFrame, right: DataFrame, key: str, root: str, buckets: int, salts: int = 16,
                 hot_share: float | None = None):
        from lakemart.operators.joins import hot_keys

        self.key, self.salts = key, salts
        spark, tag = left.sparkSession, root.rsplit("-", 1)[-1]
        # A key above the mean bucket: the share's inverse bounds the list.
        share = hot_share or max(1.0 / buckets, 0.0001)
        self.hot = [r[0] for r in hot_keys(left.filter(F.col(key).isNotNull()), key, share).collect()]
        is_hot = F.coalesce(F.col(key).isin(self.hot), F.lit(False))
        self.left = write_bucketed(left.filter(~is_hot), f"left_{tag}", key, buckets, f"{root}/left")
        self.right = write_bucketed(right.filter(~is_hot), f"right_{tag}", key, buckets, f"{root}/right")
        for side, frame in (("left", left), ("right", right)):
            frame.filter(is_hot).hint("rebalance").write.mode("overwrite").parquet(f"{root}/hot_{side}")
        self.hot_left = spark.read.schema(left.schema).parquet(f"{root}/hot_left")
        self.hot_right = spark.read.schema(right.schema).parquet(f"{root}/hot_right")

    def join(self, how: str = "inner") -> DataFrame:
        """The join of both frames (``inner``, ``left``, ``left_semi`` or
        ``left_anti``); the key column comes once."""
        from lakemart.operators.joins import salted_join

        cold = self.left.join(self.right, self.key, how)
        if not self.hot:
            return cold
        return cold.unionByName(salted_join(self.hot_left, self.hot_right, self.key, self.salts, how=how))


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      sort_cols: list[str] | None = None, dynamic: bool = True,
                      fmt: str = "parquet", compression: str | None = None) -> None:
    """Directory-partitioned write.

    Without ``sort_cols`` rows are clustered by the partition columns with a
    ``rebalance`` hint: each directory gets few files and AQE splits a hot
    partition value over several writers.  With ``sort_cols`` the rows are
    range-partitioned on (partition columns, leading sort column) and sorted
    inside each task, so a big partition is cut into files holding
    contiguous, disjoint key ranges — Parquet min/max statistics then act as
    a sparse index (MergeTree ``ORDER BY``).  ``dynamic`` overwrites only the
    partitions present in ``df``.
    """
    if sort_cols:
        out = (df.repartitionByRange(*[F.col(c) for c in [*partition_cols, sort_cols[0]]])
               .sortWithinPartitions(*partition_cols, *sort_cols))
    else:
        out = df.hint("rebalance", *partition_cols)
    writer = out.write.mode("overwrite").partitionBy(*partition_cols)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    The result survives executor loss (unlike a local checkpoint) and later
    stages re-read it instead of recomputing the whole lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dense_ids(keys: DataFrame, key: str, id_col: str, start: int | F.Column = 1) -> DataFrame:
    """L2: dense ids ``start, start+1, …`` in ``key`` order, without a
    single-task window.

    Keys are range-partitioned and sorted, every row gets its position inside
    its partition, per-partition row counts (one small row per partition)
    become running offsets, and id = offset + position.  The numbered frame
    is checkpointed so both uses see the same partitioning.
    """
    # No explicit partition count: AQE coalesces the range partitions to the
    # real data size (contiguous ranges stay contiguous, so ids stay ordered).
    ranged = (keys.select(key).distinct().repartitionByRange(key)
              .sortWithinPartitions(key)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    numbered = cut_lineage(ranged.withColumn(
        "__pos", F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)))
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: a window over it is tiny by construction.
    from pyspark.sql import Window
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    base = start if isinstance(start, F.Column) else F.lit(start)
    return (numbered.join(offsets, "__pid")
            .select(key, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos") + base)
                    .cast("bigint").alias(id_col)))


def numbered_rows(rows: DataFrame, keys: list[str], id_col: str, start: int = 1) -> DataFrame:
    """``rows`` with ids ``start, start+1, …`` in ``keys`` order: the numbering
    of ``dense_ids`` for whole rows, so nothing is joined back to them."""
    placed = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "__mid", F.monotonically_increasing_id()))
    part = F.shiftright("__mid", 33)
    ahead, before = 0, []
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):   # a row per partition
        before.append((p, ahead))
        ahead += n
    offsets = rows.sparkSession.createDataFrame(before, "__p bigint, __ahead bigint")
    place = F.col("__mid").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("__p", part).join(F.broadcast(offsets), "__p").select(
        *rows.columns, (F.col("__ahead") + place + F.lit(start)).alias(id_col))


def rows_per_partition(df: DataFrame) -> DataFrame:
    """How many rows each Spark partition of ``df`` holds."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("rows_cnt"))


def distribute(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """Distribute rows by a key (co-location, ``DISTRIBUTED BY``) or
    evenly at random (``DISTRIBUTED RANDOMLY``: round-robin)."""
    return df.repartition(n, key) if key else df.repartition(n)


def with_file_count(df: DataFrame, n: int) -> DataFrame:
    """``coalesce`` to write ``n`` files without a shuffle (only for
    reducing; ``coalesce(1)`` on big data funnels everything through one
    task, so prefer ``repartition``/``rebalance`` when the data is large)."""
    return df.coalesce(n)


def compact_files(df: DataFrame) -> DataFrame:
    """L13 at scale: partitions of the advisory size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), measured in the
    shuffle, so the files follow the bytes and not the number of inputs."""
    return df.hint("rebalance")


def copy_table(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """``INSERT INTO target SELECT * FROM source`` (columns by position,
    as SQL does)."""
    spark.table(source).write.insertInto(target, overwrite=overwrite)


class cached:
    """Keep a reused result in memory for a block and always release it.

    with cached(df) as c:
        a = c.groupBy(...)...
    """

    def __init__(self, df: DataFrame, storage_level=None):
        self.df, self.level = df, storage_level

    def __enter__(self) -> DataFrame:
        return self.df.persist(self.level) if self.level else self.df.persist()

    def __exit__(self, *exc) -> None:
        self.df.unpersist()


def inspect(df: DataFrame, n: int = 5) -> tuple[str, list]:
    """Schema text and the first ``n`` rows (``take``, never a full
    collect)."""
    return df.schema.simpleString(), df.take(n)
