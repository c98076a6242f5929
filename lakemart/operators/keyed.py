"""Keyed tables whose loads touch only what a batch touches.

``BucketTable`` — plain Parquet, partitioned by a hash bucket of the key.  A
batch reads and rewrites only the buckets of its keys (Spark's partition
pruning and dynamic partition overwrite); rows that the table already holds
are found first, so a repeated load rewrites nothing, and inserts only append.

``Dimension`` — rows with dense surrogate ids, appended load by load.  A load
counts from the high-water mark that the one before committed; no row is ever
rewritten.

One writer per table at a time.  A load that dies can be run again: rows that
replace a bucket are complete in ``pending`` before the swap starts, and the
next load finishes a swap that was cut off; a load of a dimension counts only
once its mark is written.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.layout import numbered_rows
from lakemart.operators.loads import (
    delete_path, first_per_key, latest_per_key, list_dirs, path_exists, reject_duplicate_keys, reject_unknown_columns,
    rows_with_keys, rows_without_keys, touch, written_once,
)
from lakemart.session import BUCKETS_CONF

BUCKETS = 16
# Rows hold whole documents; every load writes them more than once.
CODEC = "zstd"


def _struct(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)  # noqa: SLF001


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType) or isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind)


_TEXT = (T.StringType, T.BinaryType)
# Types whose values differ where their text does, and only there.
_PLAIN = (*_TEXT, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)


def row_digest(fields: list[T.StructField]) -> Column:
    """SHA-256 of columns, each behind its length, so no two rows of different
    values run together; NULL is told from empty."""
    raw = [F.col(f.name).cast("binary") if isinstance(f.dataType, _TEXT) else F.col(f.name).cast("string").cast("binary") for f in fields]
    parts = [F.coalesce(F.concat(F.concat(F.octet_length(r).cast("string"), F.lit(":")).cast("binary"), r), F.lit("-").cast("binary"))
             for r in raw]
    return F.unhex(F.sha2(F.concat(*parts), 256))


class BucketTable:
    """Rows under a unique key, in ``buckets`` hash buckets (default
    ``lakemart.buckets`` or BUCKETS; a table keeps the number it was made
    with, which its partition column names).  NULL keys equal NULL keys."""

    _DIR = re.compile(r"^bucket_of_(\d+)=")

    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema=None, buckets: int | None = None):
        """``schema`` (DDL or StructType) may be left out: the first batch gives it."""
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.data, self.pending = f"{self.root}/data", f"{self.root}/pending"
        made = [m.group(1) for m in map(self._DIR.match, list_dirs(spark, self.data)) if m]
        self.buckets = int(made[0]) if made else buckets or int(spark.conf.get(BUCKETS_CONF, str(BUCKETS)))
        self.column = f"bucket_of_{self.buckets}"
        if schema is None and made:
            schema = T.StructType([f for f in spark.read.parquet(self.data).schema if f.name != self.column])
        self.schema = None if schema is None else _struct(schema)

    # ---- reading --------------------------------------------------------

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(self.column, T.IntegerType())])
        if not path_exists(self.spark, self.data):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.data)

    def read(self) -> DataFrame:
        if self.schema is None:
            raise ValueError(f"{self.root} has no rows and no schema")
        return self._stored().drop(self.column)

    def bucketed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.withColumn(self.column, bucket)

    def _in_buckets_of(self, rows: DataFrame) -> DataFrame:
        """Stored rows of the buckets that ``rows`` touches.  The list of
        buckets (never longer than their number) becomes a partition filter."""
        touched = [r[0] for r in rows.select(self.column).distinct().collect()]
        return self._stored().filter(F.col(self.column).isin(touched))

    # ---- loads ----------------------------------------------------------

    def upsert(self, batch: DataFrame, keys: list[str] | None = None, order: list[Column] | None = None) -> int:
        """Insert new keys, replace all columns of known ones; returns how
        many rows were new or changed.  Only their buckets are rewritten.

        Duplicate keys inside the batch are rejected unless ``order`` says
        which row wins (the last).  Unknown columns are rejected.
        """
        columns = self._start(batch, keys)
        if order is not None:
            named = [f"__v{i}" for i in range(len(order))]
            batch = latest_per_key(batch.select(*[o.alias(n) for o, n in zip(order, named)], *columns), self.keys, named)
        bucketed = self.bucketed(batch.select(*columns))
        if not path_exists(self.spark, self.data):
            return self._fill(bucketed, order is None)
        with written_once(bucketed, self._staging()) as rows:
            if order is None:
                reject_duplicate_keys(rows, self.keys)
            with written_once(self.changed_keys(rows), self._staging()) as keys:
                n = keys.count()
                if n:
                    with written_once(rows_with_keys(rows, keys, self.keys), self._staging()) as new:
                        self._swap(rows_without_keys(self._in_buckets_of(new), new, self.keys).unionByName(new))
        return n

    def _fill(self, bucketed: DataFrame, check: bool) -> int:
        """First rows of a table: all are new.  They are staged as a swap that
        counts once its mark is set, after the check."""
        path = f"{self.pending}/{uuid.uuid4().hex[:12]}"
        try:
            (bucketed.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
             .option("compression", CODEC).parquet(path))
            rows = self.spark.read.schema(bucketed.schema).parquet(path)
            if check:
                reject_duplicate_keys(rows, self.keys)
            n = rows.count()
        except BaseException:
            delete_path(self.spark, path)
            raise
        if n:
            touch(self.spark, f"{path}/_SUCCESS")
            self._apply(path)
        else:
            delete_path(self.spark, path)
        return n

    def changed_keys(self, rows: DataFrame) -> DataFrame:
        """Keys of the bucketed rows that the table does not hold as they are.

        Beside the key only a digest of the texts and plain values meets, and
        columns of other types as they are.
        """
        keys = rows.select(*self.keys)
        if any(_has_map(f.dataType) for f in self.schema):   # maps cannot be compared
            return keys
        held, names = self._in_buckets_of(rows), self.schema.names
        plain = [f for f in self.schema if isinstance(f.dataType, _PLAIN) and f.name not in self.keys]
        if any(isinstance(f.dataType, _TEXT) for f in plain):
            rest, digest = [c for c in names if c not in {f.name for f in plain}], f"{self.column}_digest"
            rows, held = (df.select(*rest, row_digest(plain).alias(digest)) for df in (rows, held))
            names = [*rest, digest]
        return rows_without_keys(rows, held, names).select(*self.keys)

    def insert_if_absent(self, batch: DataFrame, keys: list[str] | None = None, order: list[Column] | None = None) -> int:
        """Append rows of new keys (the first under ``order`` and all columns
        wins inside the batch); known keys keep their rows.  Returns how many."""
        columns = self._start(batch, keys)
        first = self.bucketed(first_per_key(batch.select(*columns), self.keys, order))
        with written_once(first, self._staging()) as rows:
            held = self._in_buckets_of(rows).select(*self.keys)
            with written_once(rows_without_keys(rows, held, self.keys), self._staging()) as new:
                n = new.count()
                if n:
                    (new.hint("rebalance", self.column).write.mode("append").option("compression", CODEC)
                     .partitionBy(self.column).parquet(self.data))
        return n

    def sync(self, rows: DataFrame) -> int:
        """Make the table hold exactly ``rows`` (a whole new state under the
        key): returns how many rows were new, changed or gone.  Buckets without
        a difference are not written."""
        columns = self._start(rows, None)
        with written_once(self.bucketed(rows.select(*columns)), self._staging()) as full:
            reject_duplicate_keys(full, self.keys)
            held = self._stored()
            gone = rows_without_keys(held, full, self.keys)
            new = rows_without_keys(full, held, columns) if not any(_has_map(f.dataType) for f in self.schema) else full
            with written_once(new.unionByName(gone).select(self.column), self._staging()) as touched:
                n, buckets = touched.count(), [r[0] for r in touched.distinct().collect()]
                if n:
                    rest = full.filter(F.col(self.column).isin(buckets))
                    full_buckets = {r[0] for r in rest.select(self.column).distinct().collect()}
                    if full_buckets:
                        self._swap(rest)
                    for bucket in set(buckets) - full_buckets:     # an overwrite leaves what it has no rows for
                        delete_path(self.spark, f"{self.data}/{self.column}={bucket}")
        return n

    def compact(self, files: int = 8) -> list[int]:
        """Rewrite the buckets that appends have left in ``files`` files or
        more; returns them."""
        self._finish_swaps()
        if self.schema is None or not path_exists(self.spark, self.data):
            return []
        per = self._stored().select(self.column, "_metadata.file_path").distinct().groupBy(self.column).count()
        many = sorted(r[0] for r in per.filter(F.col("count") >= files).collect())
        if many:
            self._swap(self._stored().filter(F.col(self.column).isin(many)))
        return many

    def _start(self, batch: DataFrame, keys: list[str] | None) -> list[str]:
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"the table's key is {self.keys}, not {keys}")
        if self.schema is None:
            self.schema = batch.schema
        reject_unknown_columns(batch, self.schema.names)
        self._finish_swaps()
        return self.schema.names

    def _swap(self, rows: DataFrame) -> None:
        """Replace the buckets of ``rows`` by ``rows``."""
        path = f"{self.pending}/{uuid.uuid4().hex[:12]}"
        rows.write.option("compression", CODEC).parquet(path)
        self._apply(path)

    def _put(self, rows: DataFrame) -> None:
        """Write ``rows`` as whole buckets."""
        (rows.hint("rebalance", self.column).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy(self.column).parquet(self.data))

    def _apply(self, path: str) -> None:
        self._put(self.spark.read.parquet(path))
        delete_path(self.spark, path)

    def _finish_swaps(self) -> None:
        for name in list_dirs(self.spark, self.pending):
            path = f"{self.pending}/{name}"
            if path_exists(self.spark, f"{path}/_SUCCESS"):
                self._apply(path)
            else:
                delete_path(self.spark, path)

    def _staging(self) -> str:
        return f"{self.root}/_staging-{uuid.uuid4().hex[:12]}"


def load_keyed(spark: SparkSession, batch: DataFrame, root: str, keys: list[str], order: list[Column] | None = None) -> int:
    """L4: the generic keyed load — insert new keys, update every other column
    of known ones, with the columns taken from the batch.  The first load
    creates the table, an empty one does nothing.  Returns the rows that were
    new or changed."""
    return BucketTable(spark, root, keys).upsert(batch, order=order)


class Dimension:
    """Natural keys and attributes under dense surrogate ids 1, 2, 3, …

    ``rows/load=n`` holds the rows that load n added, ``marks/load=n`` the
    highest id after it; a load without a mark does not count and is written
    again.  NULL keys equal NULL keys.
    """

    _DIR = re.compile(r"^load=(\d+)$")

    def __init__(self, spark: SparkSession, root: str, natural_key: list[str], id_col: str, schema):
        """``schema`` holds the id, the natural key and the attributes."""
        self.spark, self.root, self.id_col = spark, root.rstrip("/"), id_col
        self.keys, self.schema = list(natural_key), _struct(schema)

    def loads(self) -> list[int]:
        """Loads whose mark is complete, in order."""
        found = (self._DIR.match(d) for d in list_dirs(self.spark, f"{self.root}/marks"))
        return sorted(n for n in (int(m.group(1)) for m in found if m)
                      if path_exists(self.spark, f"{self.root}/marks/load={n}/_SUCCESS"))

    def high_water_mark(self) -> int:
        done = self.loads()
        return self.spark.read.parquet(f"{self.root}/marks/load={done[-1]}").first()[0] if done else 0

    def read(self) -> DataFrame:
        done = self.loads()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/rows/load={n}" for n in done])

    def add(self, batch: DataFrame) -> int:
        """Append the batch's new natural keys (the smallest row of each)
        under the next ids, in key order; returns how many."""
        columns = [c for c in self.schema.names if c != self.id_col]
        reject_unknown_columns(batch, columns)
        first = first_per_key(batch.select(*columns), self.keys)
        with written_once(rows_without_keys(first, self.read().select(*self.keys), self.keys),
                          f"{self.root}/_staging-{uuid.uuid4().hex[:12]}") as new:
            n = new.count()
            if n:
                load, mark = (self.loads() or [0])[-1] + 1, self.high_water_mark()
                (numbered_rows(new, self.keys, self.id_col, mark + 1).select(*self.schema.names)
                 .write.mode("overwrite").parquet(f"{self.root}/rows/load={load}"))
                (self.spark.createDataFrame([(mark + n,)], "high_water_mark long").coalesce(1)
                 .write.mode("overwrite").parquet(f"{self.root}/marks/load={load}"))
        return n
