"""Helpers shared by the training-data operators.

Intermediate tables go to the shared folder that the cluster names in
``spark.checkpoint.dir`` (see ``lakemart.session.scratch_path``), never to a
machine-local folder, so any executor can be lost and its work redone.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage is cut
    by files that every executor can reach."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


STRETCH_CHARS = 1000


def stretches(text: str | None, most: int) -> str | None:
    """``text``, or if it is longer than ``most`` characters, stretches of its
    whole length chosen by hash, in order, of that many characters together.
    Words that a cut splits are left out."""
    if text is None or len(text) <= most:
        return text
    size = min(STRETCH_CHARS, most)
    starts = sorted(sorted(range(0, len(text), size), key=lambda k: zlib.crc32(b"%d" % k))[:most // size])
    out = []
    for k in starts:
        part = text[k:k + size]
        if k and not text[k - 1].isspace():
            part = part.split(None, 1)[-1]
        if k + size < len(text) and not text[k + size].isspace():
            part = part.rsplit(None, 1)[0]
        out.append(part)
    return "\n".join(out)[:most]


def bounded_text(text: Column, most: int) -> Column:
    """``stretches`` of a column."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([stretches(x.as_py(), most) for x in texts], pa.string())

    return F.arrow_udf(run, T.StringType())(text)


def hash_spread(ids: DataFrame, id_col: str, group: str, buckets: int) -> DataFrame:
    """At most ``buckets`` ids of each group: the id of least hash in each
    hash bucket.  A plain aggregate (combined map-side), so one group may hold
    any share of the rows."""
    h = F.xxhash64(F.col(id_col))
    return (ids.select(F.col(group), F.col(id_col), h.alias("_h"))
            .groupBy(group, F.pmod("_h", F.lit(buckets)).alias("_b"))
            .agg(F.min(F.struct("_h", id_col)).alias("_m"))
            .select(group, F.col(f"_m.{id_col}").alias(id_col)))
