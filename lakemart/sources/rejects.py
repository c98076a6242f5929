"""Typed reads that keep what does not fit.

A field or message that does not fit its declared type is never a NULL in the
table: the whole record goes to a reject output with its text and the file it
came from, and both outputs are written in one pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators.keyed import BucketTable
from lakemart.operators.loads import written_once

RECORD = "rejected_record"


def with_record(schema) -> T.StructType:
    """``schema`` (DDL or StructType) and the column that takes a record that
    does not fit it."""
    s = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)  # noqa: SLF001
    if RECORD in s.names:
        raise ValueError(f"the schema has a column {RECORD}")
    return T.StructType([*s.fields, T.StructField(RECORD, T.StringType())])


class SplitRead:
    """Both outputs of a typed read: ``rows`` in the declared schema and
    ``rejects`` (record text, source file)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        stored = T.StructType([*schema.fields, T.StructField("source_file", T.StringType()), T.StructField("fits", T.BooleanType())])
        both = spark.read.schema(stored).parquet(path)
        self.rows = both.filter("fits").drop(RECORD, "source_file", "fits")
        self.rejects = both.filter("not fits").select(RECORD, "source_file")


def read_with_rejects(spark: SparkSession, path: str, schema, fmt: str, target: str, **options) -> SplitRead:
    """``path`` read as ``fmt`` (csv, json) under ``schema`` and written to
    ``target``, rows and rejects in folders of their own."""
    declared = with_record(schema)
    reader = spark.read.format(fmt).schema(declared).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    for k, v in options.items():
        reader = reader.option(k, v)
    read = reader.load(path)
    (read.select(*declared.names, F.col("_metadata.file_name").alias("source_file"), F.col(RECORD).isNull().alias("fits"))
     .write.mode("overwrite").option("compression", "zstd").partitionBy("fits").parquet(target))
    return SplitRead(spark, target, declared)


def read_json_documents(spark: SparkSession, path: str, schema, target: str) -> SplitRead:
    """Files that hold JSON arrays of documents, any number of files.  A
    file is one task and one unit of failure: a file that is no JSON is one
    reject with its text, its neighbours are read."""
    return read_with_rejects(spark, path, schema, "json", target, multiLine=True)


def typed_messages(messages: DataFrame, schema, value_col: str = "value") -> DataFrame:
    """JSON messages as typed rows.  A message that does not parse (or is
    NULL) has its text in RECORD, which is NULL for all others."""
    declared = with_record(schema)
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, declared, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD})
    names = [n for n in declared.names if n != RECORD]
    rows = messages.select(parsed.alias("m"), text.alias("t"))
    bad = F.col("m").isNull() | F.col(f"m.{RECORD}").isNotNull()
    return rows.select(*[F.col(f"m.{n}").alias(n) for n in names], F.when(bad, F.coalesce("t", F.lit(""))).alias(RECORD))


def load_messages(messages: DataFrame, table: BucketTable, rejects: str, checkpoint: str, order: list | None = None) -> StreamingQuery:
    """A stream of ``typed_messages`` into a keyed table and a reject folder:
    one ``foreachBatch`` with two idempotent sinks (an upsert, and rejects
    under the batch id), so a replayed batch changes nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        with written_once(batch, f"{rejects}-staging/{batch_id}") as rows:
            table.upsert(rows.filter(F.col(RECORD).isNull()).drop(RECORD), order=order)
            rows.filter(F.col(RECORD).isNotNull()).select(RECORD).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

    q = messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
