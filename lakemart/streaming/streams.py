"""Structured Streaming runs of the batch jobs.

The transforms are the same DataFrame functions as in batch; only the edges
change: ``readStream`` (file source, or Kafka when its connector is on the
classpath) and ``writeStream`` with a checkpoint in the shared folder.
``trigger(availableNow=True)`` processes what is there and stops, so a
scheduled job can restart from its checkpoint without reprocessing.

Keyed sinks use ``foreachBatch``: each micro-batch is applied with the
idempotent loads of ``operators.loads``; additive sinks append under the batch
id, so a batch replayed after a failure replaces itself instead of adding up
twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemart.operators.keyed import BucketTable
from lakemart.operators.loads import SummingTable, VersionedTable


# Bytes of a micro-batch of file streams that name no number of files.
BATCH_BYTES_CONF = "lakemart.stream.maxBytesPerTrigger"
BATCH_BYTES_DEFAULT = str(1 << 30)


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Files as a stream; a micro-batch takes ``max_files_per_trigger`` files
    or, by default, the configured number of bytes."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        r = r.option("maxBytesPerTrigger", spark.conf.get(BATCH_BYTES_CONF, BATCH_BYTES_DEFAULT))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str, schema: StructType | str,
                 starting_offsets: str = "earliest") -> DataFrame:
    """Kafka topic → typed rows (needs the Kafka connector jar), with the
    text of messages that do not parse in ``rejects.RECORD``; load them with
    ``rejects.load_messages``."""
    from lakemart.sources.rejects import typed_messages

    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return typed_messages(raw, schema)


def stream_source(spark: SparkSession, config: dict, schema: StructType | str) -> DataFrame:
    """ST1: the stream named by configuration — ``{"format": "kafka",
    "bootstrap_servers": …, "topic": …}`` or a file source ``{"format":
    "json" | "parquet" | "csv", "path": …, "max_files_per_trigger": n}``."""
    fmt = config.get("format", "json")
    if fmt == "kafka":
        return kafka_stream(spark, config["bootstrap_servers"], config["topic"], schema,
                            config.get("starting_offsets", "earliest"))
    extra = {k: v for k, v in config.items() if k not in ("format", "path", "max_files_per_trigger")}
    return file_stream(spark, config["path"], schema, fmt=fmt,
                       max_files_per_trigger=config.get("max_files_per_trigger"), **extra)


def to_kafka(df: DataFrame, bootstrap_servers: str, topic: str, key_col: str, checkpoint: str) -> StreamingQuery:
    """S14 sink: rows as JSON values keyed by ``key_col``."""
    out = df.select(F.col(key_col).cast("string").alias("key"),
                    F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


def run_to_files(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> StreamingQuery:
    """ST1: stream into files with a checkpoint; process what is available
    and stop.  A restart reads the checkpoint and adds nothing new."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(sink_path)
    q.awaitTermination()
    return q


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def upsert_stream(df: DataFrame, table: BucketTable | VersionedTable, keys: list[str], checkpoint: str,
                  order: list | None = None) -> StreamingQuery:
    """ST2: every micro-batch upserted into a keyed table (replaying a batch
    gives the same table: upsert is idempotent)."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, keys, order=order)
    return run_foreach_batch(df, apply, checkpoint)


def insert_if_absent_stream(df: DataFrame, table: BucketTable | VersionedTable, keys: list[str],
                            checkpoint: str) -> StreamingQuery:
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.insert_if_absent(batch, keys)
    return run_foreach_batch(df, apply, checkpoint)


def rollup_stream(df: DataFrame, table: SummingTable, checkpoint: str) -> StreamingQuery:
    """ST2 for additive tables: each micro-batch is appended under its batch
    id, so a replayed one replaces itself."""
    return run_foreach_batch(df, lambda batch, batch_id: table.add(batch, batch_id), checkpoint)
