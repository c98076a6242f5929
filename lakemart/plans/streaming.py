"""Streaming runs over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.schemas import EVENTS_DDL, NTZ_MICROS
from lakemart.operators.keyed import BucketTable
from lakemart.plans.registry import register
from lakemart.session import bucket_count, scratch_path
from lakemart.streaming.streams import file_stream, run_to_files, upsert_stream


def project_events(df: DataFrame) -> DataFrame:
    """The transform shared by batch and stream: typed projection with the
    event day and the parsed ``props.k``."""
    return df.select("event_id", "user_id", "event_type", F.to_date("ts").alias("event_date"),
                     F.get_json_object("props", "$.k").cast("int").alias("k"))


@register("stream_events_copy", "ST1", oracle="""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
""")
def stream_events_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON Lines are streamed through the projection into
    Parquet with a checkpoint; the stream is started twice and the restart
    adds nothing."""
    root = scratch_path(spark, "stream_events")
    (b.events(spark, sf_dir).write.mode("overwrite")
     .option("timestampNTZFormat", NTZ_MICROS).json(f"{root}/landing"))
    src = file_stream(spark, f"{root}/landing", EVENTS_DDL, fmt="json",
                      timestampNTZFormat=NTZ_MICROS)
    for _ in range(2):
        run_to_files(project_events(src), f"{root}/sink", f"{root}/checkpoints/events")
    return spark.read.parquet(f"{root}/sink")


@register("stream_upsert_orders", "ST2", oracle="""
SELECT order_id, user_id, status, CAST(amount AS DOUBLE) AS amount FROM b_orders
""")
def stream_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders streamed in micro-batches into a keyed table with
    ``foreachBatch(upsert)``: a micro-batch rewrites only the buckets of its
    keys.  The result equals the batch view."""
    root = scratch_path(spark, "stream_orders")
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "status", "amount")
    o.write.mode("overwrite").parquet(f"{root}/landing")
    src = file_stream(spark, f"{root}/landing", o.schema, fmt="parquet")
    table = BucketTable(spark, f"{root}/ods_orders", ["order_id"], o.schema, bucket_count(spark, o))
    upsert_stream(src, table, ["order_id"], f"{root}/checkpoints/orders")
    return table.read().withColumn("amount", F.col("amount").cast("double"))


@register("stream_rollup_events", "ST2", oracle="""
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS events_cnt,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1, 2
""")
def stream_rollup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into an additive (summing) table: each micro-batch is
    pre-aggregated and written as the delta of its batch id, so a replayed
    batch replaces its own delta.  Started twice; the read equals the batch
    event statistics."""
    from lakemart.operators.loads import SummingTable
    from lakemart.streaming.streams import rollup_stream

    root = scratch_path(spark, "stream_rollup")
    (b.events(spark, sf_dir).write.mode("overwrite")
     .option("timestampNTZFormat", NTZ_MICROS).json(f"{root}/landing"))
    src = file_stream(spark, f"{root}/landing", EVENTS_DDL, fmt="json",
                      timestampNTZFormat=NTZ_MICROS)
    keyed = src.select(F.to_date("ts").alias("event_date"), "event_type",
                       F.lit(1).cast("bigint").alias("events_cnt"),
                       F.col("value").cast("decimal(12,2)").alias("value_sum"))
    table = SummingTable(spark, f"{root}/rollup", ["event_date", "event_type"], ["events_cnt", "value_sum"])
    for _ in range(2):
        rollup_stream(keyed, table, f"{root}/checkpoints/rollup")
    return table.read_summed().select("event_date", "event_type",
                                      F.col("events_cnt").cast("bigint").alias("events_cnt"),
                                      F.col("value_sum").cast("double").alias("value_sum"))
