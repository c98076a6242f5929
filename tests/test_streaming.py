"""ST1/ST2: restarts add nothing; stream results equal batch results."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from lakemart.operators.loads import SummingTable, VersionedTable
from lakemart.plans.streaming import project_events
from lakemart.schemas import EVENTS_DDL, NTZ_MICROS
from lakemart.streaming.streams import file_stream, rollup_stream, run_to_files, upsert_stream

SF = "/root/testdata/sf0.001"


def tmp():
    return tempfile.mkdtemp(prefix="lakemart-stream-")


def _landing(spark, root, parts=4):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.repartition(parts).write.mode("overwrite").option("timestampNTZFormat", NTZ_MICROS).json(f"{root}/landing")
    return ev


def test_st1_restart_adds_nothing_and_new_files_are_picked_up(spark):
    root = tmp()
    ev = _landing(spark, root)
    src = file_stream(spark, f"{root}/landing", EVENTS_DDL, max_files_per_trigger=1,
                      timestampNTZFormat=NTZ_MICROS)
    run_to_files(project_events(src), f"{root}/sink", f"{root}/ckpt")
    first = spark.read.parquet(f"{root}/sink").count()
    run_to_files(project_events(src), f"{root}/sink", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/sink").count() == first == ev.count()
    # stream output equals the batch transform
    batch = project_events(ev)
    assert spark.read.parquet(f"{root}/sink").exceptAll(batch).isEmpty()


def test_st2_upsert_stream_equals_batch(spark):
    root = tmp()
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    o.repartition(3).write.parquet(f"{root}/landing")
    src = file_stream(spark, f"{root}/landing", o.schema, fmt="parquet", max_files_per_trigger=1)
    t = VersionedTable(spark, f"{root}/t", schema="o_orderkey bigint, o_orderstatus string")
    upsert_stream(src, t, ["o_orderkey"], f"{root}/ckpt")
    assert t.read().exceptAll(o).isEmpty() and o.exceptAll(t.read()).isEmpty()


def test_st2_rollup_stream_replay_safe(spark):
    root = tmp()
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_type", F.lit(1).cast("bigint").alias("n"))
    ev.repartition(3).write.parquet(f"{root}/landing")
    src = file_stream(spark, f"{root}/landing", ev.schema, fmt="parquet", max_files_per_trigger=1)
    t = SummingTable(spark, f"{root}/t", ["event_type"], ["n"])
    rollup_stream(src, t, f"{root}/ckpt")
    rollup_stream(src, t, f"{root}/ckpt")  # restart: nothing new, nothing doubled
    got = {r.event_type: r.n for r in t.read_summed().collect()}
    want = {r.event_type: r["count"] for r in ev.groupBy("event_type").count().collect()}
    assert got == want


def test_stream_source_by_config(spark):
    from lakemart.streaming.streams import stream_source

    root = tmp()
    ev = _landing(spark, root, parts=2)
    src = stream_source(spark, {"format": "json", "path": f"{root}/landing", "max_files_per_trigger": 1,
                                "timestampNTZFormat": NTZ_MICROS}, EVENTS_DDL)
    assert src.isStreaming
    run_to_files(project_events(src), f"{root}/sink", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/sink").count() == ev.count()
