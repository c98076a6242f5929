"""Layout and table maintenance: L5, L6, L11–L15, L17, O4, M10."""

from __future__ import annotations

import tempfile
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lakemart import session as S
from lakemart.functions.scalars import yyyymm
from lakemart.operators.layout import (
    cached, copy_table, distribute, inspect, rows_per_partition, with_file_count, write_partitioned,
)
from lakemart.operators.loads import VersionedTable
from lakemart.plans import layers

SF = "/root/testdata/sf0.01"


def tmp():
    return tempfile.mkdtemp(prefix="lakemart-layout-")


def test_l11_month_partitions_with_sorted_row_groups(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("dt"))
    o = o.withColumn("yyyymm", yyyymm(F.col("dt")))
    path = tmp() + "/orders_mt"
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)  # several files per month
    try:
        write_partitioned(o, path, ["yyyymm"], sort_cols=["dt", "user_id", "order_id"])
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    month = sorted(Path(path).glob("yyyymm=*"))[5]
    ranges = []
    for f in sorted(month.glob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        col = [meta.schema.column(i).name for i in range(meta.num_columns)].index("dt")
        st = meta.row_group(0).column(col).statistics
        ranges.append((st.min, st.max))
    assert len(ranges) > 1
    ranges.sort()
    # files of one month hold disjoint, ordered date ranges (min/max skipping works)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    pruned = spark.read.parquet(path).filter(F.col("yyyymm") == 199703)
    assert "PartitionFilters: [isnotnull(yyyymm" in pruned._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_l13_repartition_coalesce_file_count(spark):
    df = spark.range(1000).repartition(20)
    assert df.rdd.getNumPartitions() == 20
    assert with_file_count(df, 2).rdd.getNumPartitions() == 2
    out = tmp() + "/six"
    distribute(spark.range(1000), 6).write.parquet(out)
    assert len(list(Path(out).glob("*.parquet"))) == 6
    by_key = distribute(spark.range(1000).withColumn("k", F.col("id") % 3), 4, "k")
    parts = rows_per_partition(by_key).collect()
    assert sum(r.rows_cnt for r in parts) == 1000


def test_l15_cache_is_released(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    with cached(df) as c:
        assert c.is_cached and c.count() == 100
    assert not df.is_cached


def test_l5_l6_full_refresh_and_copy(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stg")
    spark.sql("DROP TABLE IF EXISTS stg.copy_src")
    spark.sql("DROP TABLE IF EXISTS stg.copy_dst")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.saveAsTable(
        "stg.copy_src", path=tmp() + "/src")
    spark.sql(f"CREATE TABLE stg.copy_dst (id INT, v STRING) USING parquet LOCATION '{tmp()}/dst'")
    copy_table(spark, "stg.copy_src", "stg.copy_dst")
    copy_table(spark, "stg.copy_src", "stg.copy_dst")
    assert spark.table("stg.copy_dst").count() == 4
    copy_table(spark, "stg.copy_src", "stg.copy_dst", overwrite=True)  # truncate + insert
    assert spark.table("stg.copy_dst").count() == 2
    t = VersionedTable(spark, tmp() + "/t", schema="id int")
    t.overwrite(spark.createDataFrame([(1,), (2,)], "id int"))
    t.overwrite(spark.createDataFrame([(3,)], "id int"))
    assert [r.id for r in t.read().collect()] == [3]


def test_l17_layers_created_idempotently(spark):
    assert S.create_layers(spark) == ["raw", "stg", "ods", "mart"]
    S.create_layers(spark)
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"raw", "stg", "ods", "mart"} <= names


def test_o4_inspect_takes_only_n(spark):
    schema, rows = inspect(spark.range(10 ** 6), 3)
    assert schema == "struct<id:bigint>" and [r.id for r in rows] == [0, 1, 2]


def test_m10_second_run_changes_nothing(spark):
    root = tmp() + "/lake"
    stamps = lambda: {str(p): p.stat().st_mtime_ns for layer in ("ods", "mart") for p in Path(f"{root}/{layer}").rglob("*.parquet")}
    rows = lambda t: sorted(tuple(r) for r in t.collect())
    first = layers.run_layers(spark, "/root/testdata/sf0.001", root, "2026-05-20")
    assert first.written[("ods", "orders")] == first[("ods", "orders")].count()
    orders, before = rows(first[("ods", "orders")]), stamps()
    frames = layers.run_layers(spark, "/root/testdata/sf0.001", root, "2026-05-20")
    assert stamps() == before and set(frames.written.values()) == {0}   # the re-run wrote nothing
    assert rows(frames[("ods", "orders")]) == orders
    assert frames[("stg", "orders_rejects")].count() == 0
    assert frames[("raw", "orders")].count() == frames[("ods", "orders")].count()


def test_m10_changed_rows_touch_their_groups_only(spark):
    from lakemart.bindings import ViewSet

    root = tmp() + "/lake"
    tables = {e.source: spark.read.parquet(f"/root/testdata/sf0.001/{e.source}.parquet") for e in layers.ENTITIES}
    layers.run_layers(spark, ViewSet(tables), root, "2026-05-20")
    lines = {p: p.stat().st_mtime_ns for p in Path(f"{root}/ods/order_items").glob("*.parquet")}
    keys = [r[0] for r in tables["orders"].filter("o_orderstatus = 'F'").orderBy("o_orderkey").limit(3).collect()]
    changed = tables["orders"].withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey").isin(keys), 7).otherwise(0))
    run = layers.run_layers(spark, ViewSet({**tables, "orders": changed}), root, "2026-05-21")
    assert run.written[("ods", "orders")] == 3 and run.written[("mart", "order_status_stats")] == 1
    assert 1 <= run.written[("mart", "segment_revenue")] <= 3
    assert run.written[("ods", "users")] == run.written[("ods", "order_items")] == run.written[("mart", "category_units")] == 0
    assert {p: p.stat().st_mtime_ns for p in Path(f"{root}/ods/order_items").glob("*.parquet")} == lines
    # A group that loses its last row goes.
    none = tables["orders"].withColumn("o_orderstatus", F.lit("F"))
    run = layers.run_layers(spark, ViewSet({**tables, "orders": none}), root, "2026-05-22")
    assert [r.status_code for r in run[("mart", "order_status_stats")].collect()] == ["F"]
    assert run.written[("mart", "order_status_stats")] == tables["orders"].select("o_orderstatus").distinct().count()


def test_sizing_for_large_inputs():
    conf = S.sizing(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert S.sizing(10 << 20, 8)["spark.sql.shuffle.partitions"] == "24"


def test_bucketed_write_one_file_per_bucket(spark):
    from lakemart.operators.layout import write_bucketed

    path = tmp() + "/b"
    df = spark.range(5000).withColumn("k", F.col("id") % 97).repartition(13)
    t = write_bucketed(df, "bucket_files_demo", "k", 8, path)
    files = [f for f in Path(path).glob("*.parquet")]
    assert len(files) == 8 and t.count() == 5000


def test_compact_files_follow_the_bytes(spark):
    from lakemart.operators.layout import compact_files

    path = tmp() + "/t"
    compact_files(spark.range(1000).repartition(40)).write.parquet(path)
    assert len(spark.read.parquet(path).inputFiles()) == 1 and spark.read.parquet(path).count() == 1000
