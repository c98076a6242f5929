"""Work per task and bytes moved that must not follow the size of the input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakemart import session
from lakemart.bindings import ViewSet
from lakemart.operators import loads
from lakemart.operators.keyed import BucketTable
from lakemart.operators.loads import DuplicateKeyError
from lakemart.plans import landing, layers, marts, order_analysis
from lakemart.sources import api, sinks
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


# ---- documents -------------------------------------------------------------


def test_line_text_is_made_behind_the_shuffle(spark):
    text = executed(landing.order_document_text(spark, SF_SMALL))
    below = text[text.index("collect_list"):]
    assert "unit_price" not in below.split("partial_collect_list")[1]


def test_equal_lines_keep_the_order_of_their_text(spark):
    views = ViewSet(
        products=spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, "ab")], "product_id bigint, category string"),
        order_items=spark.createDataFrame([(5, 1, 1, 2, 3), (5, 0, 1, 2, None)], "order_id bigint, line_no int, product_id bigint, quantity int, price int"),
        orders=spark.createDataFrame([(5, 1, "paid", 9)], "order_id bigint, user_id bigint, status string, amount int").withColumn(
            "order_date", F.lit("2026-01-01").cast("date")),
        users=spark.createDataFrame([(1, "X")], "user_id bigint, city string"))
    value = landing.order_document_text(spark, views).first().value
    items = value.split('"items":[')[1]
    paths = [x.split("}")[0] for x in items.split('"category_path":')[1:]]
    assert paths == ['["a"]', '["ab"]', '["b"]', "[]"]


@pytest.mark.parametrize("land", [sinks.land_payloads, sinks.land_raw])
def test_one_day_lands_where_it_is(spark, tmp_path, land):
    lines = spark.range(40).repartition(4).select(F.col("id").cast("string").alias("value"), F.lit("2026-01-02").cast("date").alias("dt"))
    for _ in range(2):
        path = land(lines, str(tmp_path / "lake"), "shop", "lines", one_day=True)
    day = f"{path}/dt=2026-01-02"
    assert len([f for f in os.listdir(day) if f.startswith("part-")]) == 4


def test_no_events_no_payloads(spark):
    empty = spark.createDataFrame([], "event_id bigint, user_id bigint, event_type string, props string, ts timestamp_ntz")
    assert landing.raw_payload_digests(spark, ViewSet(events=empty)).collect() == []


# ---- keyed loads -----------------------------------------------------------

WIDE = "k bigint, a string, b string, n int, d decimal(9,2), at timestamp_ntz, s struct<x: string>, f double"


def test_loads_compare_digests_not_texts(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], WIDE, buckets=4)
    base = [(1, "x", "yz", 1, None, None, ("q",), 0.5), (2, "xy", "z", 1, None, None, None, None), (3, None, "", 1, None, None, None, None),
            (None, "", None, None, None, None, None, None)]
    assert t.upsert(spark.createDataFrame(base, WIDE)) == 4 and not os.listdir(tmp_path / "pending")
    assert t.upsert(spark.createDataFrame(base, WIDE)) == 0
    moved = [(1, "xy", "z", 1, None, None, ("q",), 0.5), (2, "xy", "z", 1, None, None, None, None), (3, "", None, 1, None, None, None, None),
             (None, None, "", None, None, None, None, None)]
    assert t.upsert(spark.createDataFrame(moved, WIDE)) == 3
    assert rows(t.read()) == sorted(map(tuple, spark.createDataFrame(moved, WIDE).collect()), key=repr)
    last = [(1, "xy", "z", 1, None, None, ("p",), 0.5), (2, "xy", "z", 1, None, None, None, 1.0), *moved[2:]]
    batch = t.bucketed(spark.createDataFrame(last, WIDE))
    keys = t.changed_keys(batch)
    assert rows(keys) == [(1,), (2,)]
    below = executed(keys).split("Exchange")[0]
    assert keys.columns == ["k"] and "_digest" in below


def test_first_load_is_checked_before_it_counts(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], "k bigint, v string", buckets=2)
    with pytest.raises(DuplicateKeyError):
        t.upsert(spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, v string"))
    assert not os.path.exists(t.data) and not os.listdir(t.pending)
    assert t.upsert(spark.createDataFrame([(1, "a")], "k bigint, v string")) == 1
    assert not list(tmp_path.glob("_staging*"))


def test_rows_of_one_partition_do_not_meet_in_a_task(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.range(100).selectExpr("id % 3 as p", "id as k", "1 as v").write.partitionBy("p").parquet(str(tmp_path / "t"))
        target = spark.read.parquet(str(tmp_path / "t"))
        batch = spark.range(50).selectExpr("id % 3 as p", "id as k", "2 as v")
        assert "BroadcastHashJoin" in plan(loads.touched_partitions(target, batch, ["p"]))
        monkeypatch.setattr(loads, "PARTITION_PIECE_BYTES", 100)
        loads.upsert_partitioned(spark, str(tmp_path / "t"), batch, ["p", "k"], ["p"], str(tmp_path / "stage"))
        got = spark.read.parquet(str(tmp_path / "t")).select("p", "k", "v")
        assert rows(got) == sorted(((k % 3, k, 2 if k < 50 else 1) for k in range(100)), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- parts by the files read ------------------------------------------------


@pytest.mark.parametrize("query", [marts.region_category_revenue, order_analysis.dominant_category, order_analysis.basket_diversity])
def test_parts_follow_the_files_read(spark, monkeypatch, query):
    want = rows(query(spark, SF_SMALL))
    assert "REPARTITION_BY_NUM" not in executed(query(spark, SF_SMALL))
    monkeypatch.setattr(session, "PART_BYTES", 2000)
    many = query(spark, SF_SMALL)
    assert "REPARTITION_BY_NUM" in executed(many)
    assert rows(many) == want


# ---- pages ------------------------------------------------------------------


def test_tasks_do_not_follow_the_pages(spark, tmp_path):
    table = spark.range(2000).selectExpr("id", "concat('t', id) as title", "id / 2.0D as price", "id as stock")
    url = api.write_pages(table, str(tmp_path), "id", 3)
    api.register(spark)
    read = lambda **o: spark.read.format("paged_api").options(url=url, limit=9, max_tasks=7, **o).load()
    reader = api.PagedApiReader(read().schema, {"url": url, "limit": 9, "max_tasks": 7})
    assert len(reader.partitions()) == 7
    windows = [w for p in reader.partitions() for w in p.windows()]
    assert windows == api.plan_windows(2000, 9, None)
    assert rows(read()) == rows(table)
    assert read(max_rows=1000).count() == 1000


# ---- layers -----------------------------------------------------------------


@pytest.mark.parametrize("bad", [0, 2])
def test_rejects_are_read_again_only_where_there_are_some(spark, tmp_path, monkeypatch, bad):
    source = spark.createDataFrame([(str(k), "x" if k < bad else "1.5") for k in range(6)], "a string, b string")
    e = layers.Entity("things", "things", {"a": ("k", "bigint"), "b": ("price", "decimal(12,2)")})
    digests = []
    monkeypatch.setattr(layers, "bag_digest", lambda df, was=layers.bag_digest: digests.append(1) or was(df))
    for run in (1, 2):
        loaded = layers.load_entity(spark, source, e, str(tmp_path), layers.RUN_DATE)
        assert loaded[("stg", "things")].count() == 6 - bad
        assert loaded[("stg", "things_rejects")].columns == ["k", "price", "_bad_fields"]
        assert loaded[("stg", "things_rejects")].count() == bad
        assert loaded.written[("ods", "things")] == (6 - bad if run == 1 else 0)
    assert len(digests) == 2     # the first load has nothing to compare with
