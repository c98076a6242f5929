"""Keyed loads: idempotence, duplicate handling, model checks."""

from __future__ import annotations

import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from lakemart.operators.loads import (
    DuplicateKeyError, SummingTable, UnknownColumnError, VersionedTable, first_per_key, latest_per_key,
    touched_partitions, upsert_partitioned,
)
from lakemart.plans.lake import load_dimension_keys

SCHEMA = "k bigint, v string, ver int"


def fresh():
    return tempfile.mkdtemp(prefix="lakemart-test-")


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_if_absent_first_row_wins_and_is_idempotent(spark):
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    batch = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, "x", 1)], SCHEMA)
    assert t.insert_if_absent(batch, ["k"]) == 2
    assert as_set(t.read()) == [(1, "a", 2), (2, "x", 1)]  # smallest row under all columns
    assert t.insert_if_absent(batch, ["k"]) == 0
    assert t.current_version() == 1
    more = spark.createDataFrame([(2, "zz", 9), (3, "c", 1)], SCHEMA)
    assert t.insert_if_absent(more, ["k"]) == 1
    assert as_set(t.read()) == [(1, "a", 2), (2, "x", 1), (3, "c", 1)]


def test_upsert_rejects_duplicate_keys_without_order(spark):
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    t.overwrite(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    dup = spark.createDataFrame([(1, "b", 2), (1, "c", 3)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        t.upsert(dup, ["k"])
    t.upsert(dup, ["k"], order=[F.col("ver")])
    assert as_set(t.read()) == [(1, "c", 3)]


def test_upsert_empty_batch_is_noop(spark):
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    t.overwrite(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    v = t.current_version()
    t.upsert(spark.createDataFrame([], SCHEMA), ["k"])
    assert t.current_version() == v


def test_upsert_matches_python_model(spark):
    rng = random.Random(7)
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    model: dict[int, tuple] = {}
    for step in range(4):
        keys = rng.sample(range(20), 8)
        rows = [(k, f"s{step}-{k}", step) for k in keys]
        t.upsert(spark.createDataFrame(rows, SCHEMA), ["k"])
        for r in rows:
            model[r[0]] = r
        assert as_set(t.read()) == sorted(model.values())


def test_uncommitted_version_is_ignored(spark):
    root = fresh() + "/t"
    t = VersionedTable(spark, root, schema=SCHEMA)
    t.overwrite(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    # a half-written next version (no _SUCCESS) must not be read
    spark.createDataFrame([(9, "z", 9)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v=000002")
    assert t.current_version() == 1
    assert as_set(t.read()) == [(1, "a", 1)]


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 3), (2, "x", 1)], SCHEMA)
    assert as_set(latest_per_key(df, ["k"], ["ver"])) == [(1, "c", 3), (2, "x", 1)]
    assert as_set(first_per_key(df, ["k"], [F.col("ver")])) == [(1, "a", 1), (2, "x", 1)]


def test_summing_table_adds_batches_and_replays_count_once(spark):
    t = SummingTable(spark, fresh() + "/s", ["k"], ["n"])
    d = spark.createDataFrame([(1, 2), (2, 5), (1, 1), (None, 4)], "k bigint, n bigint")
    t.add(d)
    t.add(d)
    want = {1: 6, 2: 10, None: 8}
    assert {r.k: r.n for r in t.read_summed().collect()} == want
    for batch_id in (999_999, 1_000_000, 1_000_000):   # no bound on ids; a replay replaces its batch
        t.add(d, batch_id)
    assert {r.k: r.n for r in t.read_summed().collect()} == {k: 2 * n for k, n in want.items()}


def test_versions_past_six_digits(spark):
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    for v in (999_999, 1_000_000):
        spark.createDataFrame([(v, "a", 1)], SCHEMA).write.parquet(t.path(v))
    assert t.current_version() == 1_000_000
    assert t.commit(spark.createDataFrame([(7, "b", 1)], SCHEMA)) == 1_000_001
    assert as_set(t.read()) == [(7, "b", 1)]


def test_null_keys_match_null_keys(spark):
    batch = spark.createDataFrame([(None, "a", 1), (1, "b", 1)], SCHEMA)
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    assert [t.insert_if_absent(batch, ["k"]) for _ in range(2)] == [2, 0]
    t.upsert(batch, ["k"])
    t.upsert(spark.createDataFrame([(None, "c", 2)], SCHEMA), ["k"])
    assert {(r.k, r.v) for r in t.read().collect()} == {(None, "c"), (1, "b")} and t.read().count() == 2


def test_unknown_columns_are_rejected(spark):
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    wide = spark.createDataFrame([(1, "a", 1, "x")], SCHEMA + ", extra string")
    for load in (t.upsert, t.insert_if_absent):
        with pytest.raises(UnknownColumnError):
            load(wide, ["k"])


def test_partition_scoped_upsert_rejects_what_it_cannot_place(spark):
    root, schema = fresh(), "dt string, k bigint, v string"
    rows = [("d1", 1, "a"), ("d1", None, "n")]
    upsert_partitioned(spark, f"{root}/t", spark.createDataFrame(rows, schema), ["dt", "k"], ["dt"], f"{root}/s")
    for bad, error in (([(None, 3, "c")], ValueError), ([("d1", 1, "x"), ("d1", 1, "y")], DuplicateKeyError)):
        with pytest.raises(error):
            upsert_partitioned(spark, f"{root}/t", spark.createDataFrame(bad, schema), ["dt", "k"], ["dt"], f"{root}/s")
    with pytest.raises(UnknownColumnError):
        wide = spark.createDataFrame([("d1", 1, "x", 2)], schema + ", extra int")
        upsert_partitioned(spark, f"{root}/t", wide, ["dt", "k"], ["dt"], f"{root}/s")
    upsert_partitioned(spark, f"{root}/t", spark.createDataFrame([("d1", None, "m")], schema), ["dt", "k"], ["dt"], f"{root}/s")
    assert {(r.dt, r.k, r.v) for r in spark.read.parquet(f"{root}/t").collect()} == {("d1", 1, "a"), ("d1", None, "m")}


def test_partition_scoped_upsert_touches_only_batch_partitions(spark):
    root = fresh()
    path, schema = f"{root}/t", "dt string, k bigint, v string"
    base = spark.createDataFrame([("d1", 1, "a"), ("d1", 2, "b"), ("d2", 1, "c")], schema)
    upsert_partitioned(spark, path, base, ["dt", "k"], ["dt"], f"{root}/stage1")
    batch = spark.createDataFrame([("d1", 2, "B"), ("d1", 3, "N")], schema)
    upsert_partitioned(spark, path, batch, ["dt", "k"], ["dt"], f"{root}/stage2")
    got = sorted((r.dt, r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("d1", 1, "a"), ("d1", 2, "B"), ("d1", 3, "N"), ("d2", 1, "c")]


def test_dimension_ids_are_dense_and_continue(spark):
    t = VersionedTable(spark, fresh() + "/d", schema="key bigint, sk bigint")
    load_dimension_keys(t, spark.range(0, 50).withColumnRenamed("id", "key"), "key", "sk")
    load_dimension_keys(t, spark.range(40, 75).withColumnRenamed("id", "key"), "key", "sk")
    rows = {r.key: r.sk for r in t.read().collect()}
    assert sorted(rows.values()) == list(range(1, 76))
    assert all(rows[k] == k + 1 for k in range(50))  # first load numbered in key order


def test_listing_without_jvm_gateway(tmp_path):
    from lakemart.operators.loads import list_dirs, path_exists

    class NoGateway:  # a session object without a JVM gateway (Spark Connect)
        pass

    (tmp_path / "t" / "v=000001").mkdir(parents=True)
    (tmp_path / "t" / "v=000001" / "_SUCCESS").write_text("")
    s = NoGateway()
    assert path_exists(s, str(tmp_path / "t" / "v=000001" / "_SUCCESS"))
    assert not path_exists(s, str(tmp_path / "nope"))
    assert list_dirs(s, str(tmp_path / "t")) == ["v=000001"]
    assert list_dirs(s, str(tmp_path / "nope")) == []


def test_insert_if_absent_matches_python_model(spark):
    rng = random.Random(11)
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    model: dict[int, tuple] = {}
    for step in range(4):
        rows = [(rng.randrange(15), rng.choice("abcd"), rng.randrange(5)) for _ in range(10)]
        inserted = t.insert_if_absent(spark.createDataFrame(rows, SCHEMA), ["k"])
        firsts = {}
        for r in sorted(rows):  # first row per key under all columns
            firsts.setdefault(r[0], r)
        new = {k: r for k, r in firsts.items() if k not in model}
        model.update(new)
        assert inserted == len(new)
        assert as_set(t.read()) == sorted(model.values())


def test_latest_per_key_matches_python_model(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(8), rng.choice("xyz"), rng.randrange(4)) for _ in range(60)]
    model = {}
    for r in rows:
        cur = model.get(r[0])
        if cur is None or (r[2], r) > (cur[2], cur):
            model[r[0]] = r
    got = as_set(latest_per_key(spark.createDataFrame(rows, SCHEMA), ["k"], ["ver"]))
    assert got == sorted(model.values())


def test_summing_table_matches_python_model(spark):
    rng = random.Random(3)
    t = SummingTable(spark, fresh() + "/s", ["k"], ["n"])
    model: dict[int, int] = {}
    for step in range(5):
        rows = [(rng.randrange(6), rng.randrange(1, 9)) for _ in range(12)]
        t.add(spark.createDataFrame(rows, "k bigint, n bigint"))
        for k, n in rows:
            model[k] = model.get(k, 0) + n
        assert dict((r.k, r.n) for r in t.read_summed().collect()) == model


def test_partition_scoped_upsert_reads_only_touched_partitions(spark):
    root = fresh()
    df = spark.range(1000).select((F.col("id") % 20).cast("int").alias("dt"), F.col("id").alias("k"))
    df.write.partitionBy("dt").parquet(f"{root}/t")
    batch = spark.createDataFrame([(3, 1), (7, 2), (7, 3)], "dt int, k bigint")
    pruned = touched_partitions(spark.read.parquet(f"{root}/t"), batch, ["dt"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    filters = re.search(r"PartitionFilters: \[(.*?)\], ", plan).group(1)
    assert ">= 3" in filters and "<= 7" in filters and "dynamicpruning" in filters
    assert pruned.count() == 100


def test_vacuum_keeps_current_reads(spark):
    t = VersionedTable(spark, fresh() + "/t", schema=SCHEMA)
    for i in range(4):
        t.overwrite(spark.createDataFrame([(i, "v", i)], SCHEMA))
    assert t.vacuum(keep=2) == [1, 2]
    assert t.versions() == [3, 4] and as_set(t.read()) == [(3, "v", 3)]
