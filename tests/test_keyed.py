"""Bucketed keyed tables, appended dimensions and co-located layouts."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.operators.keyed import BucketTable, Dimension, load_keyed
from lakemart.operators.layout import CoLocated, numbered_rows
from lakemart.operators.loads import DuplicateKeyError, UnknownColumnError
from lakemart.session import bucket_count, input_bytes

SCHEMA = "k bigint, v string, n int"


def files(root) -> dict[str, tuple]:
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(root).rglob("*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_small_upsert_rewrites_only_its_buckets(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], SCHEMA, buckets=64)
    base = spark.range(5000).selectExpr("id as k", "'a' as v", "1 as n")
    assert t.upsert(base) == 5000
    before = files(tmp_path / "data")
    batch = spark.range(4990, 5010).selectExpr("id as k", "'b' as v", "2 as n")      # 10 known, 10 new
    touched = {r[0] for r in t.bucketed(batch).select(t.column).collect()}
    assert t.upsert(batch) == 20
    after = files(tmp_path / "data")
    kept = {p for p in before if int(p.split(f"{t.column}=")[1].split("/")[0]) not in touched}
    assert 0 < len(kept) and {p: after.get(p) for p in kept} == {p: before[p] for p in kept}
    assert not (set(before) - kept) & set(after)                                    # the others are new files
    assert t.read().filter("v = 'b'").count() == 20 and t.read().count() == 5010
    assert t.upsert(batch) == 0 and files(tmp_path / "data") == after               # nothing to change, nothing written
    mixed = batch.withColumn("v", F.when(F.col("k") == 4995, "c").otherwise(F.col("v")))
    assert t.upsert(mixed) == 1
    assert len(set(files(tmp_path / "data")) - set(after)) == 1
    assert not os.listdir(tmp_path / "pending") and not list(tmp_path.glob("_staging*"))


def test_upsert_reads_only_its_buckets(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], SCHEMA, buckets=32)
    t.upsert(spark.range(1000).selectExpr("id as k", "'a' as v", "1 as n"))
    one = t.bucketed(spark.createDataFrame([(7, "x", 1)], SCHEMA))
    plan = t._in_buckets_of(one)._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "PartitionFilters: [isnotnull(bucket_of_32" in plan


@pytest.mark.parametrize("load", ["upsert", "insert_if_absent"])
def test_loads_match_a_model(spark, tmp_path, load):
    rng, model = random.Random(3), {}
    for step in range(5):
        t = BucketTable(spark, str(tmp_path), ["k"], SCHEMA, buckets=4 + step)      # it keeps the first number
        assert t.buckets == 4
        batch = [(rng.choice([None, *range(12)]), rng.choice("ab"), rng.randrange(3)) for _ in range(8)]
        frame = spark.createDataFrame(batch, SCHEMA)
        if load == "upsert":
            new = {}
            for r in sorted(batch, key=lambda r: (r[2], r[0] is not None, r[0] or 0, r[1])):
                new[r[0]] = r
            assert t.upsert(frame, order=[F.col("n")]) == sum(model.get(k) != r for k, r in new.items())
            model.update(new)
        else:
            new = {}
            for r in sorted(batch, key=lambda r: r[1:]):
                new.setdefault(r[0], r)
            assert t.insert_if_absent(frame) == sum(k not in model for k in new)
            model = {**new, **model}
        assert rows(t.read()) == sorted(model.values(), key=repr)


def test_what_a_table_rejects(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        t.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 1)], SCHEMA))
    for call in (t.upsert, t.insert_if_absent):
        with pytest.raises(UnknownColumnError):
            call(spark.createDataFrame([(1, "a", 1, 1)], SCHEMA + ", x int"))
        with pytest.raises(ValueError):
            call(spark.createDataFrame([(1, "a", 1)], SCHEMA), ["v"])
    assert t.read().count() == 0 == t.upsert(spark.createDataFrame([], SCHEMA))
    assert t.compact() == []


def test_a_cut_off_swap_is_finished_by_the_next_load(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], SCHEMA, buckets=3)
    t.upsert(spark.createDataFrame([(k, "a", 1) for k in range(30)], SCHEMA))
    # The writer died between deleting a bucket and putting its new rows there.
    lost = t._stored().filter(f"{t.column} = 1").withColumn("v", F.lit("b"))
    lost.write.parquet(f"{t.pending}/full")
    n = lost.count()
    spark.createDataFrame([(99, "z", 1)], SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{t.pending}/half")
    for p in (tmp_path / "data" / f"{t.column}=1").glob("*"):
        p.unlink()
    t.upsert(spark.createDataFrame([(100, "c", 1)], SCHEMA))
    assert t.read().count() == 31 and t.read().filter("v = 'b'").count() == n > 0
    assert not os.listdir(t.pending)


def test_appended_buckets_are_compacted(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path), ["k"], SCHEMA, buckets=2)
    for k in range(5):
        assert t.insert_if_absent(spark.createDataFrame([(k, "a", k), (k + 100, "b", k)], SCHEMA)) == 2
    want = rows(t.read())
    many = t.compact(files=3)
    assert many and rows(t.read()) == want
    per = {}
    for p in files(tmp_path / "data"):
        per[p.split("/")[-2]] = per.get(p.split("/")[-2], 0) + 1
    assert all(per[f"{t.column}={b}"] == 1 for b in many) and t.compact(files=3) == []


def test_generic_load_takes_its_columns_from_the_batch(spark, tmp_path):
    schema = "a int, b int, m map<string,int>, s struct<x: int>"
    batch = spark.createDataFrame([(1, None, {"q": 1}, (1,)), (1, 2, None, None)], schema)
    assert [load_keyed(spark, batch, str(tmp_path), ["a", "b"]) for _ in range(2)] == [2, 2]      # maps cannot be compared
    assert load_keyed(spark, batch.limit(0), str(tmp_path), ["a", "b"]) == 0
    assert BucketTable(spark, str(tmp_path), ["a", "b"]).read().count() == 2
    with pytest.raises(ValueError):
        BucketTable(spark, str(tmp_path / "none"), ["a"]).read()


def test_dimension_appends_and_numbers_on(spark, tmp_path):
    t = Dimension(spark, str(tmp_path), ["a", "b"], "sk", "sk bigint, a int, b string, v string")
    assert t.add(spark.createDataFrame([(2, "x", "p"), (1, None, "q"), (2, "x", "o")], "a int, b string, v string")) == 2
    first = files(tmp_path / "rows")
    more = spark.createDataFrame([(1, None, "other"), (0, "z", "r"), (3, "y", "s")], "a int, b string, v string")
    assert [t.add(more), t.add(more)] == [2, 0] and t.high_water_mark() == 4
    assert {p: x for p, x in files(tmp_path / "rows").items() if p in first} == first     # nothing rewritten
    assert rows(t.read().select("sk", "a", "b", "v")) == [(1, 1, None, "q"), (2, 2, "x", "o"), (3, 0, "z", "r"), (4, 3, "y", "s")]
    # A load that died before its mark does not count and is written again.
    spark.createDataFrame([(5, 9, "w", "w")], t.schema).write.parquet(f"{tmp_path}/rows/load=3")
    assert t.read().count() == 4
    assert t.add(spark.createDataFrame([(8, "n", "n")], "a int, b string, v string")) == 1
    assert rows(t.read().filter("sk > 4")) == [(5, 8, "n", "n")]
    with pytest.raises(UnknownColumnError):
        t.add(more.withColumn("extra", F.lit(1)))


def test_rows_are_numbered_across_partitions(spark):
    frame = spark.range(3000).selectExpr("pmod(id * 7919, 3000) as k", "id as v").repartition(6)
    got = {r.k: r.i for r in numbered_rows(frame, ["k"], "i", 11).collect()}
    assert got == {k: k + 11 for k in range(3000)}


def test_bucket_count_follows_the_files(spark, tmp_path):
    plain = spark.createDataFrame([(1, 2)], "a int, b int")
    assert bucket_count(spark, plain) == 8 and input_bytes(plain) == 0
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert input_bytes(t) == size and input_bytes(t.alias("x").join(plain, F.col("x.id") == plain.a)) == size
    assert input_bytes(t.join(t.withColumnRenamed("id", "j"), F.col("id") == F.col("j"))) == 2 * size


def monkeypatch_conf(spark, request, name, value):
    old = spark.conf.get(name)
    spark.conf.set(name, value)
    request.addfinalizer(lambda: spark.conf.set(name, old))


def test_hot_key_is_spread_and_results_are_equal(spark, tmp_path, request):
    left = spark.range(6000).selectExpr("if(id % 3 = 0, 5, if(id % 7 = 0, null, id)) as k", "id as v")
    right = spark.range(0, 6000, 2).selectExpr("id as k", "id * 2 as w").unionByName(
        spark.createDataFrame([(5, 1), (5, 2), (None, 3)], "k bigint, w bigint"))
    laid_out = CoLocated(left, right, "k", f"{tmp_path}/t-hot", 8, salts=6)
    assert laid_out.hot == [5]
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(laid_out.join(how)) == rows(left.join(right, "k", how))
    assert laid_out.left.filter("k = 5").isEmpty()
    # As on data too large to broadcast or to coalesce.
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        monkeypatch_conf(spark, request, name, value)
    assert laid_out.join().filter("k = 5").groupBy(F.spark_partition_id()).count().count() > 1
    none = CoLocated(left.filter("k is null or k <> 5"), right, "k", f"{tmp_path}/t-cold", 8)
    assert none.hot == [] and none.join().count() == left.filter("k <> 5").join(right, "k").count()
