"""Scalar functions (P2–P15) on edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart.functions import scalars as fx
from lakemart.operators.casting import typed_projection


def one(spark, expr, schema="x string", rows=(("",),)):
    return spark.createDataFrame(list(rows), schema).select(expr.alias("v")).collect()


def test_day_range_is_half_open(spark):
    rows = [(dt.datetime(2026, 1, 14, 0, 0),), (dt.datetime(2026, 1, 14, 23, 59, 59),), (dt.datetime(2026, 1, 15),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert df.filter(fx.day_range(F.col("ts"), "2026-01-14")).count() == 2


def test_month_start_and_yyyymm(spark):
    r = spark.createDataFrame([(dt.date(2026, 5, 21),)], "d date").select(
        fx.month_start(F.col("d")).alias("m"), fx.yyyymm(F.col("d")).alias("n")).first()
    assert r.m == dt.date(2026, 5, 1) and r.n == 202605


def test_best_effort_timestamp_parse(spark):
    rows = [("2026-05-01T10:15:00Z",), ("2026-05-01 10:15:00",), ("2026-05-01",), ("not a date",)]
    got = [r.v for r in one(spark, fx.parse_timestamp_any(F.col("x"), fx.TIMESTAMP_FORMATS), rows=rows)]
    assert got[0] is not None and got[1] is not None and got[2] is not None and got[3] is None


def test_email_domain_and_size_label(spark):
    assert one(spark, fx.email_domain(F.col("x")), rows=[("a.b@shop.example",)])[0].v == "shop.example"
    labels = [r.v for r in one(spark, fx.size_label(F.col("x").cast("decimal(12,2)")),
                               rows=[("99999.99",), ("100000",), ("299999.99",), ("300000",)])]
    assert labels == ["small", "medium", "medium", "large"]


def test_safe_pct_guards_zero(spark):
    got = spark.createDataFrame([(5, 0), (5, 20)], "a int, b int").select(
        fx.safe_pct(F.col("a"), F.col("b")).alias("p")).collect()
    assert got[0].p is None and got[1].p == 25.0


def test_first_or_default_on_empty_and_null(spark):
    df = spark.createDataFrame([(["x", "y"],), ([],), (None,)], "a array<string>")
    assert [r.v for r in df.select(fx.first_or_default(F.col("a"), "unknown").alias("v")).collect()] == [
        "x", "unknown", "unknown"]


def test_clean_and_bad_partition_the_input_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, None), (None, None), (-1.0, 2.0)], "d double, t double")
    clean = fx.is_clean("d", "t")
    n_clean, n_bad = df.filter(clean).count(), df.filter(fx.is_bad(clean)).count()
    assert (n_clean, n_bad) == (1, 4) and n_clean + n_bad == df.count()
    loose = fx.is_clean("d", "t", mode="or")
    assert df.filter(loose).count() == 4  # the looser form overlaps with bad rows


def test_typed_projection_counts_rejects(spark):
    raw = spark.createDataFrame([("1", "2.50", "2026-05-01"), ("x", "abc", "2026-13-40")],
                                "id string, amount string, d string")
    out = typed_projection(raw, {"id": "bigint", "amount": "decimal(12,2)", "d": "date"}).collect()
    assert out[0]._bad_fields == 0 and out[0].id == 1
    assert out[1]._bad_fields == 3 and out[1].id is None


def test_json_member(spark):
    assert one(spark, fx.json_member(F.col("x"), "$.k", "int"), rows=[('{"k": 69}',)])[0].v == 69


def test_iso_instants_keep_their_offset(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = [("2026-05-01T10:15:00Z",), ("2026-05-01T13:15:00+03:00",), ("2026-05-01T10:15:00.250Z",)]
        got = spark.createDataFrame(rows, "x string").select(
            F.unix_timestamp(fx.parse_timestamp_any(F.col("x"), fx.TIMESTAMP_FORMATS)).alias("s")).collect()
        want = int(dt.datetime(2026, 5, 1, 10, 15, tzinfo=dt.timezone.utc).timestamp())
        assert [r.s for r in got] == [want, want, want]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
