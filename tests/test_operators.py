"""Operator edge cases: joins, division, mismatch, top-n, routing, histogram."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators.joins import all_members_match, mismatch_report, salted_join
from lakemart.operators.loads import month_ranges, route_by_ranges
from lakemart.operators.skew import key_histogram
from lakemart.operators.windows import top_n_per_group, trim_edges


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_salted_left_join_keeps_unmatched(spark):
    big = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (9, "z")], "k int, v string")
    small = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    got = rows(salted_join(big, small, "k", 4, how="left"), "k", "v", "name")
    assert got == [(1, "a", "one"), (1, "b", "one"), (1, "c", "one"), (2, "d", "two"), (9, "z", None)]


def test_relational_division(spark):
    members = spark.createDataFrame([("u1", True), ("u1", True), ("u2", True), ("u2", None), ("u3", None)],
                                    "g string, m boolean")
    got = rows(all_members_match(members, "g", F.col("m").isNotNull()), "g", "members", "matched")
    assert got == [("u1", 2, 2)]


def test_mismatch_report_both_sides_deduplicated(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(3,), (4,), (4,)], "k int")
    got = rows(mismatch_report(a, b, "k", "a", "b"), "k", "issue_type")
    assert got == [(1, "missing_in_b"), (2, "missing_in_b"), (4, "missing_in_a")]


def test_top_n_breaks_ties_by_order(spark):
    df = spark.createDataFrame([("x", 5, 1), ("x", 5, 2), ("x", 7, 3), ("y", 1, 4)], "g string, p int, id int")
    got = rows(top_n_per_group(df, ["g"], [F.col("p"), F.col("id")], 2), "g", "id", "rn")
    assert got == [("x", 1, 1), ("x", 2, 2), ("y", 4, 1)]


def test_trim_edges_small_input(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert rows(trim_edges(df, [F.col("k")], [F.col("k").desc()], "k", 2), "k") == [(2,)]
    assert trim_edges(df, [F.col("k")], [F.col("k").desc()], "k", 3).count() == 0


def test_route_by_ranges_half_open(spark):
    days = spark.createDataFrame([(dt.date(2026, 4, 30),), (dt.date(2026, 5, 1),), (dt.date(2026, 5, 31),),
                                  (dt.date(2026, 6, 1),), (dt.date(2026, 7, 1),)], "dt date")
    got = rows(route_by_ranges(days, "dt", month_ranges(spark, "2026-05-01", 2)), "dt", "partition_name")
    assert [p for _, p in got] == ["rejected", "p2026_05", "p2026_05", "p2026_06", "rejected"]


def test_key_histogram_shares(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "k string")
    got = {r.k: (r.rows_cnt, r.share) for r in key_histogram(df, "k").collect()}
    assert got == {"a": (6, 0.6), "b": (3, 0.3), "c": (1, 0.1)}


def test_dimension_composite_keys_dense(spark):
    import tempfile

    from lakemart.operators.loads import VersionedTable, load_dimension

    t = VersionedTable(spark, tempfile.mkdtemp() + "/d", schema="a int, b int, sk bigint, v string")
    batch = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (1, 2, "x2"), (0, 5, "z")], "a int, b int, v string")
    assert load_dimension(t, batch, ["a", "b"], "sk", ["v"]) == 3
    assert load_dimension(t, batch, ["a", "b"], "sk", ["v"]) == 0
    got = rows(t.read(), "a", "b", "sk", "v")
    assert got == [(0, 5, 1, "z"), (1, 1, 2, "y"), (1, 2, 3, "x")]
