"""Physical-plan assertions (the automated form of the lab questions)."""

from __future__ import annotations

import re

import pytest

from lakemart.plans import joins as J
from lakemart.plans import lake as L
from lakemart.plans import marts as M
from lakemart.plans import scalars as P
from lakemart.plans import windows as W

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def optimized_physical(df) -> str:
    """Initial physical plan (before AQE re-planning)."""
    qe = df._jdf.queryExecution()  # noqa: SLF001
    return qe.sparkPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    if old_aqe is None:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    else:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)


def test_flagship_prunes_columns_and_broadcasts_bounded_dims(spark):
    text = optimized_physical(M.region_category_revenue(spark, SF))
    assert "BroadcastHashJoin" in text  # nation / region are size-checked and broadcast
    assert "l_shipdate" not in text.split("lineitem")[0] or "ReadSchema" in text
    full = M.region_category_revenue(spark, SF)._jdf.queryExecution().toString()  # noqa: SLF001
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in \
        M.region_category_revenue(spark, SF)._jdf.queryExecution().explainString(  # noqa: SLF001
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))  # noqa: SLF001
    assert full


def test_day_filter_pushes_range(spark):
    text = optimized_physical(P.day_filter(spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_status_filter_reaches_the_scan(spark):
    from lakemart.plans import aggregates as A

    text = optimized_physical(A.paid_revenue(spark, SF))
    assert "EqualTo(o_orderstatus,F)" in text


def test_partition_filter_prunes_directories(spark):
    text = optimized_physical(L.partition_pruned_read(spark, SF))
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "event_date#" in text and ">= 2024-01-10" in text


def test_first_per_group_uses_window_group_limit(spark):
    text = optimized_physical(W.city_top_order(spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in optimized_physical(W.top_5_prices(spark, SF))


def test_bucketed_join_has_no_exchange_before_join(spark, no_auto_broadcast):
    df = J.city_orders_bucketed(spark, SF)
    text = optimized_physical(df)
    assert "SortMergeJoin" in text
    join_part = text[text.index("SortMergeJoin"):]
    assert "Exchange" not in join_part  # both sides read buckets as they are


def test_sort_merge_join_by_hint(spark):
    from lakemart import bindings as b

    o = b.orders(spark, SF).select("order_id", "user_id")
    u = b.users(spark, SF).select("user_id", "city")
    text = optimized_physical(o.join(u.hint("merge"), "user_id"))
    # the hinted join is a sort-merge join (users itself broadcasts nation)
    assert text.lstrip().split("\n")[0].find("SortMergeJoin") >= 0 or "SortMergeJoin [user_id" in text


def test_broadcast_by_hint(spark):
    text = optimized_physical(J.events_typed_dict(spark, SF))
    assert "BroadcastHashJoin" in text


def test_anti_join_is_not_null_aware(spark):
    text = optimized_physical(J.paid_not_created_users(spark, SF))
    assert "LeftAnti" in text and "BroadcastNestedLoopJoin" not in text


def test_salted_join_splits_hot_key(spark):
    text = optimized_physical(J.skew_join_salted(spark, SF))
    assert "__salt" in text


def test_aqe_coalesces_small_shuffle_partitions(spark):
    """120,000 rows grouped by 10,000 keys with 200 shuffle partitions:
    adaptive execution coalesces them to a few at run time."""
    from pyspark.sql import functions as F

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        orders = spark.range(120_000).select((F.col("id") % 10_000).alias("customer_id"))
        per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        assert per_customer.count() == 10_000
        per_customer.collect()
        final = per_customer._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        assert "isFinalPlan=true" in final and "AQEShuffleRead coalesced" in final
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        fixed = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        assert fixed.rdd.getNumPartitions() == 200
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_correlated_subquery_is_decorrelated(spark):
    text = optimized_physical(J.user_paid_count_sql(spark, SF))
    assert "Join" in text and "Subquery" not in text


@pytest.mark.parametrize("query", [J.user_paid_count_sql, W.city_top_order_sql])
def test_sql_forms_push_the_status_filter(spark, query):
    text = optimized_physical(query(spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*o_orderstatus[^\]]*F", text)


def test_sql_top1_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in optimized_physical(W.city_top_order_sql(spark, SF))


def test_mapjoin_hint_in_sql_broadcasts(spark, no_auto_broadcast):
    text = optimized_physical(J.events_typed_dict_sql(spark, SF))
    assert "BroadcastHashJoin" in text
