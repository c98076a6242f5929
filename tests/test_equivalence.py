"""Tuned forms equal their plain forms (salted = plain, chunked windows =
plain windows, dense ids = row_number)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.aggregates import salted_aggregate
from lakemart.operators.layout import dense_ids
from lakemart.operators.skew import skewed_events
from lakemart.operators.windows import lag_by_date, running_total_by_date
from lakemart.plans import joins as J

SF = "/root/testdata/sf0.01"


def same(a, b2):
    return a.exceptAll(b2).isEmpty() and b2.exceptAll(a).isEmpty()


def test_salted_join_equals_plain(spark):
    assert same(J.skew_join_salted(spark, SF), J.plain_skew_join(spark, SF))


def test_salted_aggregate_equals_plain(spark):
    ev = skewed_events(b.events(spark, SF))
    salted = salted_aggregate(ev, "skew_key", 16, salt_by="source_user_id",
                              counts={"n": "*"}, sums={"v": "event_value"},
                              distinct_of={"u": "source_user_id"}).select(
        "skew_key", F.col("n").cast("bigint"), "v", F.col("u").cast("bigint"))
    plain = ev.groupBy("skew_key").agg(F.count(F.lit(1)).alias("n"), F.sum("event_value").alias("v"),
                                       F.countDistinct("source_user_id").alias("u"))
    assert same(salted, plain)


def test_hot_key_holds_most_rows(spark):
    ev = skewed_events(b.events(spark, SF))
    hot = ev.filter(F.col("skew_key") == "hot").count()
    assert hot / ev.count() == 0.8


def test_running_total_equals_range_window(spark):
    paid = b.orders(spark, SF, statuses=("paid",)).select("user_id", "order_date", "order_id", "amount")
    chunked = running_total_by_date(paid, "user_id", "order_date", "amount", "rt")
    plain = paid.withColumn("rt", F.sum("amount").over(Window.partitionBy("user_id").orderBy("order_date")))
    assert same(chunked.select(*plain.columns), plain)


def test_lag_by_date_equals_window_lag(spark):
    paid = b.orders(spark, SF, statuses=("paid",)).select("user_id", "order_date", "order_id", "amount")
    chunked = lag_by_date(paid, "user_id", "order_date", "order_id", "amount", "prev")
    plain = paid.withColumn("prev", F.lag("amount").over(
        Window.partitionBy("user_id").orderBy("order_date", "order_id")))
    assert same(chunked.select(*plain.columns), plain)


def test_dense_ids_equal_row_number(spark):
    keys = b.products(spark, SF).select("product_id")
    ids = dense_ids(keys, "product_id", "sk")
    plain = keys.withColumn("sk", F.row_number().over(Window.orderBy("product_id")).cast("bigint"))
    assert same(ids, plain)


def test_chunked_windows_keep_null_groups_and_dates(spark):
    rows = [(1, "2026-01-01", 1, 10), (1, "2026-01-01", 2, 5), (1, None, 3, 7), (None, "2026-01-02", 4, 1),
            (None, "2026-01-02", 5, 2), (2, "2026-01-03", 6, 4)]
    df = spark.createDataFrame(rows, "u int, d string, id int, v int").withColumn("d", F.col("d").cast("date"))
    rt = running_total_by_date(df, "u", "d", "v", "rt")
    plain_rt = df.withColumn("rt", F.sum("v").over(Window.partitionBy("u").orderBy("d")))
    assert rt.count() == 6 and same(rt.select(*plain_rt.columns), plain_rt)
    lg = lag_by_date(df, "u", "d", "id", "v", "prev")
    plain_lg = df.withColumn("prev", F.lag("v").over(Window.partitionBy("u").orderBy("d", "id")))
    assert lg.count() == 6 and same(lg.select(*plain_lg.columns), plain_lg)


def test_hot_only_salting_equals_plain(spark):
    from lakemart.operators.joins import hot_keys, salted_join

    ev = skewed_events(b.events(spark, SF)).select("event_id", "user_id", "event_type")
    u = b.users(spark, SF).select("user_id", "city")
    assert [r.user_id for r in hot_keys(ev, "user_id", 0.05).collect()] == [0]
    hot_only = salted_join(ev, u, "user_id", 8, salt_by="event_id", hot_share=0.05)
    assert same(hot_only.select("event_id", "user_id", "event_type", "city"), J.plain_skew_join(spark, SF))


def test_bucketed_equals_unbucketed(spark):
    from lakemart.plans import marts as M

    assert same(J.city_orders_bucketed(spark, SF), M.city_orders(spark, SF))


def test_tuned_flagship_equals_naive_settings(spark):
    from lakemart.plans import marts as M

    tuned = M.region_category_revenue(spark, SF).collect()
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        naive = M.region_category_revenue(spark, SF).coalesce(1).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, tuned)) == sorted(map(tuple, naive))
