"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.joins import all_members_match, anti_join, mismatch_report, salted_join
from lakemart.operators.layout import CoLocated, dense_ids
from lakemart.operators.skew import skewed_events
from lakemart.plans.registry import register
from lakemart.session import bucket_count, scratch_path, skew_salts


@register("orders_left_lines", "J3", oracle="""
SELECT o.order_id, o.status, COUNT(i.order_id) AS lines_cnt,
       CAST(COALESCE(SUM(i.quantity), 0) AS BIGINT) AS units
FROM b_orders o LEFT JOIN b_items i ON o.order_id = i.order_id
GROUP BY o.order_id, o.status
""")
def orders_left_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its line count; orders without lines keep 0.

    Lines are aggregated per order before the left join, so the join sees
    one row per order on both sides.
    """
    per_order = (b.order_items(spark, sf_dir).groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("lines_cnt"), F.sum("quantity").alias("units")))
    o = b.orders(spark, sf_dir).select("order_id", "status")
    return o.join(per_order, "order_id", "left").select(
        "order_id", "status", F.coalesce("lines_cnt", F.lit(0)).cast("bigint").alias("lines_cnt"),
        F.coalesce("units", F.lit(0)).cast("bigint").alias("units"))


# Event type → funnel stage dictionary.
EVENT_STAGES = [("view", "interest"), ("add_to_cart", "intent"), ("purchase", "conversion")]


@register("events_typed_dict", "J4", oracle="""
SELECT e.event_id, e.event_type, d.stage
FROM events e JOIN (VALUES ('view', 'interest'), ('add_to_cart', 'intent'),
                           ('purchase', 'conversion')) AS d(event_type, stage)
  ON e.event_type = d.event_type
""")
def events_typed_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map-side join of events with a three-row dictionary (MAPJOIN)."""
    stages = spark.createDataFrame(EVENT_STAGES, "event_type string, stage string")
    ev = b.events(spark, sf_dir).select("event_id", "event_type")
    return ev.join(F.broadcast(stages), "event_type").select("event_id", "event_type", "stage")


# Minimum buckets of the co-located tables (both sides use the same number,
# by default from the size of the orders, see session.bucket_count).
BUCKETS = 8


@register("city_orders_bucketed", "J6", oracle="""
SELECT u.city, COUNT(*) AS orders_cnt, CAST(SUM(o.amount) AS DOUBLE) AS total_amount
FROM b_orders o JOIN b_users u ON o.user_id = u.user_id GROUP BY u.city
""")
def city_orders_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-located join: orders and users are both bucketed by user_id, so
    the join reads matching buckets without an Exchange on either side; users
    with more orders than a bucket should hold join through sub-keys."""
    orders = b.orders(spark, sf_dir).select("order_id", "user_id", "amount")
    laid_out = CoLocated(orders, b.users(spark, sf_dir).select("user_id", "city"), "user_id", scratch_path(spark, "bucketed"),
                         bucket_count(spark, orders, BUCKETS), skew_salts(spark))
    return (laid_out.join().groupBy("city")
            .agg(F.count(F.lit(1)).alias("orders_cnt"), F.sum("amount").cast("double").alias("total_amount")))


@register("paid_not_created_users", "J7", oracle="""
SELECT DISTINCT user_id FROM b_orders p WHERE status = 'paid'
  AND NOT EXISTS (SELECT 1 FROM b_orders c WHERE c.user_id = p.user_id AND c.status = 'created')
""")
def paid_not_created_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with a paid order and no created order (left anti join; not
    NOT IN, which is null-aware and plans a broadcast nested loop)."""
    paid = b.orders(spark, sf_dir, statuses=("paid",)).select("user_id").distinct()
    created = b.orders(spark, sf_dir, statuses=("created",)).select("user_id")
    return anti_join(paid, created, "user_id")


@register("key_mismatch_report", "J8", oracle="""
SELECT order_id, 'missing_in_items' AS issue_type FROM b_orders
WHERE order_id NOT IN (SELECT order_id FROM b_items)
UNION ALL
SELECT DISTINCT order_id, 'missing_in_orders' AS issue_type FROM b_items
WHERE order_id NOT IN (SELECT order_id FROM b_orders)
""")
def key_mismatch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys present on one side only, with ``issue_type``."""
    return mismatch_report(b.orders(spark, sf_dir).select("order_id"),
                           b.order_items(spark, sf_dir).select("order_id"),
                           "order_id", "orders", "items")


@register("users_all_orders_have_lines", "J9", oracle="""
SELECT o.user_id, COUNT(*) AS orders_cnt
FROM b_orders o LEFT JOIN (SELECT DISTINCT order_id FROM b_items) i ON o.order_id = i.order_id
GROUP BY o.user_id HAVING COUNT(*) = COUNT(i.order_id)
""")
def users_all_orders_have_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational division: users all of whose orders have at least one line."""
    with_lines = b.order_items(spark, sf_dir).select("order_id").distinct().withColumn("has_line", F.lit(True))
    members = b.orders(spark, sf_dir).select("order_id", "user_id").join(with_lines, "order_id", "left")
    return (all_members_match(members, "user_id", F.col("has_line").isNotNull())
            .select("user_id", F.col("members").alias("orders_cnt")))


@register("orders_before_registration", "J10", oracle="""
SELECT u.user_id, u.email, u.registered_on, o.order_id, o.order_date
FROM b_users u JOIN b_orders o ON u.user_id = o.user_id AND o.order_date < u.registered_on
""")
def orders_before_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi-join on user with an inequality residual (date vs date)."""
    u = b.users(spark, sf_dir).select("user_id", "email", "registered_on")
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "order_date")
    return (u.join(o, (u.user_id == o.user_id) & (o.order_date < u.registered_on))
            .select(u.user_id, "email", "registered_on", "order_id", "order_date"))


@register("user_paid_count", "J11", oracle="""
SELECT u.user_id, u.email,
       (SELECT COUNT(*) FROM b_orders o WHERE o.user_id = u.user_id AND o.status = 'paid') AS paid_orders_cnt
FROM b_users u
""")
def user_paid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlated count per user, zero when none: decorrelated as aggregate
    then left join with a NULL→0 fix-up (what Catalyst does with the
    scalar subquery)."""
    paid = (b.orders(spark, sf_dir, statuses=("paid",))
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
    u = b.users(spark, sf_dir).select("user_id", "email")
    return u.join(paid, "user_id", "left").select(
        "user_id", "email", F.coalesce("n", F.lit(0)).cast("bigint").alias("paid_orders_cnt"))


@register("load_fact_lines", "J12", oracle="""
, dim AS (SELECT product_id, ROW_NUMBER() OVER (ORDER BY product_id) AS product_sk FROM b_products)
SELECT i.order_id, i.line_no, d.product_sk, i.quantity, CAST(i.line_amount AS DOUBLE) AS line_amount
FROM b_items i JOIN dim d ON i.product_id = d.product_id
""")
def load_fact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load lines with the product surrogate key looked up by natural key."""
    dim = dense_ids(b.products(spark, sf_dir), "product_id", "product_sk")
    lines = b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "quantity", "line_amount")
    return lines.join(dim, "product_id").select(
        "order_id", "line_no", "product_sk", "quantity", F.col("line_amount").cast("double").alias("line_amount"))




@register("skew_join_salted", "J13", oracle="""
SELECT e.event_id, CASE WHEN e.event_id % 10 < 8 THEN CAST(0 AS BIGINT) ELSE e.user_id END AS user_id,
       e.event_type, u.city
FROM events e JOIN b_users u ON u.user_id = CASE WHEN e.event_id % 10 < 8 THEN 0 ELSE e.user_id END
""")
def skew_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join the hot user (80 % of events) with users through salted keys:
    keys with 1 % of the events or more are split over
    ``lakemart.skew.salts`` tasks (default 16), and only their users are
    replicated.  Equals the plain join."""
    ev = skewed_events(b.events(spark, sf_dir)).select("event_id", "user_id", "event_type")
    u = b.users(spark, sf_dir).select("user_id", "city")
    return salted_join(ev, u, "user_id", skew_salts(spark), salt_by="event_id", hot_share=0.01).select(
        "event_id", "user_id", "event_type", "city")


def plain_skew_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsalted form of ``skew_join_salted`` (for equivalence tests)."""
    ev = skewed_events(b.events(spark, sf_dir)).select("event_id", "user_id", "event_type")
    u = b.users(spark, sf_dir).select("user_id", "city")
    return ev.join(u, "user_id").select("event_id", "user_id", "event_type", "city")



@register("order_users_merge_join", "J5", oracle="""
SELECT o.order_id, o.user_id, u.city FROM b_orders o JOIN b_users u ON u.user_id = o.user_id
""")
def order_users_merge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffle sort-merge join forced by hint (the plan when neither side may
    be broadcast)."""
    o = b.orders(spark, sf_dir).select("order_id", "user_id")
    u = b.users(spark, sf_dir).select("user_id", "city")
    return o.join(u.hint("merge"), "user_id").select("order_id", "user_id", "city")


@register("user_paid_count_sql", "J11", oracle="""
SELECT u.user_id, u.email,
       (SELECT COUNT(*) FROM b_orders o WHERE o.user_id = u.user_id AND o.status = 'paid') AS paid_orders_cnt
FROM b_users u
""")
def user_paid_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 written as SQL with the correlated scalar subquery; Catalyst
    rewrites it into an aggregate and a left outer join (count fixed to 0),
    so no per-row sub-plan runs."""
    v = b.register_views(spark, sf_dir, b.unique_suffix())
    return spark.sql(f"""
        SELECT u.user_id, u.email,
               (SELECT COUNT(*) FROM {v['b_paid_orders']} o WHERE o.user_id = u.user_id)
                 AS paid_orders_cnt
        FROM {v['b_users']} u""")


@register("events_typed_dict_sql", "J4", oracle="""
SELECT e.event_id, e.event_type, d.stage
FROM events e JOIN (VALUES ('view', 'interest'), ('add_to_cart', 'intent'),
                           ('purchase', 'conversion')) AS d(event_type, stage)
  ON e.event_type = d.event_type
""")
def events_typed_dict_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 in SQL with the Hive-style ``/*+ MAPJOIN(d) */`` hint over an
    inline ``VALUES`` dictionary (planned as a broadcast hash join)."""
    view = "events_for_dict_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    b.events(spark, sf_dir).createOrReplaceTempView(view)
    values = ", ".join(f"('{t}', '{s}')" for t, s in EVENT_STAGES)
    return spark.sql(f"""
        SELECT /*+ MAPJOIN(d) */ e.event_id, e.event_type, d.stage
        FROM {view} e JOIN (VALUES {values}) AS d(event_type, stage) ON e.event_type = d.event_type""")
