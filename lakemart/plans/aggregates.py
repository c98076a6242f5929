"""Aggregations.

Money is summed as DECIMAL (exact, order independent) and cast to DOUBLE at
the end; averages are exact sums divided by counts in DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.aggregates import salted_aggregate, word_count
from lakemart.operators.skew import skewed_events
from lakemart.plans.registry import register
from lakemart.session import skew_salts


def _dbl(c):
    return F.col(c).cast("double") if isinstance(c, str) else c.cast("double")


def _avg(total: str, n: str):
    return F.col(total).cast("double") / F.col(n).cast("double")


@register("city_user_stats", "A1", oracle="""
SELECT city, COUNT(*) AS users_cnt, MIN(registered_on) AS first_registered,
       MAX(registered_on) AS last_registered
FROM b_users GROUP BY city
""")
def city_user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per city with first (min) and last (max) registration, largest
    city first (D1; the driver compares unordered)."""
    return (b.users(spark, sf_dir).groupBy("city")
            .agg(F.count(F.lit(1)).alias("users_cnt"),
                 F.min("registered_on").alias("first_registered"),
                 F.max("registered_on").alias("last_registered"))
            .orderBy(F.desc("users_cnt"), "city"))


@register("category_price_stats", "A2", oracle="""
SELECT category, COUNT(*) AS products_cnt, CAST(MIN(price) AS DOUBLE) AS min_price,
       CAST(MAX(price) AS DOUBLE) AS max_price,
       CAST(SUM(price) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_price
FROM b_products GROUP BY category
""")
def category_price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products per category with min, max and average list price."""
    return (b.products(spark, sf_dir).groupBy("category")
            .agg(F.count(F.lit(1)).alias("products_cnt"), F.min("price").alias("min_price"),
                 F.max("price").alias("max_price"), F.sum("price").alias("total"))
            .select("category", "products_cnt", _dbl("min_price").alias("min_price"),
                    _dbl("max_price").alias("max_price"),
                    _avg("total", "products_cnt").alias("avg_price")))


def _paid_orders(spark, sf_dir):
    return b.orders(spark, sf_dir, statuses=("paid",))


@register("order_units", "A3", oracle="""
SELECT o.order_id, COUNT(*) AS lines_cnt, CAST(SUM(i.quantity) AS BIGINT) AS units
FROM b_orders o JOIN b_items i ON o.order_id = i.order_id
WHERE o.status = 'paid' GROUP BY o.order_id
""")
def order_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and units per paid order (lines are pre-aggregated per order,
    so the join sees one row per order instead of one per line)."""
    per_order = (b.order_items(spark, sf_dir).groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("lines_cnt"),
                      F.sum("quantity").cast("bigint").alias("units")))
    paid = _paid_orders(spark, sf_dir).select("order_id")
    return per_order.join(paid, "order_id", "left_semi")


@register("users_two_paid", "A4", oracle="""
SELECT u.user_id, u.email, COUNT(*) AS paid_orders_cnt,
       CAST(SUM(o.amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_amount,
       CAST(SUM(o.amount) AS DOUBLE) AS total_amount
FROM b_users u JOIN b_orders o ON u.user_id = o.user_id
WHERE o.status = 'paid'
GROUP BY u.user_id, u.email HAVING COUNT(*) >= 2
""")
def users_two_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with at least two paid orders: id, email, count, avg, sum."""
    per_user = (_paid_orders(spark, sf_dir).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("paid_orders_cnt"), F.sum("amount").alias("total"))
                .filter(F.col("paid_orders_cnt") >= 2))
    return (per_user.join(b.users(spark, sf_dir).select("user_id", "email"), "user_id")
            .select("user_id", "email", "paid_orders_cnt",
                    _avg("total", "paid_orders_cnt").alias("avg_amount"),
                    _dbl("total").alias("total_amount")))


# Query parameter: "more than n units" threshold on the bound data.
BIG_ORDER_UNITS = 150


@register("big_orders", "A4/Q-E2", oracle=f"""
SELECT order_id, COUNT(*) AS lines_cnt, CAST(SUM(quantity) AS BIGINT) AS units
FROM b_items GROUP BY order_id HAVING SUM(quantity) > {BIG_ORDER_UNITS}
""")
def big_orders(spark: SparkSession, sf_dir: str, min_units: int = BIG_ORDER_UNITS) -> DataFrame:
    """Orders with more than 150 units in total (HAVING)."""
    return (b.order_items(spark, sf_dir).groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("lines_cnt"), F.sum("quantity").cast("bigint").alias("units"))
            .filter(F.col("units") > min_units))


@register("orders_span", "A5", oracle="""
SELECT COUNT(*) AS orders_cnt, MIN(order_date) AS first_order_date,
       MAX(order_date) AS last_order_date, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM b_orders
""")
def orders_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order count, first and last order date, total amount (global aggregate)."""
    return b.orders(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("orders_cnt"), F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"), F.sum("amount").cast("double").alias("total_amount"))


@register("events_by_day", "A6", oracle="""
SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS events_cnt FROM events GROUP BY 1
""")
def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day, ordered by day."""
    return (b.events(spark, sf_dir).groupBy(F.to_date("ts").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("events_cnt")).orderBy("event_date"))


@register("date_status_totals", "A7", oracle="""
SELECT order_date, status, COUNT(*) AS orders_cnt, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM b_orders GROUP BY order_date, status
""")
def date_status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and exact amount per (date, status); the decimal sum is already
    exact to the cent, so rounding to 2 places is the identity."""
    return (b.orders(spark, sf_dir).groupBy("order_date", "status")
            .agg(F.count(F.lit(1)).alias("orders_cnt"), F.sum("amount").cast("double").alias("total_amount")))


# Order statuses of the bound orders view.
STATUSES = ("paid", "shipped", "created")


@register("status_counts_per_user", "A9", oracle="""
SELECT user_id,
       COUNT(*) FILTER (WHERE status = 'paid') AS paid_cnt,
       COUNT(*) FILTER (WHERE status = 'shipped') AS shipped_cnt,
       COUNT(*) FILTER (WHERE status = 'created') AS created_cnt
FROM b_orders GROUP BY user_id
""")
def status_counts_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional counts per user (a pivot with a fixed value list)."""
    return (b.orders(spark, sf_dir).groupBy("user_id")
            .agg(*[F.count(F.when(F.col("status") == s, 1)).alias(f"{s}_cnt") for s in STATUSES]))


@register("users_all_statuses", "A10", oracle="""
SELECT user_id, COUNT(DISTINCT status) AS statuses_cnt
FROM b_orders GROUP BY user_id HAVING COUNT(DISTINCT status) = 3
""")
def users_all_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that have orders in every status (distinct-count HAVING)."""
    return (b.orders(spark, sf_dir).groupBy("user_id")
            .agg(F.countDistinct("status").alias("statuses_cnt"))
            .filter(F.col("statuses_cnt") == len(STATUSES)))


@register("avg_price_by_size", "A11", oracle="""
SELECT size, COUNT(*) AS products_cnt, CAST(SUM(price) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_price
FROM b_products WHERE size > 10 GROUP BY size
""")
def avg_price_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average list price per product size, for sizes above 10."""
    return (b.products(spark, sf_dir).filter(F.col("size") > 10).groupBy("size")
            .agg(F.count(F.lit(1)).alias("products_cnt"), F.sum("price").alias("total"))
            .select("size", "products_cnt", _avg("total", "products_cnt").alias("avg_price")))


@register("word_count", "A13", oracle=r"""
SELECT word, COUNT(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(lower(text), '[\t\n\x0B\f\r ]+')) AS word FROM documents)
WHERE length(word) > 0 GROUP BY word
""")
def word_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word count over whole document texts (map → combine → shuffle → reduce)."""
    # Only counts move; texts are split where they are read.
    return word_count(b.table(spark, sf_dir, "documents").select("text"))


@register("gen_skewed_events", "S10", oracle="""
SELECT event_id,
       CASE WHEN event_id % 10 < 8 THEN CAST(0 AS BIGINT) ELSE user_id END AS user_id,
       user_id AS source_user_id, event_type,
       CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS event_value,
       CASE WHEN event_id % 10 < 8 THEN 'hot' ELSE 'k' || CAST(user_id AS VARCHAR) END AS skew_key
FROM events
""")
def gen_skewed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events re-keyed so that 80 % of rows share one key."""
    return skewed_events(b.events(spark, sf_dir)).withColumn(
        "event_value", F.col("event_value").cast("double"))




@register("skew_agg_salted", "A14", oracle="""
SELECT CASE WHEN event_id % 10 < 8 THEN 'hot' ELSE 'k' || CAST(user_id AS VARCHAR) END AS skew_key,
       COUNT(*) AS events_cnt, COUNT(DISTINCT user_id) AS users_cnt,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1
""")
def skew_agg_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate the hot key in two phases, salted by the distinct-counted
    column (the source user), so the distinct count stays exact."""
    ev = skewed_events(b.events(spark, sf_dir))
    out = salted_aggregate(ev, "skew_key", skew_salts(spark), salt_by="source_user_id",
                           counts={"events_cnt": "*"}, sums={"value_sum": "event_value"},
                           distinct_of={"users_cnt": "source_user_id"})
    return out.select("skew_key", F.col("events_cnt").cast("bigint").alias("events_cnt"),
                      F.col("users_cnt").cast("bigint").alias("users_cnt"),
                      _dbl("value_sum").alias("value_sum"))


@register("category_revenue_simple", "A15", oracle="""
SELECT p.category, COUNT(*) AS items_cnt, CAST(SUM(i.quantity * i.price) AS DOUBLE) AS revenue
FROM b_items i JOIN b_products p ON i.product_id = p.product_id GROUP BY p.category
""")
def category_revenue_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category revenue job: lines are pre-aggregated per product (partial
    aggregation before the join), then mapped to categories."""
    per_product = (b.order_items(spark, sf_dir).groupBy("product_id")
                   .agg(F.count(F.lit(1)).alias("items_cnt"),
                        F.sum(F.col("quantity") * F.col("price")).alias("revenue")))
    cats = b.products(spark, sf_dir).select("product_id", "category")
    return (per_product.join(cats, "product_id").groupBy("category")
            .agg(F.sum("items_cnt").cast("bigint").alias("items_cnt"),
                 F.sum("revenue").cast("double").alias("revenue")))


@register("event_stats", "A16", oracle="""
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS events_cnt,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1, 2
""")
def event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per (day, type) with their exact value sum."""
    return (b.events(spark, sf_dir)
            .groupBy(F.to_date("ts").alias("event_date"), "event_type")
            .agg(F.count(F.lit(1)).alias("events_cnt"),
                 F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("value_sum")))


@register("paid_revenue", "A17", oracle="""
SELECT COUNT(*) AS paid_orders_cnt, CAST(SUM(amount) AS DOUBLE) AS paid_revenue
FROM b_orders WHERE status = 'paid'
""")
def paid_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and revenue of paid orders (global aggregate)."""
    return _paid_orders(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("paid_orders_cnt"), F.sum("amount").cast("double").alias("paid_revenue"))
