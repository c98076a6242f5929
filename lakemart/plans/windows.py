"""Windows, sorting, limits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.windows import running_total_by_date, top_n_per_group, trim_edges
from lakemart.plans.registry import register


@register("city_top_order", "W1", oracle="""
SELECT city, order_id, order_date, amount FROM (
  SELECT u.city, o.order_id, o.order_date, CAST(o.amount AS DOUBLE) AS amount,
         ROW_NUMBER() OVER (PARTITION BY u.city ORDER BY o.amount DESC, o.order_id) AS rn
  FROM b_orders o JOIN b_users u ON u.user_id = o.user_id WHERE o.status = 'paid') t
WHERE rn = 1
""")
def city_top_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most expensive paid order per city (tie-break order_id).  The top-1
    filter becomes a WindowGroupLimit that runs before the shuffle too."""
    o = b.orders(spark, sf_dir, statuses=("paid",)).select(
        "order_id", "user_id", "order_date", "amount")
    u = b.users(spark, sf_dir).select("user_id", "city")
    top = top_n_per_group(o.join(u, "user_id"), ["city"],
                          [F.col("amount").desc(), F.col("order_id")], 1)
    return top.select("city", "order_id", "order_date", F.col("amount").cast("double").alias("amount"))


@register("running_revenue", "W2", oracle="""
SELECT user_id, order_date, order_id, CAST(amount AS DOUBLE) AS amount,
       CAST(SUM(amount) OVER (PARTITION BY user_id ORDER BY order_date) AS DOUBLE) AS running_amount
FROM b_orders WHERE status = 'paid'
""")
def running_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running paid revenue per user over time; same-day orders share the
    total (default RANGE frame)."""
    paid = b.orders(spark, sf_dir, statuses=("paid",)).select(
        "user_id", "order_date", "order_id", "amount")
    out = running_total_by_date(paid, "user_id", "order_date", "amount", "running_amount")
    return out.select("user_id", "order_date", "order_id", F.col("amount").cast("double").alias("amount"),
                      F.col("running_amount").cast("double").alias("running_amount"))


@register("two_cheapest_per_category", "W3", oracle="""
SELECT category, product_id, product_name, price, rn FROM (
  SELECT category, product_id, product_name, CAST(price AS DOUBLE) AS price,
         ROW_NUMBER() OVER (PARTITION BY category ORDER BY price, product_id) AS rn
  FROM b_products) t WHERE rn <= 2
""")
def two_cheapest_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two cheapest products of each category (tie-break product id)."""
    p = b.products(spark, sf_dir).select("category", "product_id", "product_name", "price")
    top = top_n_per_group(p, ["category"], [F.col("price"), F.col("product_id")], 2)
    return top.select("category", "product_id", "product_name",
                      F.col("price").cast("double").alias("price"), "rn")


@register("top_5_prices", "O2", oracle="""
SELECT product_id, product_name, CAST(price AS DOUBLE) AS price
FROM b_products ORDER BY price DESC, product_id LIMIT 5
""")
def top_5_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k with a unique tie-break (TakeOrderedAndProject: each task keeps
    its own k rows, the driver merges k × tasks rows)."""
    return (b.products(spark, sf_dir).orderBy(F.col("price").desc(), F.col("product_id")).limit(5)
            .select("product_id", "product_name", F.col("price").cast("double").alias("price")))


@register("trim_edges", "O3", oracle="""
, lo AS (SELECT product_id FROM b_products ORDER BY price, product_id LIMIT 3),
  hi AS (SELECT product_id FROM b_products ORDER BY price DESC, product_id DESC LIMIT 3)
SELECT product_id, CAST(price AS DOUBLE) AS price FROM b_products
WHERE product_id NOT IN (SELECT product_id FROM lo) AND product_id NOT IN (SELECT product_id FROM hi)
""")
def trim_edges_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products but the 3 cheapest and the 3 dearest."""
    p = b.products(spark, sf_dir).select("product_id", "price")
    out = trim_edges(p, [F.col("price"), F.col("product_id")],
                     [F.col("price").desc(), F.col("product_id").desc()], "product_id", 3)
    return out.select("product_id", F.col("price").cast("double").alias("price"))


@register("all_prices", "U1", oracle="""
SELECT product_id, CAST(price AS DOUBLE) AS price, 'list' AS price_type FROM b_products
UNION ALL
SELECT product_id, CAST(price AS DOUBLE) AS price, 'sale' AS price_type FROM b_items
""")
def all_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List and sale prices under one schema with a type label (bag union)."""
    lst = b.products(spark, sf_dir).select("product_id", "price", F.lit("list").alias("price_type"))
    sale = b.order_items(spark, sf_dir).select("product_id", "price", F.lit("sale").alias("price_type"))
    return lst.unionByName(sale).withColumn("price", F.col("price").cast("double"))


@register("distinct_users", "U2", oracle="SELECT DISTINCT user_id FROM b_orders")
def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users that placed orders."""
    return b.orders(spark, sf_dir).select("user_id").distinct()


@register("city_top_order_sql", "W1", oracle="""
SELECT city, order_id, order_date, CAST(amount AS DOUBLE) AS amount FROM (
  SELECT u.city, o.order_id, o.order_date, o.amount,
         ROW_NUMBER() OVER (PARTITION BY u.city ORDER BY o.amount DESC, o.order_id) AS rn
  FROM b_orders o JOIN b_users u ON u.user_id = o.user_id WHERE o.status = 'paid') t
WHERE rn = 1
""")
def city_top_order_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 as SQL (CTE + row_number = 1); the filter on the row number
    becomes a WindowGroupLimit just like the DataFrame form."""
    v = b.register_views(spark, sf_dir, b.unique_suffix())
    return spark.sql(f"""
        WITH ranked AS (
          SELECT u.city, o.order_id, o.order_date, o.amount,
                 ROW_NUMBER() OVER (PARTITION BY u.city ORDER BY o.amount DESC, o.order_id) AS rn
          FROM {v['b_paid_orders']} o JOIN {v['b_users']} u ON u.user_id = o.user_id)
        SELECT city, order_id, order_date, CAST(amount AS DOUBLE) AS amount FROM ranked WHERE rn = 1""")
