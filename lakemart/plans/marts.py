"""Marts: daily, city, status, category, product and
region rollups over the bound views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.plans.registry import register
from lakemart.session import dealt_by


def _order_headers_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "status")
    return o.join(b.user_regions(spark, sf_dir), "user_id").select("order_id", "region", "status")


@register("region_category_revenue", "M9", oracle="""
SELECT r.region, p.category, o.status,
       COUNT(DISTINCT i.order_id) AS orders_cnt,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS revenue
FROM b_items i
JOIN b_orders o ON i.order_id = o.order_id
JOIN b_user_regions r ON o.user_id = r.user_id
JOIN b_products p ON i.product_id = p.product_id
GROUP BY r.region, p.category, o.status
""")
def region_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: region × category × status → distinct orders, revenue.

    Plan: the order header is narrowed to (order_id, region, status) before it
    meets the fact table (customer→region goes through broadcast nation and
    region, both bounded); lines are narrowed to (order_id, product_id,
    line revenue) and meet products on the product key.  Only the columns
    the result needs reach the scans.
    """
    headers = _order_headers_with_region(spark, sf_dir)
    lines = b.order_items(spark, sf_dir).select(
        "order_id", "product_id", (F.col("quantity") * F.col("price")).alias("line_revenue"))
    cats = b.products(spark, sf_dir).select("product_id", "category")
    return (
        dealt_by(lines.join(cats, "product_id"), "order_id")
        .join(headers, "order_id")
        .groupBy("region", "category", "status")
        .agg(F.countDistinct("order_id").alias("orders_cnt"),
             F.sum("line_revenue").cast("double").alias("revenue"))
    )


def _disc(col: str = "discount"):
    return F.col(col).cast("decimal(4,2)")


@register("daily_sales", "M1", oracle="""
SELECT o.order_date AS sales_date, COUNT(*) AS lines_cnt,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS gross,
       CAST(SUM(i.quantity * i.price * (1 - CAST(i.discount AS DECIMAL(4,2)))) AS DOUBLE) AS net
FROM b_items i JOIN b_orders o ON o.order_id = i.order_id
WHERE o.status IN ('paid', 'shipped') GROUP BY o.order_date
""")
def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid/shipped sales lines per order day: gross and net of discount,
    exact in decimals.  Lines are summed per order first (partial aggregate)
    so the join with order headers sees one row per order."""
    v = F.col("quantity") * F.col("price")
    per_order = (b.order_items(spark, sf_dir).groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("g"),
                      F.sum(v * (F.lit(1) - _disc())).alias("net_v")))
    o = (b.orders(spark, sf_dir, statuses=("paid", "shipped"))
         .select("order_id", F.col("order_date").alias("sales_date")))
    return (per_order.join(o, "order_id").groupBy("sales_date")
            .agg(F.sum("n").cast("bigint").alias("lines_cnt"), F.sum("g").cast("double").alias("gross"),
                 F.sum("net_v").cast("double").alias("net")))


@register("order_city_stats", "M2", oracle="""
SELECT u.city, COUNT(*) AS orders_cnt, COUNT(DISTINCT o.user_id) AS users_cnt,
       CAST(SUM(o.amount) AS DOUBLE) AS total_amount,
       CAST(SUM(o.amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_payment
FROM b_orders o JOIN b_users u ON u.user_id = o.user_id GROUP BY u.city
""")
def order_city_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, distinct users, total and average payment per city (orders summed per user first)."""
    per_user = (b.orders(spark, sf_dir).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("t")))
    u = b.users(spark, sf_dir).select("user_id", "city")
    agg = (per_user.join(u, "user_id").groupBy("city")
           .agg(F.sum("n").cast("bigint").alias("orders_cnt"), F.count(F.lit(1)).alias("users_cnt"),
                F.sum("t").alias("t")))
    return agg.select("city", "orders_cnt", "users_cnt", F.col("t").cast("double").alias("total_amount"),
                      (F.col("t").cast("double") / F.col("orders_cnt").cast("double")).alias("avg_payment"))


@register("order_status_stats", "M3", oracle="""
SELECT status, COUNT(*) AS orders_cnt, COUNT(DISTINCT user_id) AS users_cnt,
       CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM b_orders GROUP BY status
""")
def order_status_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, distinct users and total amount per status."""
    return (b.orders(spark, sf_dir).groupBy("status")
            .agg(F.count(F.lit(1)).alias("orders_cnt"), F.countDistinct("user_id").alias("users_cnt"),
                 F.sum("amount").cast("double").alias("total_amount")))


@register("category_revenue", "M4", oracle="""
SELECT COALESCE(p.category, 'unknown') AS category, COUNT(*) AS items_cnt,
       COUNT(DISTINCT i.order_id) AS orders_cnt, CAST(SUM(i.quantity) AS BIGINT) AS quantity,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS amount
FROM b_items i LEFT JOIN b_products p ON p.product_id = i.product_id
GROUP BY COALESCE(p.category, 'unknown')
""")
def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category mart from item rows; lines whose product is unknown are
    kept under 'unknown' (left join)."""
    cats = b.products(spark, sf_dir).select("product_id", "category")
    i = b.order_items(spark, sf_dir).select("order_id", "product_id", "quantity",
                                            (F.col("quantity") * F.col("price")).alias("v"))
    return (i.join(cats, "product_id", "left")
            .groupBy(F.coalesce("category", F.lit("unknown")).alias("category"))
            .agg(F.count(F.lit(1)).alias("items_cnt"), F.countDistinct("order_id").alias("orders_cnt"),
                 F.sum("quantity").cast("bigint").alias("quantity"), F.sum("v").cast("double").alias("amount")))


@register("city_revenue", "M5", oracle="""
, per_order AS (SELECT order_id, COUNT(*) AS items_cnt, SUM(quantity * price) AS revenue
                FROM b_items GROUP BY order_id)
SELECT o.order_date AS dt, u.city, COUNT(*) AS orders_cnt, COUNT(DISTINCT o.user_id) AS users_cnt,
       CAST(SUM(p.items_cnt) AS BIGINT) AS items_cnt, CAST(SUM(p.revenue) AS DOUBLE) AS revenue
FROM per_order p JOIN b_orders o ON o.order_id = p.order_id JOIN b_users u ON u.user_id = o.user_id
GROUP BY o.order_date, u.city
""")
def city_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, city) mart.  Items are aggregated per order before the join so
    an order is counted once, not once per line; revenue is from lines."""
    per_order = (b.order_items(spark, sf_dir).groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("items_cnt"),
                      F.sum(F.col("quantity") * F.col("price")).alias("revenue")))
    o = b.orders(spark, sf_dir).select("order_id", "user_id", F.col("order_date").alias("dt"))
    u = b.users(spark, sf_dir).select("user_id", "city")
    return (per_order.join(o, "order_id").join(u, "user_id").groupBy("dt", "city")
            .agg(F.count(F.lit(1)).alias("orders_cnt"), F.countDistinct("user_id").alias("users_cnt"),
                 F.sum("items_cnt").cast("bigint").alias("items_cnt"),
                 F.sum("revenue").cast("double").alias("revenue")))


@register("product_revenue", "M6", oracle="""
SELECT i.dt, i.product_id, p.product_name, COUNT(*) AS items_cnt, CAST(SUM(i.quantity) AS BIGINT) AS quantity,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS revenue
FROM b_items i LEFT JOIN b_products p ON p.product_id = i.product_id GROUP BY i.dt, i.product_id, p.product_name
""")
def product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, quantity and revenue per (ship day, product), with the
    product's name joined to the sums."""
    sums = (b.order_items(spark, sf_dir).groupBy("dt", "product_id")
            .agg(F.count(F.lit(1)).alias("items_cnt"), F.sum("quantity").cast("bigint").alias("quantity"),
                 F.sum(F.col("quantity") * F.col("price")).cast("double").alias("revenue")))
    return sums.join(b.products(spark, sf_dir).select("product_id", "product_name"), "product_id", "left").select(
        "dt", "product_id", "product_name", "items_cnt", "quantity", "revenue")


@register("brand_price_stats", "M7", oracle="""
, prices AS (SELECT product_id, price FROM b_products UNION ALL SELECT product_id, price FROM b_items)
SELECT p.brand, COUNT(*) AS prices_cnt, CAST(MIN(x.price) AS DOUBLE) AS min_price,
       CAST(MAX(x.price) AS DOUBLE) AS max_price,
       CAST(SUM(x.price) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_price
FROM prices x JOIN b_products p ON p.product_id = x.product_id GROUP BY p.brand
""")
def brand_price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-maker price statistics over list and sale prices, saved as
    Parquet (overwrite) and served from the written copy."""
    from lakemart.session import scratch_path
    from lakemart.sources.sinks import write_parquet

    prices = (b.products(spark, sf_dir).select("product_id", "price")
              .unionByName(b.order_items(spark, sf_dir).select("product_id", "price")))
    brands = b.products(spark, sf_dir).select("product_id", "brand")
    stats = (prices.join(brands, "product_id").groupBy("brand")
             .agg(F.count(F.lit(1)).alias("prices_cnt"), F.min("price").alias("lo"),
                  F.max("price").alias("hi"), F.sum("price").alias("t"))
             .select("brand", "prices_cnt", F.col("lo").cast("double").alias("min_price"),
                     F.col("hi").cast("double").alias("max_price"),
                     (F.col("t").cast("double") / F.col("prices_cnt").cast("double")).alias("avg_price")))
    path = scratch_path(spark, "brand_price_stats")
    write_parquet(stats, path)
    return spark.read.parquet(path)


@register("city_orders", "M8", oracle="""
SELECT u.city, COUNT(*) AS orders_cnt, CAST(SUM(o.amount) AS DOUBLE) AS total_amount
FROM b_orders o JOIN b_users u ON u.user_id = o.user_id GROUP BY u.city
""")
def city_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and total amount per city, sorted by order count (orders summed per user first)."""
    per_user = (b.orders(spark, sf_dir).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("t")))
    u = b.users(spark, sf_dir).select("user_id", "city")
    return (per_user.join(u, "user_id").groupBy("city")
            .agg(F.sum("n").cast("bigint").alias("orders_cnt"), F.sum("t").cast("double").alias("total_amount"))
            .orderBy(F.col("orders_cnt").desc(), "city"))
