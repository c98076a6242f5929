"""Nesting and unnesting over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.nested import api_products, nest
from lakemart.plans.registry import register

LINE_FIELDS = ["line_no", "product_id", "quantity", "price"]


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order with its sorted line structs."""
    return nest(b.order_items(spark, sf_dir), "order_id", LINE_FIELDS)


@register("nest_orders", "N7", oracle="""
, ranked AS (SELECT order_id, line_no, product_id, quantity,
                    ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY line_no, product_id, quantity, price) AS rn
             FROM b_items)
SELECT order_id, COUNT(*) AS lines_cnt, CAST(SUM(quantity) AS BIGINT) AS quantity_total,
       MAX(CASE WHEN rn = 1 THEN line_no END) AS first_line_no,
       MAX(CASE WHEN rn = 1 THEN product_id END) AS first_product_id
FROM ranked GROUP BY order_id
""")
def nest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines nested into one document per order; the document's size, quantity and first line."""
    docs = order_documents(spark, sf_dir)
    return docs.select(
        "order_id", F.size("items").cast("bigint").alias("lines_cnt"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda acc, x: acc + x["quantity"]).alias("quantity_total"),
        F.col("items")[0]["line_no"].alias("first_line_no"),
        F.col("items")[0]["product_id"].alias("first_product_id"))


@register("unnest_items", "N2", oracle="""
SELECT order_id, line_no, product_id, quantity, CAST(price AS DOUBLE) AS price,
       CAST(quantity * price AS DOUBLE) AS item_amount
FROM b_items
""")
def unnest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents back to one row per line (explode)."""
    docs = order_documents(spark, sf_dir)
    it = docs.select("order_id", F.explode("items").alias("it"))
    return it.select("order_id", "it.line_no", "it.product_id", "it.quantity",
                     F.col("it.price").cast("double").alias("price"),
                     (F.col("it.quantity") * F.col("it.price")).cast("double").alias("item_amount"))


@register("unnest_with_position", "N4", oracle="""
SELECT order_id, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY line_no, product_id, quantity, price) AS pos,
       line_no, product_id
FROM b_items
""")
def unnest_with_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their 1-based position inside the order document
    (``posexplode``)."""
    docs = order_documents(spark, sf_dir)
    it = docs.select("order_id", F.posexplode("items").alias("p", "it"))
    return it.select("order_id", (F.col("p") + 1).cast("bigint").alias("pos"), "it.line_no", "it.product_id")


DOC_LINE_FIELDS = ["dt", "line_no", "product_id", "quantity", "price"]


def full_order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents like the raw feed: header fields, a ``customer`` and a
    ``payment`` struct, and the sorted ``items`` array (NULL for orders
    without lines — they come from the left join)."""
    items = nest(b.order_items(spark, sf_dir), "order_id", DOC_LINE_FIELDS)
    o = b.orders(spark, sf_dir)
    return o.join(items, "order_id", "left").select(
        "order_id", "status", "order_date",
        F.struct(F.col("user_id").alias("user_id")).alias("customer"),
        F.struct(F.col("amount").alias("amount"), F.lit("USD").alias("currency")).alias("payment"),
        "items")


@register("unnest_keep_empty", "N5", oracle="""
SELECT o.order_id, i.line_no, i.product_id FROM b_orders o LEFT JOIN b_items i ON i.order_id = o.order_id
""")
def unnest_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``explode_outer`` keeps documents whose array is empty or missing as
    one row of NULLs (orders without lines)."""
    docs = full_order_documents(spark, sf_dir)
    it = docs.select("order_id", F.explode_outer("items").alias("it"))
    return it.select("order_id", F.col("it.line_no").alias("line_no"), F.col("it.product_id").alias("product_id"))


@register("order_document_rows", "N1/N3/N6", oracle="""
SELECT o.order_id, o.user_id, o.status, o.order_date, CAST(o.amount AS DOUBLE) AS payment_amount,
       'USD' AS currency, CAST(COALESCE(c.n, 0) AS INTEGER) AS items_count
FROM b_orders o LEFT JOIN (SELECT order_id, COUNT(*) AS n FROM b_items GROUP BY order_id) c
  ON c.order_id = o.order_id
""")
def order_document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per document: header, nested member access through the
    structs, and the item count (0 when the array is missing)."""
    docs = full_order_documents(spark, sf_dir)
    return docs.select(
        "order_id", F.col("customer.user_id").alias("user_id"), "status", "order_date",
        F.col("payment.amount").cast("double").alias("payment_amount"), F.col("payment.currency").alias("currency"),
        # size(NULL) is NULL under ANSI and -1 in legacy mode: test for NULL explicitly.
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("int").alias("items_count"))


@register("latest_line_per_order", "N8", oracle="""
SELECT order_id, dt, line_no, product_id FROM (
  SELECT order_id, dt, line_no, product_id,
         ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY dt DESC, line_no DESC, product_id DESC,
                            quantity DESC, price DESC) AS rn
  FROM b_items) t WHERE rn = 1
""")
def latest_line_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unnest each document's items and keep the latest one (by ship day,
    then the other fields): ``max_by`` per document, no window."""
    docs = full_order_documents(spark, sf_dir)
    it = docs.select("order_id", F.explode("items").alias("it"))
    last = it.groupBy("order_id").agg(
        F.max_by("it", F.struct(*[F.col(f"it.{c}") for c in DOC_LINE_FIELDS])).alias("last"))
    return last.select("order_id", "last.dt", "last.line_no", "last.product_id")


PAGE_ROWS = 30


@register("api_product_rows", "N9", oracle="""
SELECT p_partkey AS product_id, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(p_size AS INTEGER) AS stock
FROM part
""")
def api_product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a product API (PAGE_ROWS products each, built from the parts)
    unnested into typed rows."""
    parts = b.table(spark, sf_dir, "part").select(
        F.floor((F.col("p_partkey") - 1) / PAGE_ROWS).alias("page"), F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"), F.col("p_retailprice").cast("double").alias("price"),
        F.col("p_size").cast("bigint").alias("stock"))
    pages = nest(parts, "page", ["id", "title", "price", "stock"], items_name="products")
    return api_products(pages).withColumn("price", F.col("price").cast("double"))
