"""Generic and partition-scoped keyed loads, views and cache scope over the
driver tables (SURVEY §2.8 L4, L10, L15, L16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.layout import cached
from lakemart.operators.keyed import BucketTable, load_keyed
from lakemart.operators.loads import upsert_partitioned
from lakemart.plans.registry import register
from lakemart.session import create_layers, scratch_path
from lakemart.sources.sinks import save_table

# Ship years that the second load of the line table corrects.
CORRECTED_FROM = "1997-01-01"


def _line_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (ship year, order, product): a key that is unique."""
    return (b.order_items(spark, sf_dir).groupBy(F.year("dt").alias("ship_year"), "order_id", "product_id")
            .agg(F.sum("quantity").cast("bigint").alias("quantity"), F.max("dt").alias("last_dt")))


@register("upsert_items_partitioned", "L4/L10", oracle="""
SELECT CAST(year(dt) AS INTEGER) AS ship_year, order_id, product_id,
       CAST(SUM(quantity) AS BIGINT) + CASE WHEN MAX(dt) >= DATE '1997-01-01' AND order_id % 2 = 0 THEN 1000 ELSE 0 END AS quantity
FROM b_items GROUP BY 1, 2, 3
""")
def upsert_items_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept by ship year; a batch that corrects the even orders of the
    later years rewrites only those years' partitions."""
    root, sums = scratch_path(spark, "items_by_year"), _line_sums(spark, sf_dir)
    keys = ["ship_year", "order_id", "product_id"]
    fixes = sums.filter((F.col("last_dt") >= F.lit(CORRECTED_FROM).cast("date")) & (F.col("order_id") % 2 == 0)).withColumn(
        "quantity", F.col("quantity") + 1000)
    # Where there is no line at all, nothing is written to read back.
    if sums.isEmpty():
        return sums.select(*keys, "quantity")
    for batch in (sums, fixes):
        upsert_partitioned(spark, f"{root}/items", batch.select(*keys, "quantity"), keys, ["ship_year"], f"{root}/stage")
    schema = "order_id bigint, product_id bigint, quantity bigint, ship_year int"
    return spark.read.schema(schema).parquet(f"{root}/items").select("ship_year", "order_id", "product_id", "quantity")


@register("load_generic", "L4", oracle="""
SELECT order_id, user_id, CASE WHEN order_id % 3 = 0 THEN 'closed' ELSE status END AS status,
       CAST(amount AS DOUBLE) AS amount
FROM b_orders
""")
def load_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic keyed load: the first run creates the table, the second
    updates every column of the rows it brings, an empty one does nothing."""
    root = scratch_path(spark, "generic_orders")
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "status", "amount")
    closed = o.filter(F.col("order_id") % 3 == 0).withColumn("status", F.lit("closed"))
    for batch in (o, closed, closed.limit(0)):
        load_keyed(spark, batch, root, ["order_id"])
    return BucketTable(spark, root, ["order_id"], o.schema).read().withColumn("amount", F.col("amount").cast("double"))


@register("v_paid_orders", "L16", oracle="""
SELECT order_id, user_id, order_date, CAST(amount AS DOUBLE) AS amount FROM b_orders WHERE status = 'paid'
""")
def v_paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A persistent view in the mart database over a saved ods table."""
    create_layers(spark, ("ods", "mart"))
    path = scratch_path(spark, "paid_orders")
    tag = path.rsplit("-", 1)[-1]
    save_table(b.orders(spark, sf_dir), f"ods.orders_{tag}", path=path)
    spark.sql(f"""CREATE OR REPLACE VIEW mart.v_paid_orders_{tag} AS
                  SELECT order_id, user_id, order_date, CAST(amount AS DOUBLE) AS amount
                  FROM ods.orders_{tag} WHERE status = 'paid'""")
    return spark.table(f"mart.v_paid_orders_{tag}")


@register("cached_order_profile", "L15", oracle="""
SELECT 'status' AS kind, status AS value, COUNT(*) AS orders_cnt FROM b_orders GROUP BY status
UNION ALL SELECT 'year', CAST(year(order_date) AS VARCHAR), COUNT(*) FROM b_orders GROUP BY 2
""")
def cached_order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates of one cached frame, written inside the cache's scope;
    the cache is released when the block ends."""
    path = scratch_path(spark, "order_profile")
    narrow = b.orders(spark, sf_dir).select("status", F.year("order_date").cast("string").alias("year"))
    with cached(narrow) as rows:
        for kind in ("status", "year"):
            (rows.groupBy(F.col(kind).alias("value")).agg(F.count(F.lit(1)).alias("orders_cnt"))
             .select(F.lit(kind).alias("kind"), "value", "orders_cnt").write.mode("append").parquet(path))
    return spark.read.schema("kind string, value string, orders_cnt bigint").parquet(path)
