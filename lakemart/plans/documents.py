"""Order documents → raw table → ods statistics (SURVEY N6, L3, M2–M4, DQ2,
S18).

check input → raw order rows upserted by order_id (a re-run updates, never
duplicates) → ``order_city_stats``, ``order_status_stats`` and
``category_revenue`` computed from the nested documents and overwritten per
run.  Library functions; the driver tables hold no order documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators.loads import VersionedTable
from lakemart.operators.nested import raw_order_rows, unnest_items
from lakemart.operators.quality import ensure_not_empty


def order_city_stats(docs: DataFrame) -> DataFrame:
    o = docs.select(F.col("customer.city").alias("city"), F.col("customer.user_id").alias("user_id"),
                    F.col("payment.amount").cast("decimal(12,2)").alias("amount"))
    return (o.groupBy("city").agg(F.count(F.lit(1)).alias("orders_count"),
                                  F.countDistinct("user_id").alias("users_count"),
                                  F.sum("amount").alias("total_payment_amount"))
            .withColumn("avg_payment_amount",
                        (F.col("total_payment_amount") / F.col("orders_count")).cast("decimal(14,2)")))


def order_status_stats(docs: DataFrame) -> DataFrame:
    o = docs.select(F.lower("status").alias("status"), F.col("customer.user_id").alias("user_id"),
                    F.col("payment.amount").cast("decimal(12,2)").alias("amount"))
    return o.groupBy("status").agg(F.count(F.lit(1)).alias("orders_count"),
                                   F.countDistinct("user_id").alias("users_count"),
                                   F.sum("amount").alias("total_payment_amount"))


def category_revenue(docs: DataFrame) -> DataFrame:
    items = unnest_items(docs)
    return items.groupBy("category").agg(
        F.count(F.lit(1)).alias("items_count"), F.countDistinct("order_id").alias("orders_count"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("item_amount").alias("total_item_amount"))


def run_order_documents(spark: SparkSession, path: str, root: str) -> dict[str, DataFrame]:
    """One run of the document flow; returns what each table holds after it."""
    ensure_not_empty(spark, path, fmt="json", multiLine=True)
    docs = spark.read.schema(schemas.ORDER_DOC).option("multiLine", True).json(path)
    raw = VersionedTable(spark, f"{root}/stg/orders_raw")
    rows = raw_order_rows(docs)
    if raw.current_version() == 0:
        raw.overwrite(rows)
    else:
        raw.upsert(rows, ["order_id"])
    marts = {"order_city_stats": order_city_stats(docs), "order_status_stats": order_status_stats(docs),
             "category_revenue": category_revenue(docs)}
    for name, df in marts.items():
        df.write.mode("overwrite").parquet(f"{root}/ods/{name}")
    return {"orders_raw": raw.read(), **{n: spark.read.parquet(f"{root}/ods/{n}") for n in marts}}
