"""The flat order feed loaded into a star schema (SQL ELT).

stg.raw_orders_flat → core.users / core.products (insert-if-absent on the
natural key, dense surrogate ids) → core.orders (surrogate id, user looked up
by natural key) → core.order_items (keyed by source order + source line, so a
re-run adds nothing: D6) → sales lines of paid/shipped orders → daily sales
mart routed to declared month ranges (rows outside every range rejected).
Library functions over a DataFrame of the feed; not registered keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.loads import VersionedTable, load_dimension, month_ranges, route_by_ranges

# The declared columns of the raw flat feed.
FLAT_DDL = ("raw_order_item_id BIGINT, source_order_id BIGINT, source_order_item_id BIGINT, "
            "order_created_at TIMESTAMP_NTZ, order_updated_at TIMESTAMP_NTZ, order_status STRING, "
            "user_external_id STRING, user_name STRING, user_email STRING, user_city STRING, "
            "user_registered_at DATE, product_sku STRING, product_name STRING, product_category STRING, "
            "product_brand STRING, item_quantity INT, item_price DECIMAL(12,2), item_discount DECIMAL(12,2), "
            "payment_method STRING, delivery_type STRING")
SALES_STATUSES = ("paid", "shipped")


class Core:
    def __init__(self, spark: SparkSession, root: str):
        self.users = VersionedTable(spark, f"{root}/core/users", schema=(
            "user_id bigint, user_external_id string, user_name string, user_email string, user_city string"))
        self.products = VersionedTable(spark, f"{root}/core/products", schema=(
            "product_id bigint, product_sku string, product_name string, product_category string, "
            "product_brand string"))
        self.orders = VersionedTable(spark, f"{root}/core/orders", schema=(
            "order_id bigint, source_order_id bigint, user_id bigint, order_status string, "
            "order_created_at timestamp_ntz"))
        self.order_items = VersionedTable(spark, f"{root}/core/order_items", schema=(
            "order_item_id bigint, source_order_id bigint, source_order_item_id bigint, order_id bigint, "
            "product_id bigint, quantity int, unit_price decimal(12,2), discount_amount decimal(12,2), "
            "line_amount decimal(14,2)"))


def load_core(spark: SparkSession, flat: DataFrame, root: str) -> dict[str, int]:
    """One load of the feed; returns rows inserted per table."""
    core = Core(spark, root)
    out = {"users": load_dimension(core.users, flat, ["user_external_id"], "user_id",
                                   ["user_name", "user_email", "user_city"]),
           "products": load_dimension(core.products, flat, ["product_sku"], "product_id",
                                      ["product_name", "product_category", "product_brand"])}
    users = core.users.read().select("user_external_id", "user_id")
    orders_in = flat.join(users, "user_external_id").select(
        "source_order_id", "user_id", "order_status", "order_created_at")
    out["orders"] = load_dimension(core.orders, orders_in, ["source_order_id"], "order_id",
                                   ["user_id", "order_status", "order_created_at"])
    orders = core.orders.read().select("source_order_id", "order_id")
    products = core.products.read().select("product_sku", "product_id")
    lines_in = (flat.join(orders, "source_order_id").join(products, "product_sku")
                .select("source_order_id", "source_order_item_id", "order_id", "product_id",
                        F.col("item_quantity").alias("quantity"), F.col("item_price").alias("unit_price"),
                        F.col("item_discount").alias("discount_amount"),
                        (F.col("item_quantity") * F.col("item_price") - F.col("item_discount"))
                        .cast("decimal(14,2)").alias("line_amount")))
    out["order_items"] = load_dimension(
        core.order_items, lines_in, ["source_order_id", "source_order_item_id"], "order_item_id",
        ["order_id", "product_id", "quantity", "unit_price", "discount_amount", "line_amount"])
    return out


def sales_lines(spark: SparkSession, root: str) -> DataFrame:
    """core.v_sales_lines: paid/shipped lines with gross and net amounts."""
    core = Core(spark, root)
    o = core.orders.read().filter(F.col("order_status").isin(*SALES_STATUSES))
    i = core.order_items.read()
    return o.join(i, "order_id").select(
        F.col("order_created_at").cast("date").alias("sales_dt"),
        (F.col("quantity") * F.col("unit_price")).alias("gross_amount"), "line_amount")


def daily_sales(lines: DataFrame) -> DataFrame:
    """mart.daily_sales: gross and net per day."""
    return lines.groupBy(F.col("sales_dt").alias("dt")).agg(
        F.sum("gross_amount").cast("decimal(14,2)").alias("gross_amount"),
        F.sum("line_amount").cast("decimal(14,2)").alias("line_amount"))


def route_daily_sales(spark: SparkSession, mart: DataFrame, first_month: str, months: int) -> DataFrame:
    """Rows of the range-partitioned mart with their partition, or
    'rejected' for days outside every declared month."""
    return route_by_ranges(mart, "dt", month_ranges(spark, first_month, months, prefix="daily_sales_"))
