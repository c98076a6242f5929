"""Unnesting documents into tables and nesting rows back.

All of it is ``select`` over struct paths plus ``explode``-family
generators; arrays are unnested where they live, inside each task, so a
document never leaves its executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalars import TIMESTAMP_FORMATS, first_or_default, parse_timestamp_any


def order_headers(docs: DataFrame) -> DataFrame:
    """One row per order document (struct members → columns; status is
    lower-cased; created_at parsed best-effort)."""
    return docs.select(
        "order_id", "cart_id", F.col("customer.user_id").alias("user_id"),
        F.col("customer.city").alias("city"), F.lower("status").alias("status"),
        parse_timestamp_any(F.col("created_at"), TIMESTAMP_FORMATS).alias("created_at"),
        F.col("channel.name").alias("channel"), F.col("channel.utm.source").alias("utm_source"),
        F.col("channel.utm.campaign").alias("utm_campaign"))


def unnest_items(docs: DataFrame) -> DataFrame:
    """One row per item; string numbers cast; amount = quantity × price;
    category = first element of the path or 'unknown'."""
    it = docs.select("order_id", F.explode("items").alias("it"))
    q = F.col("it.quantity").cast("int")
    p = F.col("it.unit_price").cast("decimal(12,2)")
    return it.select(
        "order_id", F.col("it.line_no").alias("line_no"), F.col("it.product_id").alias("product_id"),
        F.col("it.sku").alias("sku"), q.alias("quantity"), p.alias("unit_price"),
        (q * p).cast("decimal(14,2)").alias("item_amount"),
        first_or_default(F.col("it.category_path"), "unknown").alias("category"))


def payment_rows(docs: DataFrame) -> DataFrame:
    """The payment object as one row per order."""
    return docs.select("order_id", "payment.payment_id", F.lower("payment.status").alias("payment_status"),
                       F.col("payment.amount").cast("decimal(12,2)").alias("amount"),
                       F.col("payment.currency").alias("currency"))


def payment_attempts(docs: DataFrame) -> DataFrame:
    """One row per attempt with its 1-based position; the error code is
    NULL whether ``error`` is null or absent."""
    a = docs.select("order_id", F.col("payment.payment_id").alias("payment_id"),
                    F.posexplode("payment.attempts").alias("pos", "a"))
    return a.select("order_id", "payment_id", (F.col("pos") + 1).alias("attempt_no"),
                    F.col("a.provider").alias("provider"), F.col("a.status").alias("status"),
                    parse_timestamp_any(F.col("a.attempted_at"), TIMESTAMP_FORMATS).alias("attempted_at"),
                    F.col("a.error.code").alias("error_code"))


def item_adjustments(docs: DataFrame) -> DataFrame:
    """Adjustments per item, keeping items whose list is empty
    (``explode_outer`` gives one row of NULLs)."""
    it = docs.select("order_id", F.explode("items").alias("it"))
    adj = it.select("order_id", F.col("it.line_no").alias("line_no"),
                    F.explode_outer("it.adjustments").alias("adj"))
    return adj.select("order_id", "line_no", F.col("adj.type").alias("adjustment_type"),
                      F.col("adj.amount").cast("decimal(12,2)").alias("adjustment_amount"),
                      F.col("adj.reason").alias("reason"))


def raw_order_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """Raw order table row: header fields, item count (0 without items),
    payment fields, the document's text and the load time.  The text is the
    column ``raw_payload`` where the documents were landed as text, else the
    document written as JSON again.  ``more`` columns of the document follow."""
    return docs.select(
        "order_id", "cart_id", F.col("customer.user_id").alias("user_id"), F.col("customer.city").alias("city"),
        F.lower("status").alias("status"),
        parse_timestamp_any(F.col("created_at"), TIMESTAMP_FORMATS).alias("created_at"),
        F.col("channel.name").alias("channel"),
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).alias("items_count"),
        F.col("payment.payment_id").alias("payment_id"), F.lower("payment.status").alias("payment_status"),
        F.col("payment.amount").cast("decimal(12,2)").alias("payment_amount"),
        F.col("payment.currency").alias("currency"),
        F.col("raw_payload") if "raw_payload" in docs.columns else
        F.to_json(F.struct(*[F.col(c) for c in docs.columns])).alias("raw_payload"),
        F.current_timestamp().alias("loaded_at"), *more)


def nest(rows: DataFrame, key: str, item_cols: list[str], items_name: str = "items") -> DataFrame:
    """Rows → one document per key with a sorted array of item structs.

    The array is the feature: one output row holds one key's items, so the
    size of a group is the size of one document (an order's lines).
    """
    return rows.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in item_cols]))).alias(items_name))


def latest_shipment_status(shipments: DataFrame) -> DataFrame:
    """Unnest shipment events and keep the latest status per shipment
    (``max_by`` on the event time, ties by status)."""
    ev = shipments.select("shipment_id", "order_id", "provider", F.explode("events").alias("e"))
    ts = parse_timestamp_any(F.col("e.event_time"), TIMESTAMP_FORMATS)
    return (ev.groupBy("shipment_id", "order_id", "provider")
            .agg(F.max_by(F.struct(F.col("e.status").alias("status"), F.col("e.city").alias("city"), ts.alias("ts")),
                          F.struct(ts, F.col("e.status"))).alias("last"))
            .select("shipment_id", "order_id", "provider", F.col("last.status").alias("last_status"),
                    F.col("last.city").alias("last_city"), F.col("last.ts").alias("last_event_at")))


def api_products(pages: DataFrame) -> DataFrame:
    """API page payloads → one typed row per product."""
    return pages.select(F.explode("products").alias("p")).select(
        F.col("p.id").alias("product_id"), F.col("p.price").cast("decimal(12,2)").alias("price"),
        F.col("p.stock").cast("int").alias("stock"))
