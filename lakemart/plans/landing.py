"""Raw inputs over the driver tables: untouched payloads, JSON documents, paged
answers, and reads that reject what does not fit (SURVEY §2.1 S3, S5, S13–S16,
§2.3 N1, N3, N6, M4).

Each query writes whole driver tables as the raw form in question, lands or
reads them as a job would, and returns the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart import schemas
from lakemart.operators.keyed import BucketTable
from lakemart.operators.nested import raw_order_rows, unnest_items
from lakemart.plans.registry import register
from lakemart.session import scratch_path
from lakemart.sources import rejects
from lakemart.sources.sinks import land_payloads

# ---- payloads landed byte for byte (S16) -----------------------------------


@register("raw_payload_digests", "S16", oracle="""
SELECT CAST(ts AS DATE) AS dt,
       sha256(concat_ws('|', event_id, user_id, event_type, props)) AS payload_sha256, TRUE AS intact
FROM events
""")
def raw_payload_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of events landed untouched with their digest, every day
    twice (a re-landed day replaces itself); the digests of what was read back
    are computed again."""
    root = scratch_path(spark, "payloads")
    lines = b.events(spark, sf_dir).select(
        F.to_date("ts").alias("dt"), F.concat_ws("|", *[F.col(c).cast("string") for c in ("event_id", "user_id", "event_type", "props")]))
    # Where there is no event, no day is written to read back.
    if lines.isEmpty():
        return lines.select("dt", F.lit(None).cast("string").alias("payload_sha256"), F.lit(None).cast("boolean").alias("intact"))
    lines.hint("rebalance", "dt").write.partitionBy("dt").text(f"{root}/source")
    source = spark.read.schema("value string, dt date").option("lineSep", "\n").text(f"{root}/source")
    for _ in range(2):
        path = land_payloads(source, f"{root}/lake", "site", "event_lines")
    landed = spark.read.schema("payload binary, sha256 string, dt date").parquet(path)
    again = F.sha2("payload", 256)
    return landed.select("dt", again.alias("payload_sha256"), (again == F.col("sha256")).alias("intact"))


# ---- order documents as text (N1, N3, N6, M4, S5) ---------------------------

_DOCUMENTS = """
, doc_lines AS (SELECT i.order_id, string_agg('{"line_no":' || i.line_no || ',"product_id":' || i.product_id || ',"sku":"SKU-' || i.product_id
    || '","quantity":"' || i.quantity || '","unit_price":"' || i.price || '","category_path":'
    || CASE WHEN p.category IS NULL OR i.product_id % 7 = 0 THEN '[]' ELSE '["' || p.category || '"]' END || '}', ','
    ORDER BY i.line_no, i.product_id, i.quantity, i.price) AS items, COUNT(*) AS n
  FROM b_items i LEFT JOIN b_products p ON p.product_id = i.product_id GROUP BY i.order_id),
docs AS (SELECT o.*, u.city, coalesce(l.n, 0) AS n, CASE WHEN o.order_id % 30 = 2 THEN 'soon' WHEN o.order_id % 3 = 1 THEN strftime(o.order_date, '%Y-%m-%d')
      ELSE strftime(o.order_date, '%Y-%m-%d') || ' 10:20:30' END AS created_text,
    CASE o.order_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END AS channel,
    '{"order_id":' || o.order_id || ',"cart_id":' || o.order_id * 10 || ',"customer":{"user_id":' || o.user_id || ',"city":"' || u.city
    || '"},"status":"' || upper(o.status) || '","created_at":"' || created_text || '","channel":{"name":"' || channel || '","utm":'
    || CASE WHEN o.order_id % 4 = 0 THEN 'null' ELSE '{"source":"s' || o.order_id % 5 || '","campaign":"c' || o.order_id % 9 || '"}' END
    || '},"payment":{"payment_id":"P' || o.order_id || '","status":"' || CASE WHEN o.status = 'paid' THEN 'OK' ELSE 'WAIT' END
    || '","amount":"' || o.amount || '","currency":"USD"}' || coalesce(',"items":[' || l.items || ']', '') || '}' AS payload
  FROM b_orders o JOIN b_users u ON u.user_id = o.user_id LEFT JOIN doc_lines l ON l.order_id = o.order_id)
"""


def order_document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, value): each order as the JSON text of a raw feed.  Numbers
    are quoted, times come in two forms or none, channel details, category and
    items may be missing."""
    s = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    cats = b.products(spark, sf_dir).select("product_id", "category")
    lines = b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "quantity", "price").join(cats, "product_id", "left")
    no_category = F.col("category").isNull() | (F.col("product_id") % 7 == 0)
    path = F.when(no_category, "[]}").otherwise(F.concat(F.lit('["'), F.col("category"), F.lit('"]}')))
    text = lambda x: F.concat(
        F.lit('{"line_no":'), s(x["line_no"]), F.lit(',"product_id":'), s(x["product_id"]), F.lit(',"sku":"SKU-'), s(x["product_id"]),
        F.lit('","quantity":"'), s(x["quantity"]), F.lit('","unit_price":"'), s(x["price"]), F.lit('","category_path":'), x["path"])
    # An array holds one order's lines: the document itself.  Their text is
    # made where they have met, so the shuffle moves numbers.
    items = lines.groupBy("order_id").agg(F.sort_array(F.collect_list(F.struct(
        "line_no", "product_id", "quantity", "price", path.alias("path")))).alias("lines")).select(
        "order_id", F.array_join(F.transform("lines", text), ",").alias("items"))
    o = b.orders(spark, sf_dir).join(b.users(spark, sf_dir).select("user_id", "city"), "user_id").join(items, "order_id", "left")
    i, day = F.col("order_id"), F.date_format("order_date", "yyyy-MM-dd")
    created = F.when(i % 30 == 2, "soon").when(i % 3 == 1, day).otherwise(F.concat(day, F.lit(" 10:20:30")))
    utm = F.when(i % 4 == 0, "null").otherwise(F.concat(F.lit('{"source":"s'), s(i % 5), F.lit('","campaign":"c'), s(i % 9), F.lit('"}')))
    return o.select("order_id", F.concat(
        F.lit('{"order_id":'), s(i), F.lit(',"cart_id":'), s(i * 10), F.lit(',"customer":{"user_id":'), s("user_id"), F.lit(',"city":"'),
        F.col("city"), F.lit('"},"status":"'), F.upper("status"), F.lit('","created_at":"'), created, F.lit('","channel":{"name":"'),
        F.when(i % 3 == 0, "web").when(i % 3 == 1, "app").otherwise("store"), F.lit('","utm":'), utm,
        F.lit('},"payment":{"payment_id":"P'), s(i), F.lit('","status":"'), F.when(F.col("status") == "paid", "OK").otherwise("WAIT"),
        F.lit('","amount":"'), s("amount"), F.lit('","currency":"USD"}'),
        F.coalesce(F.concat(F.lit(',"items":['), F.col("items"), F.lit("]")), F.lit("")), F.lit("}")).alias("value"))


def landed_documents(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Order documents landed as text lines, parsed under the declared nested
    schema; ``raw_payload`` keeps the text."""
    day = F.lit("2026-05-20").cast("date").alias("dt")
    path = land_payloads(order_document_text(spark, sf_dir).select("value", day), root, "shop", "order_documents", one_day=True)
    landed = spark.read.schema("payload binary, sha256 string, dt date").parquet(path).select(F.col("payload").cast("string").alias("raw_payload"))
    return landed.select(F.from_json("raw_payload", schemas.ORDER_DOC).alias("d"), "raw_payload").select("d.*", "raw_payload")


@register("raw_order_documents", "N1/N3/N6", oracle=_DOCUMENTS + """
SELECT order_id, order_id * 10 AS cart_id, user_id, city, status,
       CASE WHEN created_text = 'soon' THEN NULL WHEN length(created_text) = 10 THEN created_text || ' 00:00:00' ELSE created_text END AS created_at,
       channel, CASE WHEN order_id % 4 <> 0 THEN 's' || order_id % 5 END AS utm_source,
       CASE WHEN order_id % 4 <> 0 THEN 'c' || order_id % 9 END AS utm_campaign, CAST(n AS INTEGER) AS items_count,
       'P' || order_id AS payment_id, CASE WHEN status = 'paid' THEN 'ok' ELSE 'wait' END AS payment_status,
       CAST(amount AS DOUBLE) AS payment_amount, 'USD' AS currency, sha256(payload) AS payload_sha256
FROM docs
""")
def raw_order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw order table from landed document text: header, channel and
    payment fields, best-effort times and the untouched payload (its digest
    here), loaded twice under the order id."""
    root = scratch_path(spark, "order_documents")
    docs = landed_documents(spark, sf_dir, f"{root}/lake")
    # A payload that does not parse has no order id.
    rows = raw_order_rows(docs.filter(F.col("order_id").isNotNull()), F.col("channel.utm").alias("utm")).drop("loaded_at")
    table = BucketTable(spark, f"{root}/orders_raw", ["order_id"], rows.schema)
    for _ in range(2):
        table.upsert(rows)
    return table.read().select(
        "order_id", "cart_id", "user_id", "city", "status", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        "channel", F.col("utm.source").alias("utm_source"), F.col("utm.campaign").alias("utm_campaign"),
        "items_count", "payment_id", "payment_status", F.col("payment_amount").cast("double").alias("payment_amount"), "currency",
        F.sha2("raw_payload", 256).alias("payload_sha256"))


@register("document_category_revenue", "M4", oracle="""
SELECT CASE WHEN p.category IS NULL OR i.product_id % 7 = 0 THEN 'unknown' ELSE p.category END AS category, COUNT(*) AS items_cnt,
       COUNT(DISTINCT i.order_id) AS orders_cnt, CAST(SUM(i.quantity) AS BIGINT) AS quantity,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS amount
FROM b_items i JOIN b_orders o ON o.order_id = i.order_id JOIN b_users u ON u.user_id = o.user_id
LEFT JOIN b_products p ON p.product_id = i.product_id GROUP BY 1
""")
def document_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category mart from the items of landed documents; items without a
    category path count as 'unknown'."""
    docs = landed_documents(spark, sf_dir, f"{scratch_path(spark, 'category_documents')}/lake")
    return unnest_items(docs).groupBy("category").agg(
        F.count(F.lit(1)).alias("items_cnt"), F.countDistinct("order_id").alias("orders_cnt"),
        F.sum("quantity").cast("bigint").alias("quantity"), F.sum("item_amount").cast("double").alias("amount"))


DOCUMENTS_PER_FILE = 5000


@register("json_array_documents", "S5", oracle="""
SELECT o.order_id, o.user_id, o.status, CAST(o.amount AS DOUBLE) AS amount, CAST(COALESCE(c.n, 0) AS INTEGER) AS items_count
FROM b_orders o JOIN b_users u ON u.user_id = o.user_id
LEFT JOIN (SELECT order_id, COUNT(*) AS n FROM b_items GROUP BY order_id) c ON c.order_id = o.order_id
""")
def json_array_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array files of order documents (a bounded number of documents
    each), read with a declared schema; a file that is no JSON would be a
    reject, and there is none here."""
    root = scratch_path(spark, "json_arrays")
    docs = order_document_text(spark, sf_dir).withColumn("part", F.floor(F.col("order_id") / DOCUMENTS_PER_FILE))
    arrays = docs.groupBy("part").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("part").option("compression", "gzip").text(f"{root}/source")   # no file is ever split
    # The files alone hold the documents; the folder names are no column.
    read = rejects.read_json_documents(spark, f"{root}/source/*", schemas.ORDER_DOC, f"{root}/documents")
    if not read.rejects.isEmpty():
        raise RuntimeError("a file of the source is no JSON")
    return read.rows.select(
        "order_id", F.col("customer.user_id").alias("user_id"), F.lower("status").alias("status"),
        F.col("payment.amount").cast("double").alias("amount"),
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("int").alias("items_count"))


# ---- reads that reject (S3, S13, S14) ---------------------------------------

_SPOILT = 40     # one order in so many has an amount that is no number


@register("csv_rejects", "S3/S13", oracle=f"""
SELECT order_id, CASE WHEN order_id % {_SPOILT} <> 0 THEN CAST(amount AS DOUBLE) END AS amount,
       CASE WHEN order_id % {_SPOILT} <> 0 THEN 'row' ELSE 'reject' END AS outcome
FROM b_orders
""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited text of which some lines do not fit the declared types: those
    become rejects with their text, never NULLs among the rows."""
    root = scratch_path(spark, "csv_rejects")
    amount = F.when(F.col("order_id") % _SPOILT == 0, "n/a").otherwise(F.col("amount").cast("string"))
    b.orders(spark, sf_dir).select("order_id", "status", amount.alias("amount")).write.csv(f"{root}/source")
    read = rejects.read_with_rejects(spark, f"{root}/source", "order_id BIGINT, status STRING, amount DECIMAL(12,2)", "csv", f"{root}/read")
    return read.rows.select("order_id", F.col("amount").cast("double").alias("amount"), F.lit("row").alias("outcome")).unionByName(
        read.rejects.select(F.split(rejects.RECORD, ",")[0].cast("bigint").alias("order_id"), F.lit(None).cast("double").alias("amount"),
                            F.lit("reject").alias("outcome")))


@register("stream_message_rejects", "S14/ST2", oracle="""
SELECT event_id, event_type, value, CASE WHEN event_id % 50 = 7 THEN 'reject' ELSE 'row' END AS outcome
FROM (SELECT event_id, CASE WHEN event_id % 50 <> 7 THEN event_type END AS event_type,
             CASE WHEN event_id % 50 <> 7 THEN value END AS value FROM events) e
""")
def stream_message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of JSON messages, some of them cut short: whole ones are
    upserted by event, cut ones go to rejects; started twice."""
    from lakemart.streaming.streams import file_stream

    root, schema = scratch_path(spark, "messages"), "event_id BIGINT, event_type STRING, value DOUBLE"
    text = F.to_json(F.struct("event_id", "event_type", "value"))
    cut = F.when(F.col("event_id") % 50 == 7, F.substring_index(text, ",", 1)).otherwise(text)
    b.events(spark, sf_dir).select(cut.alias("value")).write.text(f"{root}/source")
    table = BucketTable(spark, f"{root}/events", ["event_id"], schema)
    for _ in range(2):
        messages = rejects.typed_messages(file_stream(spark, f"{root}/source", "value string", "text"), schema)
        rejects.load_messages(messages, table, f"{root}/rejects", f"{root}/checkpoint")
    bad = spark.read.schema(f"{rejects.RECORD} string").parquet(f"{root}/rejects")
    return table.read().withColumn("outcome", F.lit("row")).unionByName(bad.select(
        F.regexp_extract(rejects.RECORD, r'"event_id":(\d+)', 1).cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"), F.lit("reject").alias("outcome")))


# ---- a paged answer (S15) ---------------------------------------------------

PAGE_ROWS, WINDOW_ROWS = 30, 90


@register("paged_products", "S15", oracle="""
SELECT p_partkey AS id, p_name AS title, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(p_size AS BIGINT) AS stock FROM part
""")
def paged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products read through the paged source from answers kept as files.  A
    window asks for three pages' rows and each answer is capped at one page,
    so every window follows up twice; windows are read in parallel."""
    from lakemart.sources import api

    root = scratch_path(spark, "pages")
    parts = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("double").alias("price"), F.col("p_size").cast("bigint").alias("stock"))
    url = api.write_pages(parts, root, "id", PAGE_ROWS)
    api.register(spark)
    return spark.read.format("paged_api").option("url", url).option("limit", WINDOW_ROWS).load().select("id", "title", "price", "stock")
