"""Projection, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.functions import scalars as fx
from lakemart.operators.casting import as_strings, typed_projection
from lakemart.plans.registry import register

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "decimal(12,2)", "o_orderdate": "timestamp_ntz"}


@register("typed_projection", "P3", oracle="""
SELECT TRY_CAST(o_orderkey AS BIGINT) AS order_id, TRY_CAST(o_custkey AS BIGINT) AS user_id,
       o_orderstatus AS status, CAST(TRY_CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       TRY_CAST(o_orderdate AS TIMESTAMP) AS order_ts, 0 AS _bad_fields
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
             o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
             CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders)
""")
def typed_projection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as text, then typed field by field with a reject count."""
    raw = as_strings(b.table(spark, sf_dir, "orders").select(*ORDER_TYPES))
    typed = typed_projection(raw, ORDER_TYPES, rename={
        "o_orderkey": "order_id", "o_custkey": "user_id", "o_orderstatus": "status",
        "o_totalprice": "amount", "o_orderdate": "order_ts"})
    return typed.withColumn("amount", F.col("amount").cast("double"))


@register("filter_in_agg", "P4", oracle="""
SELECT status, COUNT(*) AS orders_cnt, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM b_orders
WHERE status IN ('paid', 'shipped') AND (amount >= 100000 OR order_date < DATE '1996-01-01')
GROUP BY status
""")
def filter_in_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid/shipped orders that are large or early (IN, AND, OR), counted per status."""
    o = b.orders(spark, sf_dir, statuses=("paid", "shipped"))   # the status letters reach the scan
    return (o.filter(((F.col("amount") >= 100000) | (F.col("order_date") < F.lit("1996-01-01").cast("date"))))
            .groupBy("status").agg(F.count(F.lit(1)).alias("orders_cnt"),
                                   F.sum("amount").cast("double").alias("total_amount")))


def _line_quality(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return li, fx.is_clean("discount", "tax")


@register("rows_clean", "P5", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_discount AS discount, l_tax AS tax
FROM lineitem WHERE l_discount > 0 AND l_tax > 0
""")
def rows_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose discount and tax are both positive (the clean half of D5)."""
    li, clean = _line_quality(spark, sf_dir)
    return li.filter(clean)


@register("rows_bad", "P5", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_discount AS discount, l_tax AS tax
FROM lineitem WHERE NOT COALESCE(l_discount > 0 AND l_tax > 0, FALSE)
""")
def rows_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines failing the clean rule, NULLs included, so clean and bad partition the input."""
    li, clean = _line_quality(spark, sf_dir)
    return li.filter(fx.is_bad(clean))


# Query parameter: the day filtered by the half-open range query.
FILTER_DAY = "1995-01-14"


@register("day_filter", "P6", oracle=f"""
SELECT DATE '{FILTER_DAY}' AS day, COUNT(*) AS orders_cnt FROM orders
WHERE o_orderdate >= TIMESTAMP '{FILTER_DAY}' AND o_orderdate < TIMESTAMP '{FILTER_DAY}' + INTERVAL 1 DAY
""")
def day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one day through a half-open range on the raw timestamp
    (pushed to the scan as two PushedFilters)."""
    o = b.table(spark, sf_dir, "orders").select("o_orderdate")
    return (o.filter(fx.day_range(F.col("o_orderdate"), FILTER_DAY))
            .agg(F.count(F.lit(1)).alias("orders_cnt"))
            .select(F.lit(FILTER_DAY).cast("date").alias("day"), "orders_cnt"))


@register("scalar_strings", "P8", oracle="""
SELECT user_id, upper(city) AS city_upper, substring(email, 1, 8) AS email_prefix,
       split_part(email, '@', 2) AS email_domain, city || '/' || segment AS city_segment,
       CAST(length(email) AS INTEGER) AS email_len
FROM b_users
""")
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String functions on users: upper, prefix, e-mail domain, concatenation, length."""
    u = b.users(spark, sf_dir)
    return u.select("user_id", F.upper("city").alias("city_upper"),
                    F.substring("email", 1, 8).alias("email_prefix"),
                    fx.email_domain(F.col("email")).alias("email_domain"),
                    F.concat_ws("/", "city", "segment").alias("city_segment"),
                    F.length("email").alias("email_len"))


@register("scalar_dates", "P2/P9", oracle="""
SELECT order_id, order_date,
       CAST(date_trunc('month', order_date) AS DATE) AS order_month,
       CAST(year(order_date) * 100 + month(order_date) AS INTEGER) AS order_yyyymm,
       CAST(order_date + INTERVAL 7 DAY AS DATE) AS due_date,
       CAST(order_date AS TIMESTAMP) AS order_ts,
       strftime(order_date, '%Y-%m-%d') AS order_date_text,
       CAST(strptime(strftime(order_date, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed_date
FROM b_orders
""")
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date functions: month start, YYYYMM number, date + 7 days, timestamp cast, format and parse."""
    o = b.orders(spark, sf_dir).select("order_id", "order_date")
    text = F.date_format("order_date", "yyyy-MM-dd")
    return (o.withColumn("order_month", fx.month_start(F.col("order_date")))
            .withColumn("order_yyyymm", fx.yyyymm(F.col("order_date")))
            .withColumn("due_date", F.date_add("order_date", 7))
            .withColumn("order_ts", F.col("order_date").cast("timestamp_ntz"))
            .withColumn("order_date_text", text)
            .withColumn("parsed_date", F.to_date(text, "yyyy-MM-dd")))


@register("scalar_math", "P10", oracle="""
SELECT order_id, line_no, CAST(quantity * price AS DOUBLE) AS gross,
       CAST(round(quantity * price * CAST(discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS discount_amount,
       CAST(quantity * price - round(quantity * price * CAST(discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS net,
       quantity % 7 AS qty_mod7, CAST(abs(price - line_amount) AS DOUBLE) AS abs_gap,
       CASE WHEN line_amount = 0 THEN NULL
            ELSE CAST(quantity * price AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(line_amount AS DOUBLE) END AS pct_of_line
FROM b_items
""")
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line arithmetic: gross, discount amount rounded to cents, net, modulo, abs, percent with a zero guard."""
    i = b.order_items(spark, sf_dir)
    gross = F.col("quantity") * F.col("price")
    disc = F.round(gross * fx.rate_as_decimal(F.col("discount")), 2)
    return i.select("order_id", "line_no", gross.cast("double").alias("gross"),
                    disc.cast("double").alias("discount_amount"),
                    (gross - disc).cast("double").alias("net"),
                    (F.col("quantity") % 7).alias("qty_mod7"),
                    F.abs(F.col("price") - F.col("line_amount")).cast("double").alias("abs_gap"),
                    fx.safe_pct(gross, F.col("line_amount")).alias("pct_of_line"))


@register("array_first_or_default", "P11", oracle="""
SELECT product_id, CAST(len(string_split(product_name, ' ')) AS INTEGER) AS words_cnt,
       COALESCE(string_split(product_name, ' ')[1], 'unknown') AS first_word,
       COALESCE(string_split(product_name, ' ')[3], 'unknown') AS third_word
FROM b_products
""")
def array_first_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-name words as an array: size, first word, third word or 'unknown'."""
    words = F.split(F.col("product_name"), " ")
    return b.products(spark, sf_dir).select(
        "product_id", F.size(words).alias("words_cnt"),
        fx.first_or_default(words, "unknown").alias("first_word"),
        F.coalesce(F.get(words, 2), F.lit("unknown")).alias("third_word"))


@register("json_parse_props", "S7", oracle="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(to_json(struct_pack(k := CAST(json_extract_string(props, '$.k') AS INTEGER))) AS VARCHAR) AS props_json
FROM events
""")
def json_parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text → struct (``from_json``) → member, and back to text."""
    ev = b.events(spark, sf_dir).select(
        "event_id", F.from_json("props", "k int").alias("p"))
    return ev.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("props_json"))


@register("map_explode", "P13", oracle="""
SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS INTEGER) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
""")
def map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open key/value bag: parse as MAP and explode to (key, value) rows."""
    ev = b.events(spark, sf_dir).select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return ev.select("event_id", F.explode("m").alias("key", "value"))


@register("order_size_label", "P14", oracle="""
SELECT order_id, CAST(amount AS DOUBLE) AS amount,
       CASE WHEN amount >= 300000 THEN 'large' WHEN amount >= 100000 THEN 'medium' ELSE 'small' END AS size_label
FROM b_orders
""")
def order_size_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's amount with a size band label (CASE WHEN)."""
    return b.orders(spark, sf_dir).select(
        "order_id", F.col("amount").cast("double").alias("amount"),
        fx.size_label(F.col("amount")).alias("size_label"))


@register("dedupe_full_row", "P15", oracle="""
SELECT DISTINCT order_id, line_no, product_id, quantity, dt FROM b_items
""")
def dedupe_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-row duplicates dropped (the line key itself is not unique)."""
    return (b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "quantity", "dt")
            .dropDuplicates())


@register("filled_event_props", "P15", oracle="""
SELECT event_id, COALESCE(CAST(json_extract_string(props, '$.missing') AS VARCHAR), 'none') AS note,
       COALESCE(CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS BIGINT) END, -1) AS user_id
FROM events
""")
def filled_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values replaced per column (a JSON member that is absent, a
    user that is unknown)."""
    ev = b.events(spark, sf_dir).select(
        "event_id", F.get_json_object("props", "$.missing").alias("note"),
        F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"))
    return fx.fill_missing(ev, {"note": "none", "user_id": -1})
