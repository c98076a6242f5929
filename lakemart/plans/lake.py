"""Keyed loads, layout and data-quality jobs.

Each query runs the load against a fresh folder under the lake root (shared
storage), usually twice, and returns what a reader sees afterwards — so the
registered answer also proves the load is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.keyed import BucketTable, Dimension
from lakemart.operators.layout import write_partitioned
from lakemart.operators.loads import (
    SummingTable, VersionedTable, latest_per_key, load_dimension, month_ranges, route_by_ranges,
)
from lakemart.operators.quality import constraint_report
from lakemart.operators.skew import key_histogram as _key_histogram
from lakemart.operators.skew import skewed_events
from lakemart.plans.registry import register
from lakemart.session import bucket_count, scratch_path


@register("load_users_if_absent", "L1", oracle="""
SELECT DISTINCT u.user_id, u.email, u.city
FROM b_orders o JOIN b_users u ON u.user_id = o.user_id
""")
def load_users_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension loaded from order rows (one user row per order, so the
    batch repeats keys): first row per key wins, existing keys are left
    alone, and the second run inserts nothing."""
    batch = (b.orders(spark, sf_dir).select("user_id")
             .join(b.users(spark, sf_dir).select("user_id", "email", "city"), "user_id"))
    t = BucketTable(spark, scratch_path(spark, "dim_users"), ["user_id"], "user_id bigint, email string, city string",
                    bucket_count(spark, batch))
    t.insert_if_absent(batch)
    t.insert_if_absent(batch)
    return t.read()


def load_dimension_keys(t: VersionedTable, keys: DataFrame, key: str, id_col: str) -> int:
    """L2 on a versioned table: dense surrogate ids for keys not in the
    dimension yet, continuing after the current maximum id (NULL equals NULL).
    Returns the current version."""
    load_dimension(t, keys.select(key), [key], id_col, [])
    return t.current_version()


@register("dim_surrogate_keys", "L2", oracle="""
SELECT COUNT(*) AS keys_cnt, COUNT(*) AS distinct_ids,
       CASE WHEN COUNT(*) > 0 THEN CAST(1 AS BIGINT) END AS min_id,
       CASE WHEN COUNT(*) > 0 THEN COUNT(*) END AS max_id
FROM b_products
""")
def dim_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate ids for products, loaded from sold lines and then from all
    products: each load appends its new keys only, and ids stay unique and
    dense 1..n."""
    t = Dimension(spark, scratch_path(spark, "dim_products"), ["product_id"], "product_sk",
                  "product_id bigint, product_sk bigint")
    t.add(b.order_items(spark, sf_dir).select("product_id").join(
        b.products(spark, sf_dir).select("product_id"), "product_id", "left_semi"))
    t.add(b.products(spark, sf_dir).select("product_id"))
    return t.read().agg(F.count(F.lit(1)).alias("keys_cnt"),
                        F.countDistinct("product_sk").alias("distinct_ids"),
                        F.min("product_sk").alias("min_id"), F.max("product_sk").alias("max_id"))


@register("upsert_orders", "L3", oracle="""
SELECT order_id, user_id, order_date,
       CASE WHEN status = 'created' THEN 'shipped' ELSE status END AS status,
       CAST(amount AS DOUBLE) AS amount
FROM b_orders
""")
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded, then every created order re-stated as shipped by an
    upsert batch (applied twice: the second run changes nothing)."""
    o = b.orders(spark, sf_dir)
    t = BucketTable(spark, scratch_path(spark, "ods_orders"), ["order_id"], o.schema, bucket_count(spark, o))
    t.upsert(o)
    batch = b.orders(spark, sf_dir, statuses=("created",)).withColumn("status", F.lit("shipped"))
    t.upsert(batch)
    t.upsert(batch)
    return t.read().withColumn("amount", F.col("amount").cast("double"))


@register("latest_version_per_key", "L7", oracle="""
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT user_id, event_type, event_id, ts, value,
         ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1
""")
def latest_version_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versions of a (user, event type) row; the read keeps the
    latest by (ts, event_id)."""
    ev = b.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"])


@register("summing_rollup", "L8", oracle="""
SELECT CAST(ts AS DATE) AS event_date, event_type, 2 * COUNT(*) AS events_cnt,
       CAST(2 * SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1, 2
""")
def summing_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event rollup appended twice to an additive table (counts and sums
    double); a replay of the second batch changes nothing."""
    delta = (b.events(spark, sf_dir)
             .groupBy(F.to_date("ts").alias("event_date"), "event_type")
             .agg(F.count(F.lit(1)).alias("events_cnt"),
                  F.sum(F.col("value").cast("decimal(12,2)")).alias("value_sum")))
    t = SummingTable(spark, scratch_path(spark, "rollup"), ["event_date", "event_type"],
                     ["events_cnt", "value_sum"])
    t.add(delta)
    for _ in range(2):
        t.add(delta, batch_id="second")
    return t.read_summed().select("event_date", "event_type",
                                  F.col("events_cnt").cast("bigint").alias("events_cnt"),
                                  F.col("value_sum").cast("double").alias("value_sum"))


# Declared monthly ranges of the orders mart (from a rule: 72 months).
RANGE_FIRST_MONTH = "1995-01-01"
RANGE_MONTHS = 72


@register("range_partition_route", "L9", oracle="""
SELECT order_id, order_date,
       CASE WHEN order_date >= DATE '1995-01-01' AND order_date < DATE '2001-01-01'
            THEN 'p' || strftime(order_date, '%Y_%m') ELSE 'rejected' END AS partition_name
FROM b_orders
""")
def range_partition_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders routed to declared month ranges; rows outside every range go
    to a reject partition instead of failing the load.  All rows are routed
    and written once."""
    o = b.orders(spark, sf_dir).select("order_id", "order_date")
    routed = route_by_ranges(o, "order_date", month_ranges(spark, RANGE_FIRST_MONTH, RANGE_MONTHS))
    root = scratch_path(spark, "orders_by_month")
    write_partitioned(routed, root, ["partition_name"], sort_cols=["order_date", "order_id"])
    # Read back with the known schema: an empty partitioned write leaves no
    # file to infer it from.
    return spark.read.schema(routed.schema).parquet(root).select("order_id", "order_date", "partition_name")


# Days re-delivered by the second load of the partitioned event table.
REDELIVERY_FROM = "2024-01-15"


def _write_events_partitioned(spark: SparkSession, sf_dir: str):
    """Events written by day (30 partitions), then the days from
    ``REDELIVERY_FROM`` delivered again: a dynamic overwrite replaces only
    those day partitions."""
    ev = b.events(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    path = scratch_path(spark, "events_by_day")
    write_partitioned(ev, path, ["event_date"], sort_cols=["ts", "event_id"])
    again = ev.filter(F.col("event_date") >= F.lit(REDELIVERY_FROM).cast("date"))
    write_partitioned(again, path, ["event_date"], sort_cols=["ts", "event_id"], dynamic=True)
    return path, ev.schema


@register("events_partitioned", "L10", oracle="""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events
""")
def events_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by day with a dynamic re-delivery of later days, read back whole."""
    path, schema = _write_events_partitioned(spark, sf_dir)
    return spark.read.schema(schema).parquet(path).select("event_id", "user_id", "event_type", "event_date")


PRUNE_FROM, PRUNE_TO = "2024-01-10", "2024-01-12"


@register("partition_pruned_read", "P7", oracle=f"""
SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS events_cnt FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{PRUNE_FROM}' AND DATE '{PRUNE_TO}' GROUP BY 1
""")
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter on the partition column: only three day folders are listed
    and read (``PartitionFilters`` in the scan)."""
    path, schema = _write_events_partitioned(spark, sf_dir)
    ev = spark.read.schema(schema).parquet(path)
    return (ev.filter(F.col("event_date").between(F.lit(PRUNE_FROM).cast("date"), F.lit(PRUNE_TO).cast("date")))
            .groupBy("event_date").agg(F.count(F.lit(1)).alias("events_cnt")))


@register("key_histogram", "L14", oracle="""
, k AS (SELECT CASE WHEN event_id % 10 < 8 THEN 'hot' ELSE 'k' || CAST(user_id AS VARCHAR) END AS skew_key
        FROM events)
SELECT skew_key, COUNT(*) AS rows_cnt,
       CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM k) AS DOUBLE) AS share
FROM k GROUP BY skew_key
""")
def key_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per key of the skewed event stream and each key's share."""
    return _key_histogram(skewed_events(b.events(spark, sf_dir)), "skew_key")


@register("v_sales_lines", "L16", oracle="""
SELECT i.order_id, i.line_no, o.order_date, o.status, i.product_id, i.quantity,
       CAST(i.quantity * i.price AS DOUBLE) AS line_total
FROM b_items i JOIN b_orders o ON o.order_id = i.order_id WHERE o.status IN ('paid', 'shipped')
""")
def v_sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL view over the bound views (``CREATE OR REPLACE TEMP VIEW``)."""
    v = b.register_views(spark, sf_dir, b.unique_suffix())
    spark.sql(f"""
        CREATE OR REPLACE TEMP VIEW v_sales_lines AS
        SELECT i.order_id, i.line_no, o.order_date, o.status, i.product_id, i.quantity,
               CAST(i.quantity * i.price AS DOUBLE) AS line_total
        FROM {v['b_items']} i JOIN {v['b_orders']} o ON o.order_id = i.order_id
        WHERE o.status IN ('paid', 'shipped')""")
    return spark.table("v_sales_lines")


@register("constraint_violations", "DQ1", oracle="""
SELECT 'order_items' AS table_name, 'pk_order_line' AS rule,
       (SELECT COUNT(*) FROM (SELECT order_id, line_no FROM b_items GROUP BY 1, 2 HAVING COUNT(*) > 1)) AS violations_cnt
UNION ALL SELECT 'order_items', 'not_null', COUNT(*) FILTER (WHERE order_id IS NULL OR product_id IS NULL OR quantity IS NULL OR price IS NULL) FROM b_items
UNION ALL SELECT 'order_items', 'check_quantity_positive', COUNT(*) FILTER (WHERE quantity <= 0) FROM b_items
UNION ALL SELECT 'order_items', 'check_price_non_negative', COUNT(*) FILTER (WHERE price < 0) FROM b_items
UNION ALL SELECT 'order_items', 'fk_order', COUNT(*) FROM b_items i WHERE NOT EXISTS (SELECT 1 FROM b_orders o WHERE o.order_id = i.order_id)
UNION ALL SELECT 'order_items', 'fk_product', COUNT(*) FROM b_items i WHERE NOT EXISTS (SELECT 1 FROM b_products p WHERE p.product_id = i.product_id)
UNION ALL SELECT 'orders', 'pk_order', (SELECT COUNT(*) FROM (SELECT order_id FROM b_orders GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'orders', 'not_null', COUNT(*) FILTER (WHERE order_id IS NULL OR user_id IS NULL OR order_date IS NULL OR status IS NULL OR amount IS NULL) FROM b_orders
UNION ALL SELECT 'orders', 'check_status', COUNT(*) FILTER (WHERE status IS NULL OR status NOT IN ('paid', 'shipped', 'created')) FROM b_orders
UNION ALL SELECT 'orders', 'check_amount_non_negative', COUNT(*) FILTER (WHERE amount < 0) FROM b_orders
UNION ALL SELECT 'orders', 'fk_user', COUNT(*) FROM b_orders o WHERE NOT EXISTS (SELECT 1 FROM b_users u WHERE u.user_id = o.user_id)
""")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PK / NOT NULL / CHECK / FK rules of the shop schema as a violations
    table (one row per rule, zero included)."""
    return constraint_report(b.order_items(spark, sf_dir), b.orders(spark, sf_dir),
                             b.products(spark, sf_dir), b.users(spark, sf_dir))


@register("full_refresh_orders", "L5", oracle="""
SELECT order_id, user_id, status, CAST(amount AS DOUBLE) AS amount FROM b_orders
""")
def full_refresh_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncate + insert: the table is refreshed from its source twice; the
    reader sees exactly the last load."""
    t = VersionedTable(spark, scratch_path(spark, "refresh_orders"))
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "status", "amount")
    t.overwrite(o)
    t.overwrite(o)
    return t.read().withColumn("amount", F.col("amount").cast("double"))


@register("copy_between_tables", "L6", oracle="""
SELECT user_id, city FROM b_users UNION ALL SELECT user_id, city FROM b_users
""")
def copy_between_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``INSERT INTO target SELECT * FROM source`` run twice into an empty
    table: the target holds the source rows twice (bag semantics)."""
    from lakemart.operators.layout import copy_table
    from lakemart.session import create_layers
    from lakemart.sources.sinks import save_table

    create_layers(spark, ("stg",))
    root = scratch_path(spark, "copy")
    tag = root.rsplit("-", 1)[-1]
    src, dst = f"stg.users_src_{tag}", f"stg.users_dst_{tag}"
    save_table(b.users(spark, sf_dir).select("user_id", "city"), src, path=f"{root}/src")
    spark.sql(f"CREATE TABLE {dst} (user_id BIGINT, city STRING) USING parquet LOCATION '{root}/dst'")
    copy_table(spark, src, dst)
    copy_table(spark, src, dst)
    return spark.table(dst)


@register("orders_month_layout", "L11", oracle="""
SELECT order_id, user_id, order_date, CAST(year(order_date) * 100 + month(order_date) AS INTEGER) AS yyyymm
FROM b_orders
""")
def orders_month_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders laid out by month directory and sorted by (date, user, order)
    inside it, so month filters prune directories and date ranges skip row
    groups; read back whole."""
    from lakemart.functions.scalars import yyyymm

    o = b.orders(spark, sf_dir).select("order_id", "user_id", "order_date")
    path = scratch_path(spark, "orders_by_month")
    laid_out = o.withColumn("yyyymm", yyyymm(F.col("order_date")))
    write_partitioned(laid_out, path, ["yyyymm"], sort_cols=["order_date", "user_id", "order_id"])
    return spark.read.schema(laid_out.schema).parquet(path).select("order_id", "user_id", "order_date", "yyyymm")


@register("compacted_files", "L13", oracle="""
SELECT order_id, line_no, product_id, dt FROM b_items
""")
def compacted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines rewritten into files of the advisory partition size and read back."""
    from lakemart.operators.layout import compact_files

    path = scratch_path(spark, "items_compacted")
    items = b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "dt")
    compact_files(items).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("checked_input_orders", "DQ2", oracle="""
SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders
""")
def checked_input_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input is checked to exist and hold rows before it is used."""
    from lakemart.operators.quality import ensure_not_empty

    if isinstance(sf_dir, b.ViewSet):
        df = b.table(spark, sf_dir, "orders")
    else:
        df = ensure_not_empty(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    return df.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))


@register("events_partitioned_sql", "L10", oracle="""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events
""")
def events_partitioned_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 in SQL: a partitioned table whose ``partitionOverwriteMode`` is
    set on the table (the session setting is left alone); ``INSERT
    OVERWRITE`` loads every day, a second one re-delivers the later days and
    replaces only those partitions."""
    from lakemart.session import create_layers
    from lakemart.sources.sinks import list_partitions

    create_layers(spark, ("raw",))
    path = scratch_path(spark, "events_by_day_sql")
    tag = path.rsplit("-", 1)[-1]
    name, src = f"raw.events_by_day_{tag}", f"events_src_{tag}"
    b.events(spark, sf_dir).createOrReplaceTempView(src)
    spark.sql(f"""CREATE TABLE {name} (event_id BIGINT, user_id BIGINT, event_type STRING, event_date DATE)
                  USING parquet PARTITIONED BY (event_date)
                  OPTIONS ('partitionOverwriteMode' = 'dynamic') LOCATION '{path}'""")
    select = f"SELECT /*+ REBALANCE(event_date) */ event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM {src}"
    spark.sql(f"INSERT OVERWRITE TABLE {name} {select}")
    spark.sql(f"INSERT OVERWRITE TABLE {name} {select} WHERE CAST(ts AS DATE) >= DATE '{REDELIVERY_FROM}'")
    days = b.events(spark, sf_dir).select(F.to_date("ts")).distinct().count()
    if len(list_partitions(spark, name)) != days:
        raise RuntimeError(f"{name}: expected one partition per day")
    return spark.table(name)


HOT_SHARE = 0.01  # a key holding at least 1 % of the rows is "hot"


@register("hot_keys_report", "L14/J13", oracle="""
, k AS (SELECT CASE WHEN event_id % 10 < 8 THEN 'hot' ELSE 'k' || CAST(user_id AS VARCHAR) END AS skew_key
        FROM events),
  c AS (SELECT skew_key, COUNT(*) AS rows_cnt FROM k GROUP BY skew_key)
SELECT skew_key, rows_cnt, CAST(rows_cnt AS DOUBLE) / CAST((SELECT COUNT(*) FROM k) AS DOUBLE) AS share
FROM c WHERE rows_cnt >= (SELECT COUNT(*) FROM k) * 0.01
""")
def hot_keys_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the skewed event stream holding at least 1 % of its rows —
    the groups to split or salt.  At most 100 keys can qualify, so the list
    is small by construction."""
    shares = _key_histogram(skewed_events(b.events(spark, sf_dir)), "skew_key")
    # Division rounds to the nearest double, so a key of exactly 1 % qualifies.
    return shares.filter(F.col("share") >= HOT_SHARE)
