"""Sources and sinks over the driver tables.

Each query lands a given table in a file format under the lake root, reads
it back the way a raw source is read (declared schema, no inference) and
returns the rows, so format handling is checked on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.schemas import EVENTS_DDL, NTZ_MICROS
from lakemart.session import scratch_path
from lakemart.sources import files
from lakemart.plans.registry import register
from lakemart.sources.sinks import write_csv, write_parquet


@register("src_csv_strings", "S1", oracle="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_mktsegment
FROM customer
""")
def src_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header CSV read without inference: every column is a string."""
    path = scratch_path(spark, "csv_customer")
    write_csv(b.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), path)
    return files.read_csv_strings(spark, path)


ORDERS_DDL = ("order_id BIGINT, user_id BIGINT, status STRING, amount DECIMAL(12,2), "
              "order_ts TIMESTAMP_NTZ, priority STRING")


@register("src_csv_headerless", "S3", oracle="""
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount, o_orderdate AS order_ts,
       o_orderpriority AS priority
FROM orders
""")
def src_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless delimited text with a declared schema (Hive ``ROW FORMAT
    DELIMITED`` external table)."""
    path = scratch_path(spark, "csv_orders_noheader")
    write_csv(b.table(spark, sf_dir, "orders"), path, header=False)
    df = files.read_csv_typed(spark, path, ORDERS_DDL, header=False, mode="FAILFAST")
    return df.withColumn("amount", F.col("amount").cast("double"))


@register("src_jsonl", "S6", oracle="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def src_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines written and read back with a declared schema (microsecond
    timestamps kept by an explicit format)."""
    path = scratch_path(spark, "jsonl_events")
    (b.events(spark, sf_dir).write.mode("overwrite").option("timestampNTZFormat", NTZ_MICROS).json(path))
    return files.read_json_lines(spark, path, EVENTS_DDL, timestampNTZFormat=NTZ_MICROS)


@register("src_remote_schema_csv", "S13", oracle="""
SELECT o_orderstatus AS status, COUNT(*) AS orders_cnt,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount
FROM orders GROUP BY o_orderstatus
""")
def src_remote_schema_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query a CSV in the object store with an explicit schema (the path
    prefix decides local / ``s3a://``), then load from it."""
    path = scratch_path(spark, "bucket_orders_csv")
    write_csv(b.table(spark, sf_dir, "orders"), path, header=True)
    ddl = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DECIMAL(12,2), "
           "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
    df = files.read_csv_typed(spark, path, ddl, header=True)
    return (df.groupBy(F.col("o_orderstatus").alias("status"))
            .agg(F.count(F.lit(1)).alias("orders_cnt"), F.sum("o_totalprice").cast("double").alias("total_amount")))


@register("sink_roundtrip", "S17", oracle="""
SELECT order_id, line_no, product_id, quantity, CAST(line_amount AS DOUBLE) AS line_amount,
       CAST(price AS DOUBLE) AS price, dt
FROM b_items
""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet overwrite written twice to the same path (the second run
    replaces, not appends), then read back."""
    items = b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "quantity",
                                                "line_amount", "price", "dt")
    path = scratch_path(spark, "items_parquet")
    write_parquet(items, path)
    write_parquet(items, path)
    out = spark.read.parquet(path)
    return out.select("order_id", "line_no", "product_id", "quantity",
                      F.col("line_amount").cast("double").alias("line_amount"),
                      F.col("price").cast("double").alias("price"), "dt")


@register("src_csv_inferred", "S2", oracle="""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       c_acctbal, c_mktsegment
FROM customer
""")
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header CSV read with inferred types (an extra pass over the file to
    infer; exploration only — jobs declare schemas)."""
    path = scratch_path(spark, "csv_customer_inferred")
    write_csv(b.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                         "c_mktsegment"), path)
    return files.read_csv_inferred(spark, path)


@register("raw_landing_roundtrip", "S16", oracle="""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS dt FROM events
""")
def raw_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed untouched as JSON at raw/<source>/<entity>/dt=…/, landed
    again (a re-landed day replaces itself), then read back."""
    from lakemart.sources.sinks import land_raw

    root = scratch_path(spark, "lake")
    ev = b.events(spark, sf_dir).withColumn("dt", F.to_date("ts"))
    land_raw(ev, root, "site", "events")
    path = land_raw(ev, root, "site", "events")
    return (spark.read.schema(EVENTS_DDL + ", dt DATE").option("timestampNTZFormat", NTZ_MICROS).json(path)
            .select("event_id", "user_id", "event_type", "dt"))


@register("catalog_table_roundtrip", "S18/S21", oracle="""
SELECT order_id, user_id, status, CAST(amount AS DOUBLE) AS amount FROM b_orders
""")
def catalog_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved as a catalog table in the ods database (overwritten per run),
    found by a catalog listing and read back by name."""
    from lakemart.session import create_layers
    from lakemart.sources.sinks import list_tables, save_table

    create_layers(spark, ("ods",))
    path = scratch_path(spark, "ods_orders_table")
    name = "orders_" + path.rsplit("-", 1)[-1]
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "status", "amount")
    save_table(o, f"ods.{name}", path=path)
    save_table(o, f"ods.{name}", path=path)
    if name not in list_tables(spark, "ods", like=name):
        raise RuntimeError(f"ods.{name} missing from the catalog")
    return spark.table(f"ods.{name}").withColumn("amount", F.col("amount").cast("double"))


@register("compressed_columnar_roundtrip", "S19", oracle="""
SELECT order_id, line_no, product_id, quantity, CAST(line_amount AS DOUBLE) AS line_amount FROM b_items
""")
def compressed_columnar_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written column-oriented with gzip (zlib) compression and read back."""
    path = scratch_path(spark, "items_gzip")
    items = b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "quantity", "line_amount")
    write_parquet(items, path, compression="gzip")
    return spark.read.parquet(path).withColumn("line_amount", F.col("line_amount").cast("double"))


@register("memory_table_read", "S20", oracle="""
SELECT status, COUNT(*) AS orders_cnt FROM b_orders GROUP BY status
""")
def memory_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An in-memory table (cached temp view) queried by SQL inside its scope:
    the answer is written before the memory is given back."""
    from lakemart.sources.sinks import drop_memory_table, memory_table

    path = scratch_path(spark, "memory_table")
    name = "mem_orders_" + path.rsplit("-", 1)[-1]
    memory_table(b.orders(spark, sf_dir).select("order_id", "status"), name)
    try:
        answer = spark.sql(f"SELECT status, COUNT(*) AS orders_cnt FROM {name} GROUP BY status")
        answer.write.parquet(path)
    finally:
        drop_memory_table(spark, name)
    return spark.read.schema(answer.schema).parquet(path)


@register("external_csv_table", "S3/S13", oracle="""
SELECT o_orderstatus AS status, COUNT(*) AS orders_cnt,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount
FROM orders GROUP BY o_orderstatus
""")
def external_csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table declared over headerless CSV files (``CREATE TABLE
    … USING csv … LOCATION`` with the column DDL), queried with SQL."""
    from lakemart.session import create_layers

    create_layers(spark, ("raw",))
    path = scratch_path(spark, "raw_orders_csv")
    write_csv(b.table(spark, sf_dir, "orders"), path, header=False)
    name = "raw.orders_csv_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE TABLE {name} ({ORDERS_DDL}) USING csv OPTIONS (header 'false', mode 'FAILFAST') LOCATION '{path}'")
    return spark.sql(f"""SELECT status, COUNT(*) AS orders_cnt, CAST(SUM(amount) AS DOUBLE) AS total_amount
                         FROM {name} GROUP BY status""")


ITEMS_DDL = "order_id BIGINT, line_no INT, product_id BIGINT, quantity INT, price DECIMAL(12,2)"


@register("bulk_copy_checked", "S4", oracle="""
SELECT 'order_items' AS table_name, 'pk_order_line' AS rule,
       (SELECT COUNT(*) FROM (SELECT order_id, line_no FROM b_items GROUP BY 1, 2 HAVING COUNT(*) > 1))
         AS violations_cnt
UNION ALL SELECT 'order_items', 'not_null',
       COUNT(*) FILTER (WHERE order_id IS NULL OR product_id IS NULL OR quantity IS NULL OR price IS NULL) FROM b_items
UNION ALL SELECT 'order_items', 'check_quantity_positive', COUNT(*) FILTER (WHERE quantity <= 0) FROM b_items
UNION ALL SELECT 'order_items', 'check_price_non_negative', COUNT(*) FILTER (WHERE price < 0) FROM b_items
""")
def bulk_copy_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk copy of a header CSV into a typed table (``COPY … WITH (FORMAT
    csv, HEADER)``): declared schema, FAILFAST on malformed rows, then the
    table's key and CHECK constraints as a violations report."""
    from functools import reduce

    from lakemart.operators.quality import duplicate_keys, row_rules

    path = scratch_path(spark, "copy_items_csv")
    write_csv(b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", "quantity", "price"), path)
    items = files.read_csv_typed(spark, path, ITEMS_DDL, header=True, mode="FAILFAST")
    c = F.col
    parts = [
        duplicate_keys(items, "order_items", "pk_order_line", ["order_id", "line_no"]),
        row_rules(items, "order_items", {
            "not_null": c("order_id").isNull() | c("product_id").isNull() | c("quantity").isNull()
            | c("price").isNull(),
            "check_quantity_positive": c("quantity") <= 0,
            "check_price_non_negative": c("price") < 0,
        }),
    ]
    return reduce(lambda a, b2: a.unionByName(b2), parts)


@register("rows_per_source_file", "P16", oracle="""
SELECT 'orders.parquet' AS source_file, COUNT(*) AS rows_cnt FROM orders HAVING COUNT(*) > 0
""")
def rows_per_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the file they came from (file metadata, no extra column in the data)."""
    rows = files.with_source_file(b.table(spark, sf_dir, "orders").select("o_orderkey", "_metadata"))
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_cnt"))
