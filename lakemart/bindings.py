"""Retail views over the driver tables.

Every registered query reads these views, so its work grows with the tables.
The same definitions exist as SQL text (``ORACLE_VIEWS``) for the DuckDB
oracle.  Money is kept as DECIMAL(12,2); item prices are rounded half-up to
cents with exact integer arithmetic so that every engine gets the same cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.joins import broadcast_if_bounded

# Status letters of the order table and their retail names.
STATUS_NAMES = {"F": "paid", "P": "shipped", "O": "created"}
REGISTERED_BASE_DATE = "1995-01-01"

# Upper bounds that hold by definition of the schema (TPC-H).
NATION_ROWS_MAX = 25
REGION_ROWS_MAX = 5


class ViewSet(dict):
    """Named DataFrames standing in for a table folder.

    Every query takes ``(spark, source)``; ``source`` is normally the folder
    of the driver tables, but may be a ``ViewSet`` holding ready views
    (``users``, ``orders``, ``order_items``, ``products``, ``events``, …) or
    raw tables, which makes every registered query a pure
    DataFrame → DataFrame function (golden tests use this).
    """


def _view(src, name: str):
    """A ready view from a ``ViewSet`` (None: derive it from raw tables)."""
    return src.get(name) if isinstance(src, ViewSet) else None


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    if isinstance(sf_dir, ViewSet):
        if name not in sf_dir:
            raise KeyError(f"view set has no table '{name}'")
        return sf_dir[name]
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _memo_key(spark: SparkSession, sf_dir, name: str):
    if isinstance(sf_dir, ViewSet):
        return None
    return (spark.sparkContext.applicationId, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(col: Column) -> Column:
    expr = None
    for letter, name in STATUS_NAMES.items():
        expr = (F.when(col == letter, name) if expr is None
                else expr.when(col == letter, name))
    return expr


def money(col: Column) -> Column:
    return col.cast("decimal(12,2)")


def cents_price(amount: Column, quantity: Column) -> Column:
    """round(amount / quantity, 2) half-up, computed exactly in cents."""
    cents = F.round(amount * 100).cast("bigint")
    q = quantity.cast("bigint")
    rounded = F.floor((cents * 2 + q) / (q * 2)).cast("decimal(14,0)")
    return (rounded * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(12,2)")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(sf_dir, "nation")
    if v is not None:
        return v
    return table(spark, sf_dir, "nation")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(sf_dir, "users")
    if v is not None:
        return v
    nation = broadcast_if_bounded(
        nations(spark, sf_dir).select("n_nationkey", "n_name", "n_regionkey"),
        NATION_ROWS_MAX, memo_key=_memo_key(spark, sf_dir, "nation"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return (
        c.join(nation, c.c_nationkey == nation.n_nationkey)
        .select(
            F.col("c_custkey").alias("user_id"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("city"),
            F.lower("c_mktsegment").alias("segment"),
            F.date_add(F.lit(REGISTERED_BASE_DATE).cast("date"),
                       (F.col("c_custkey") % 1000).cast("int")).alias("registered_on"),
            F.col("n_regionkey").alias("region_key"),
        )
    )


def user_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id → region name (customer ⋈ nation ⋈ region, dims broadcast)."""
    v = _view(sf_dir, "user_regions")
    if v is not None:
        return v
    region = broadcast_if_bounded(
        table(spark, sf_dir, "region").select("r_regionkey", "r_name"), REGION_ROWS_MAX,
        memo_key=_memo_key(spark, sf_dir, "region"))
    nation = broadcast_if_bounded(
        nations(spark, sf_dir).select("n_nationkey", "n_regionkey"), NATION_ROWS_MAX,
        memo_key=_memo_key(spark, sf_dir, "nation"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("region"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), "region")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(sf_dir, "products")
    if v is not None:
        return v
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        money(F.col("p_retailprice")).alias("price"),
    )


def orders(spark: SparkSession, sf_dir: str, statuses: tuple[str, ...] | None = None) -> DataFrame:
    """Orders view.  ``statuses`` filters on the raw status letter before the
    name mapping, so the predicate is pushed to the Parquet scan (a filter on
    the mapped name would be a CASE expression the scan cannot use)."""
    v = _view(sf_dir, "orders")
    if v is not None:
        return v if statuses is None else v.filter(F.col("status").isin(*statuses))
    raw = table(spark, sf_dir, "orders")
    if statuses is not None:
        codes = [code for code, name in STATUS_NAMES.items() if name in statuses]
        raw = raw.filter(F.col("o_orderstatus").isin(*codes))
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _status(F.col("o_orderstatus")).alias("status"),
        money(F.col("o_totalprice")).alias("amount"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(sf_dir, "order_items")
    if v is not None:
        return v
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice")).alias("line_amount"),
        cents_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_shipdate").cast("date").alias("dt"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(sf_dir, "events")
    if v is not None:
        return v
    return table(spark, sf_dir, "events")


def paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir, ("paid",))


def register_views(spark: SparkSession, sf_dir: str, suffix: str = "") -> dict[str, str]:
    """Expose the bound views to ``spark.sql`` under the oracle's names
    (plus ``suffix``, so concurrent jobs over different inputs do not replace
    each other's views), and the paid orders with their filter on the raw
    letter, which the scan can use.  Returns the names used."""
    names = {"b_users": users, "b_products": products, "b_orders": orders, "b_items": order_items,
             "b_events": events, "b_paid_orders": paid_orders}
    out = {}
    for name, view in names.items():
        view(spark, sf_dir).createOrReplaceTempView(name + suffix)
        out[name] = name + suffix
    return out


def unique_suffix() -> str:
    import uuid

    return "_" + uuid.uuid4().hex[:10]


# The same views as SQL text for the DuckDB oracle (raw tables are
# pre-registered there under their own names).
ORACLE_VIEWS = """
WITH b_users AS (
  SELECT c.c_custkey AS user_id,
         lower(c.c_name) || '@example.com' AS email,
         n.n_name AS city,
         lower(c.c_mktsegment) AS segment,
         CAST(DATE '1995-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS DATE) AS registered_on,
         n.n_regionkey AS region_key
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
b_user_regions AS (
  SELECT c.c_custkey AS user_id, r.r_name AS region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
b_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS brand, p_size AS size, CAST(p_retailprice AS DECIMAL(12,2)) AS price
  FROM part
),
b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'P' THEN 'shipped'
                            WHEN 'O' THEN 'created' END AS status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount
  FROM orders
),
b_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS line_amount,
         CAST(CAST(floor((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
                         / (2 * CAST(l_quantity AS BIGINT))) AS DECIMAL(14,0))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS price,
         l_discount AS discount,
         CAST(l_shipdate AS DATE) AS dt
  FROM lineitem
)
"""
