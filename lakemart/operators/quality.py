"""Data-quality checks.

Constraints that Parquet tables cannot declare (PK, CHECK, FK) become check
jobs: per-row rules are conditional counts in one aggregate pass per table,
key rules are a ``groupBy`` (duplicates) or a ``left_anti`` join (orphans).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class EmptyInputError(RuntimeError):
    pass


def ensure_not_empty(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """DQ2: the input exists and has at least one row, else a clear error."""
    from lakemart.operators.loads import path_exists

    if not path_exists(spark, path):
        raise EmptyInputError(f"input {path} does not exist")
    df = spark.read.format(fmt).options(**options).load(path)
    if df.isEmpty():
        raise EmptyInputError(f"input {path} is empty")
    return df


def row_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Count rows violating each rule (a boolean "is violation" column) in
    one pass; one output row per rule."""
    agg = df.agg(*[F.count(F.when(cond, 1)).alias(name) for name, cond in rules.items()])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations_cnt")) for name in rules]))
    return agg.select(stacked.alias("r")).select(
        F.lit(table).alias("table_name"), "r.rule", F.col("r.violations_cnt").cast("bigint").alias("violations_cnt"))


def duplicate_keys(df: DataFrame, table: str, rule: str, keys: list[str]) -> DataFrame:
    """Number of key values held by more than one row."""
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dups.agg(F.count(F.lit(1)).cast("bigint").alias("violations_cnt")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations_cnt")


# Allowed order statuses of the bound orders view.
ORDER_STATUSES = ("paid", "shipped", "created")


def constraint_report(items: DataFrame, orders: DataFrame, products: DataFrame,
                      users: DataFrame) -> DataFrame:
    """DQ1 over the shop schema: two passes over the lines and two over the
    orders.  Row rules ride along with the key aggregates: lines and orders
    meet on the order key, which answers both primary keys and the foreign key
    between them; each other foreign key is a count per key and one join.
    """
    c, one = F.col, F.lit(1)

    def violations(**rules: Column) -> list[Column]:
        return [F.count(F.when(cond, one)).alias(name) for name, cond in rules.items()]

    item_rules = {
        "i_not_null": c("order_id").isNull() | c("product_id").isNull() | c("quantity").isNull() | c("price").isNull(),
        "i_quantity": c("quantity") <= 0, "i_price": c("price") < 0}
    order_rules = {
        "o_not_null": c("order_id").isNull() | c("user_id").isNull() | c("order_date").isNull()
        | c("status").isNull() | c("amount").isNull(),
        "o_status": c("status").isNull() | ~c("status").isin(*ORDER_STATUSES), "o_amount": c("amount") < 0}
    per_order = (items.groupBy("order_id", "line_no").agg(F.count(one).alias("n"), *violations(**item_rules))
                 .groupBy("order_id").agg(F.sum("n").alias("lines"), F.count(F.when(c("n") > 1, one)).alias("i_dup"),
                                          *[F.sum(r).alias(r) for r in item_rules]))
    headers = orders.groupBy("order_id").agg(F.count(one).alias("headers"), *violations(**order_rules))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    met = per_order.join(headers, "order_id", "full_outer").agg(
        total("i_dup").alias("i_dup"), total(F.when(c("headers").isNull(), c("lines"))).alias("i_order"),
        F.count(F.when(c("headers") > 1, one)).alias("o_dup"), *[total(r).alias(r) for r in [*item_rules, *order_rules]])

    def without_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
        counts = child.groupBy(key).agg(F.count(one).alias("n"))
        return counts.join(parent.select(key).distinct(), key, "left_anti").agg(total("n").alias("n"))

    def stacked(row: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(t).alias("table_name"), F.lit(rule).alias("rule"), c(x).alias("violations_cnt"))
            for x, (t, rule) in names.items()])).alias("r")).select("r.*")

    return reduce(lambda a, b2: a.unionByName(b2), [
        stacked(met, {
            "i_dup": ("order_items", "pk_order_line"), "i_not_null": ("order_items", "not_null"),
            "i_quantity": ("order_items", "check_quantity_positive"), "i_price": ("order_items", "check_price_non_negative"),
            "i_order": ("order_items", "fk_order"), "o_dup": ("orders", "pk_order"), "o_not_null": ("orders", "not_null"),
            "o_status": ("orders", "check_status"), "o_amount": ("orders", "check_amount_non_negative")}),
        stacked(without_parent(items, products, "product_id"), {"n": ("order_items", "fk_product")}),
        stacked(without_parent(orders, users, "user_id"), {"n": ("orders", "fk_user")})])


def layer_counts(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """DQ3: row counts per (layer, table) for reconciliation after a load."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows_cnt"))
             .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows_cnt")
             for (layer, table), df in frames.items()]
    return reduce(lambda a, b2: a.unionByName(b2), parts)
