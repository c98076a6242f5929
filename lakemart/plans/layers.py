"""The layered lake run end to end: raw → stg → ods → mart (M10, DQ3).

A plain function takes users, products, orders and order lines through every
layer in order (scheduling is out of scope).  Every step is idempotent: raw
lands into the run's ``dt=`` partition (dynamic overwrite), stg is overwritten.
From ods on a run is incremental: an upsert writes the buckets of new and
changed rows only (lines, which have no key, are refreshed where their content
differs), and a mart is worked out again only if one of its tables changed, of
which it writes the buckets of groups that differ.  A second run writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.casting import as_strings, typed_projection
from lakemart.operators.keyed import BucketTable
from lakemart.operators.loads import path_exists
from lakemart.operators.quality import layer_counts as _layer_counts
from lakemart.plans.registry import register
from lakemart.session import bucket_count, scratch_path
from lakemart.sources.sinks import land_raw


@dataclass(frozen=True)
class Entity:
    """A source table on its way through the layers: source column → (ods
    column, type), and the key of its upsert (none: full refresh)."""

    name: str
    source: str
    columns: dict[str, tuple[str, str]]
    key: str | None = None


ENTITIES = (
    Entity("users", "customer", {"c_custkey": ("user_id", "bigint"), "c_name": ("user_name", "string"),
                                 "c_mktsegment": ("segment", "string")}, "user_id"),
    Entity("products", "part", {"p_partkey": ("product_id", "bigint"), "p_name": ("product_name", "string"),
                                "p_type": ("category", "string"), "p_retailprice": ("price", "decimal(12,2)")}, "product_id"),
    Entity("orders", "orders", {"o_orderkey": ("order_id", "bigint"), "o_custkey": ("user_id", "bigint"),
                                "o_orderstatus": ("status_code", "string"), "o_totalprice": ("amount", "decimal(12,2)"),
                                "o_orderdate": ("order_ts", "timestamp_ntz")}, "order_id"),
    Entity("order_items", "lineitem", {"l_orderkey": ("order_id", "bigint"), "l_linenumber": ("line_no", "int"),
                                       "l_partkey": ("product_id", "bigint"), "l_quantity": ("quantity", "decimal(12,2)"),
                                       "l_extendedprice": ("line_amount", "decimal(12,2)")}),
)


class Loaded(dict):
    """(layer, table) → DataFrame; ``written`` counts the rows of ods and mart
    tables that the run found new, changed or gone."""

    def __init__(self, tables: dict, written: dict):
        super().__init__(tables)
        self.written = written


def load_entity(spark: SparkSession, source: DataFrame, e: Entity, root: str, run_date: str) -> Loaded:
    """One entity from its source to ods; the table of each layer."""
    # raw: the source rows untouched (as text), in the run's day partition.
    day = F.lit(run_date).cast("date")
    text = as_strings(source.select(*e.columns))
    path = land_raw(text.withColumn("dt", day), root, "shop", e.name, one_day=True)
    ddl = ", ".join(f"{c} STRING" for c in e.columns) + ", dt DATE"
    raw = spark.read.schema(ddl).json(path).filter(F.col("dt") == day)

    # stg: typed; rows with fields that do not parse go to rejects.
    typed = typed_projection(raw, {c: t for c, (_, t) in e.columns.items()}, rename={c: n for c, (n, _) in e.columns.items()})
    stg, rejects = f"{root}/stg/{e.name}", f"{root}/stg/{e.name}_rejects"
    seen, bad = Observation(), F.col("_bad_fields") > 0
    typed.observe(seen, F.count(F.when(bad, 1)).alias("bad")).filter(~bad).drop("_bad_fields").write.mode("overwrite").parquet(stg)
    # The text is parsed again only for rejects that there are.
    (typed.filter(bad) if seen.get["bad"] else spark.createDataFrame([], typed.schema)).write.mode("overwrite").parquet(rejects)
    rows = spark.read.parquet(stg)

    # ods: what is new or changed.
    if e.key:
        ods = BucketTable(spark, f"{root}/ods/{e.name}", [e.key], rows.schema, bucket_count(spark, source))
        written, held = ods.upsert(rows), ods.read
    else:
        path = f"{root}/ods/{e.name}"
        known = path_exists(spark, f"{path}/_SUCCESS") and bag_digest(spark.read.schema(rows.schema).parquet(path))
        written = 0
        if not known or known != bag_digest(rows):
            rows.write.mode("overwrite").parquet(path)
            written = rows.count()
        held = lambda: spark.read.schema(rows.schema).parquet(path)
    return Loaded({("raw", e.name): raw, ("stg", e.name): rows, ("stg", f"{e.name}_rejects"): spark.read.parquet(rejects),
                   ("ods", e.name): held()}, {("ods", e.name): written})


def bag_digest(df: DataFrame) -> tuple:
    """Row count, sum and exclusive or of the row hashes: equal for equal bags
    of rows whatever their order."""
    h = F.xxhash64(*df.columns)
    return tuple(df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def run_layers(spark: SparkSession, sf_dir: str, root: str, run_date: str) -> Loaded:
    """One run of the retail flow; the written table of each layer and how
    many rows of ods and mart the run wrote anew."""
    out, written = Loaded({}, {}), {}
    for e in ENTITIES:
        loaded = load_entity(spark, b.table(spark, sf_dir, e.source), e, root, run_date)
        out.update(loaded)
        written |= loaded.written
    users, products, orders, items = (out[("ods", e.name)] for e in ENTITIES)
    # Lines and orders are summed by key before they meet the dimension.
    per_user = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    per_product = items.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))
    marts = {   # name: (key, inputs, rows)
        "order_status_stats": ("status_code", ("orders",), orders.groupBy("status_code").agg(
            F.count(F.lit(1)).alias("orders_cnt"), F.countDistinct("user_id").alias("users_cnt"),
            F.sum("amount").alias("total_amount"))),
        "segment_revenue": ("segment", ("orders", "users"), per_user.join(users.select("user_id", "segment"), "user_id").groupBy("segment").agg(
            F.sum("n").alias("orders_cnt"), F.sum("amount").alias("total_amount"))),
        "category_units": ("category", ("order_items", "products"), per_product.join(products.select("product_id", "category"), "product_id").groupBy("category").agg(
            F.sum("n").alias("lines_cnt"), F.sum("quantity").alias("quantity"))),
    }
    for name, (key, inputs, df) in marts.items():
        mart = BucketTable(spark, f"{root}/mart/{name}", [key], df.schema)
        stale = any(written[("ods", i)] for i in inputs)
        written[("mart", name)] = mart.sync(df) if stale else 0
        out[("mart", name)] = mart.read()
    return Loaded(out, written)


# Load date of the registered run (the raw layer partition it lands in).
RUN_DATE = "2026-05-20"

_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{e.name}{suffix}' AS table_name, {n} AS rows_cnt FROM {e.source}"
    for e in ENTITIES
    for layer, suffix, n in (("raw", "", "COUNT(*)"), ("stg", "", "COUNT(*)"), ("stg", "_rejects", "COUNT(*) * 0"),
                             ("ods", "", "COUNT(*)")))


@register("layer_counts", "DQ3/M10", oracle=f"""
{_COUNTS}
UNION ALL SELECT 'mart', 'order_status_stats', COUNT(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'mart', 'segment_revenue', COUNT(DISTINCT c_mktsegment) FROM customer JOIN orders ON o_custkey = c_custkey
UNION ALL SELECT 'mart', 'category_units', COUNT(DISTINCT p_type) FROM part JOIN lineitem ON l_partkey = p_partkey
""")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of every entity in every layer and of three marts, after
    running the whole flow twice."""
    root = scratch_path(spark, "lake_run")
    run_layers(spark, sf_dir, root, RUN_DATE)
    frames = run_layers(spark, sf_dir, root, RUN_DATE)
    return _layer_counts(frames)
