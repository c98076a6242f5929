"""Order-analysis queries.

Per-user and per-order questions are answered on pre-aggregated rows
((user, category), (order, category), (user, date)) so that windows and joins
never hold one row per line of a hot user or order.  Thresholds are compared
exactly on decimals; ratios are DOUBLE divisions of exact sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart import bindings as b
from lakemart.operators.windows import lag_by_date
from lakemart.plans.registry import register
from lakemart.session import dealt_by, part_count


def _dbl(name: str):
    return F.col(name).cast("double")


def _ratio(num: str, den: str, scale: float = 1.0):
    n = F.col(num).cast("double")
    if scale != 1.0:
        n = n * F.lit(scale)
    return F.try_divide(n, F.col(den).cast("double"))


def _paid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of paid orders with user and category (order_id, user_id,
    order_date, product_id, category, quantity, line_value).

    Categories are joined first and order headers last, so the result comes
    out hash-partitioned by ``order_id``: per-order groupings, distincts and
    self-joins downstream reuse that partitioning instead of shuffling the
    lines again.  Their parts are sized by the files read.
    """
    paid = (b.orders(spark, sf_dir, statuses=("paid",))
            .select("order_id", "user_id", "order_date"))
    cats = b.products(spark, sf_dir).select("product_id", "category")
    lines = b.order_items(spark, sf_dir).select(
        "order_id", "product_id", "quantity", (F.col("quantity") * F.col("price")).alias("line_value"))
    return dealt_by(lines.join(cats, "product_id"), "order_id").join(paid, "order_id")


@register("price_mismatch_lines", "Q-E1", oracle="""
SELECT i.order_id, i.line_no, i.product_id, p.product_name,
       CAST(i.price AS DOUBLE) AS sold_price, CAST(p.price AS DOUBLE) AS list_price,
       CAST(i.price - p.price AS DOUBLE) AS price_diff
FROM b_items i JOIN b_products p ON i.product_id = p.product_id WHERE i.price <> p.price
""")
def price_mismatch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines sold at a price other than the product's list price, with the difference."""
    i = b.order_items(spark, sf_dir).select("order_id", "line_no", "product_id", F.col("price").alias("sold"))
    p = b.products(spark, sf_dir).select("product_id", "product_name", F.col("price").alias("list"))
    return (i.join(p, "product_id").filter(F.col("sold") != F.col("list"))
            .select("order_id", "line_no", "product_id", "product_name",
                    _dbl("sold").alias("sold_price"), _dbl("list").alias("list_price"),
                    (F.col("sold") - F.col("list")).cast("double").alias("price_diff")))


# In the bound data a unit sale price and a list price differ by about two
# orders of magnitude; "above list" is taken against list × 100.
ABOVE_LIST_FACTOR = 100


@register("sold_above_list", "Q-E3", oracle=f"""
SELECT p.product_id, p.product_name, CAST(p.price AS DOUBLE) AS list_price,
       CAST(MAX(i.price) AS DOUBLE) AS max_sold_price,
       CAST(MAX(i.price) - p.price AS DOUBLE) AS price_diff
FROM b_items i JOIN b_products p ON i.product_id = p.product_id
GROUP BY p.product_id, p.product_name, p.price
HAVING MAX(i.price) > p.price * {ABOVE_LIST_FACTOR}
""")
def sold_above_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose highest sale price exceeds the list price (× the binding factor)."""
    top = b.order_items(spark, sf_dir).groupBy("product_id").agg(F.max("price").alias("max_sold"))
    p = b.products(spark, sf_dir).select("product_id", "product_name", "price")
    return (top.join(p, "product_id").filter(F.col("max_sold") > F.col("price") * ABOVE_LIST_FACTOR)
            .select("product_id", "product_name", _dbl("price").alias("list_price"),
                    _dbl("max_sold").alias("max_sold_price"),
                    (F.col("max_sold") - F.col("price")).cast("double").alias("price_diff")))


@register("single_category_orders", "Q-E5", oracle="""
SELECT i.order_id, MIN(p.category) AS category, COUNT(DISTINCT i.product_id) AS products_cnt,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS lines_total
FROM b_items i JOIN b_products p ON i.product_id = p.product_id
GROUP BY i.order_id HAVING COUNT(DISTINCT p.category) = 1
""")
def single_category_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose lines all share one category: distinct products and line total."""
    cats = b.products(spark, sf_dir).select("product_id", "category")
    lines = b.order_items(spark, sf_dir).select(
        "order_id", "product_id", (F.col("quantity") * F.col("price")).alias("v"))
    return (lines.join(cats, "product_id").groupBy("order_id")
            .agg(F.min("category").alias("category"), F.max("category").alias("max_cat"),
                 F.countDistinct("product_id").alias("products_cnt"), F.sum("v").alias("t"))
            .filter(F.col("category") == F.col("max_cat"))
            .select("order_id", "category", "products_cnt", _dbl("t").alias("lines_total")))


@register("top_line_share", "Q-M1", oracle="""
SELECT order_id, CAST(SUM(quantity * price) AS DOUBLE) AS order_total,
       CAST(MAX(quantity * price) AS DOUBLE) AS top_line,
       CAST(MAX(quantity * price) AS DOUBLE) * CAST(100 AS DOUBLE)
         / CAST(SUM(quantity * price) AS DOUBLE) AS top_share_pct
FROM b_items GROUP BY order_id
""")
def top_line_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share (%) of the dearest line (quantity × price) in each order."""
    v = F.col("quantity") * F.col("price")
    agg = b.order_items(spark, sf_dir).groupBy("order_id").agg(
        F.sum(v).alias("t"), F.max(v).alias("m"))
    return agg.select("order_id", _dbl("t").alias("order_total"), _dbl("m").alias("top_line"),
                      _ratio("m", "t", 100.0).alias("top_share_pct"))


@register("last_above_avg", "Q-M2", oracle="""
, paid AS (SELECT user_id, order_id, order_date, amount,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY order_date DESC, order_id DESC) AS rn
           FROM b_orders WHERE status = 'paid'),
  per_user AS (SELECT user_id, COUNT(*) AS n, SUM(amount) AS total,
                      MAX(CASE WHEN rn = 1 THEN amount END) AS last_amount
               FROM paid GROUP BY user_id)
SELECT u.user_id, u.email, p.n AS paid_orders_cnt,
       CAST(p.total AS DOUBLE) / CAST(p.n AS DOUBLE) AS avg_amount,
       CAST(p.last_amount AS DOUBLE) AS last_amount,
       CAST(p.last_amount AS DOUBLE) - CAST(p.total AS DOUBLE) / CAST(p.n AS DOUBLE) AS diff_amount
FROM per_user p JOIN b_users u ON u.user_id = p.user_id
WHERE p.n >= 2 AND p.last_amount * p.n > p.total
""")
def last_above_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with ≥ 2 paid orders whose last paid order beats their average.

    The last order is picked by ``max_by`` over (date, id) inside the
    aggregate — a partial aggregate, no per-user window.
    """
    per_user = (b.orders(spark, sf_dir, statuses=("paid",)).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"),
                     F.max_by("amount", F.struct("order_date", "order_id")).alias("last"))
                .filter((F.col("n") >= 2) & (F.col("last") * F.col("n") > F.col("total"))))
    avg = _ratio("total", "n")
    return (per_user.join(b.users(spark, sf_dir).select("user_id", "email"), "user_id")
            .select("user_id", "email", F.col("n").alias("paid_orders_cnt"), avg.alias("avg_amount"),
                    _dbl("last").alias("last_amount"), (_dbl("last") - avg).alias("diff_amount")))


@register("category_cooccurrence", "Q-M3", oracle="""
, oc AS (SELECT DISTINCT i.order_id, p.category FROM b_items i
         JOIN b_orders o ON o.order_id = i.order_id JOIN b_products p ON p.product_id = i.product_id
         WHERE o.status = 'paid'),
  nc AS (SELECT order_id, COUNT(*) AS n_cats FROM oc GROUP BY order_id)
SELECT oc.category, COUNT(*) FILTER (WHERE nc.n_cats > 1) AS shared_orders, COUNT(*) AS total_orders,
       CAST(COUNT(*) FILTER (WHERE nc.n_cats > 1) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS shared_share
FROM oc JOIN nc ON oc.order_id = nc.order_id GROUP BY oc.category
""")
def category_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per category: paid orders that also contain another category, all its paid orders, share."""
    oc = _paid_lines(spark, sf_dir).select("order_id", "category").distinct()
    # Categories per order: a window over the order's distinct categories
    # (at most one row per category) on data already partitioned by order.
    with_n = oc.withColumn("n_cats", F.count(F.lit(1)).over(Window.partitionBy("order_id")))
    return (with_n.groupBy("category")
            .agg(F.count(F.when(F.col("n_cats") > 1, 1)).alias("shared_orders"),
                 F.count(F.lit(1)).alias("total_orders"))
            .select("category", "shared_orders", "total_orders",
                    _ratio("shared_orders", "total_orders").alias("shared_share")))


def _paid_user_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend and first date per (user, product, category) of paid orders.

    Per-user questions join the paid headers first and sum the lines to one
    row per user and product before the product join."""
    paid = b.orders(spark, sf_dir, statuses=("paid",)).select("order_id", "user_id", "order_date")
    lines = b.order_items(spark, sf_dir).select(
        "order_id", "product_id", (F.col("quantity") * F.col("price")).alias("line_value"))
    sums = lines.join(paid, "order_id").groupBy("user_id", "product_id").agg(
        F.sum("line_value").alias("spend"), F.min("order_date").alias("first_date"))
    return sums.join(b.products(spark, sf_dir).select("product_id", "category"), "product_id")


def _user_category_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_paid_user_products(spark, sf_dir).groupBy("user_id", "category")
            .agg(F.sum("spend").alias("spend")))


@register("user_top_category", "Q-H1", oracle="""
, uc AS (SELECT o.user_id, p.category, SUM(i.quantity * i.price) AS spend
         FROM b_items i JOIN b_orders o ON o.order_id = i.order_id
         JOIN b_products p ON p.product_id = i.product_id WHERE o.status = 'paid'
         GROUP BY o.user_id, p.category),
  r AS (SELECT user_id, category, spend, SUM(spend) OVER (PARTITION BY user_id) AS total,
               RANK() OVER (PARTITION BY user_id ORDER BY spend DESC) AS rk FROM uc)
SELECT r.user_id, u.email, r.category, CAST(r.spend AS DOUBLE) AS category_spend,
       CAST(r.total AS DOUBLE) AS total_spend, CAST(r.spend AS DOUBLE) / CAST(r.total AS DOUBLE) AS share
FROM r JOIN b_users u ON u.user_id = r.user_id WHERE r.rk = 1
""")
def user_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's top-spend category in paid orders, all ties kept.  The
    windows run over (user, category) sums: at most one row per category."""
    uc = _user_category_spend(spark, sf_dir)
    w = Window.partitionBy("user_id")
    ranked = (uc.withColumn("total", F.sum("spend").over(w))
              .withColumn("rk", F.rank().over(w.orderBy(F.col("spend").desc())))
              .filter(F.col("rk") == 1))
    return (ranked.join(b.users(spark, sf_dir).select("user_id", "email"), "user_id")
            .select("user_id", "email", "category", _dbl("spend").alias("category_spend"),
                    _dbl("total").alias("total_spend"), _ratio("spend", "total").alias("share")))


@register("order_change", "Q-H2", oracle="""
, s AS (SELECT user_id, order_id, order_date, amount,
               LAG(amount) OVER (PARTITION BY user_id ORDER BY order_date, order_id) AS prev
        FROM b_orders WHERE status = 'paid')
SELECT user_id, order_id, order_date, CAST(amount AS DOUBLE) AS cur_amount,
       CAST(prev AS DOUBLE) AS prev_amount, CAST(amount - prev AS DOUBLE) AS diff_amount,
       CAST(amount - prev AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(prev AS DOUBLE) AS change_pct
FROM s WHERE prev IS NOT NULL AND abs(amount - prev) * 5 > prev
""")
def order_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of each paid order against the user's previous paid order,
    kept when |change| > 20 % (exactly 20 % is not kept)."""
    paid = (b.orders(spark, sf_dir, statuses=("paid",))
            .select("user_id", "order_id", "order_date", "amount"))
    s = lag_by_date(paid, "user_id", "order_date", "order_id", "amount", "prev")
    diff = F.col("amount") - F.col("prev")
    return (s.filter(F.col("prev").isNotNull() & (F.abs(diff) * 5 > F.col("prev")))
            .select("user_id", "order_id", "order_date", _dbl("amount").alias("cur_amount"),
                    _dbl("prev").alias("prev_amount"), diff.cast("double").alias("diff_amount"),
                    F.try_divide(diff.cast("double") * F.lit(100.0), _dbl("prev")).alias("change_pct")))


@register("dominant_category", "Q-H3", oracle="""
, oc AS (SELECT i.order_id, p.category, SUM(i.quantity * i.price) AS cat_total
         FROM b_items i JOIN b_orders o ON o.order_id = i.order_id
         JOIN b_products p ON p.product_id = i.product_id WHERE o.status = 'paid'
         GROUP BY i.order_id, p.category),
  ot AS (SELECT order_id, SUM(cat_total) AS order_total FROM oc GROUP BY order_id)
SELECT oc.order_id, oc.category, CAST(ot.order_total AS DOUBLE) AS order_total,
       CAST(oc.cat_total AS DOUBLE) AS category_total,
       CAST(oc.cat_total AS DOUBLE) / CAST(ot.order_total AS DOUBLE) AS share
FROM oc JOIN ot ON oc.order_id = ot.order_id WHERE oc.cat_total * 5 > ot.order_total * 4
""")
def dominant_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid orders where one category holds more than 80 % of the order."""
    oc = (_paid_lines(spark, sf_dir).groupBy("order_id", "category")
          .agg(F.sum("line_value").alias("cat_total")))
    # Order total as a window over the order's category sums: no self-join,
    # no extra shuffle (the rows are already partitioned by order).
    with_total = oc.withColumn("order_total", F.sum("cat_total").over(Window.partitionBy("order_id")))
    return (with_total.filter(F.col("cat_total") * 5 > F.col("order_total") * 4)
            .select("order_id", "category", _dbl("order_total").alias("order_total"),
                    _dbl("cat_total").alias("category_total"),
                    _ratio("cat_total", "order_total").alias("share")))


@register("new_category_sequence", "Q-H4", oracle="""
, f AS (SELECT o.user_id, p.category, MIN(o.order_date) AS first_date
        FROM b_items i JOIN b_orders o ON o.order_id = i.order_id
        JOIN b_products p ON p.product_id = i.product_id WHERE o.status = 'paid'
        GROUP BY o.user_id, p.category)
SELECT f.user_id, u.email, f.category, f.first_date,
       DENSE_RANK() OVER (PARTITION BY f.user_id ORDER BY f.first_date) AS category_no
FROM f JOIN b_users u ON u.user_id = f.user_id
""")
def new_category_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First paid purchase date of each category per user and its ordinal
    (dense_rank by date: categories first bought the same day share it)."""
    first = (_paid_user_products(spark, sf_dir).groupBy("user_id", "category")
             .agg(F.min("first_date").alias("first_date")))
    w = Window.partitionBy("user_id").orderBy("first_date")
    return (first.withColumn("category_no", F.dense_rank().over(w).cast("bigint"))
            .join(b.users(spark, sf_dir).select("user_id", "email"), "user_id")
            .select("user_id", "email", "category", "first_date", "category_no"))


@register("amount_reconciliation", "Q-H5", oracle="""
, lt AS (SELECT order_id, SUM(quantity * price) AS lines_total FROM b_items GROUP BY order_id)
SELECT o.order_id, o.user_id, o.status, CAST(o.amount AS DOUBLE) AS amount,
       CAST(lt.lines_total AS DOUBLE) AS lines_total,
       CAST(abs(lt.lines_total - o.amount) AS DOUBLE) AS abs_diff,
       CAST(abs(lt.lines_total - o.amount) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(o.amount AS DOUBLE) AS diff_pct
FROM b_orders o JOIN lt ON lt.order_id = o.order_id
WHERE abs(lt.lines_total - o.amount) * 10 > o.amount
""")
def amount_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose line sum differs from the amount by more than 10 %
    (orders without lines are reported by ``key_mismatch_report``)."""
    lt = (b.order_items(spark, sf_dir).groupBy("order_id")
          .agg(F.sum(F.col("quantity") * F.col("price")).alias("lines_total")))
    o = b.orders(spark, sf_dir).select("order_id", "user_id", "status", "amount")
    diff = F.abs(F.col("lines_total") - F.col("amount"))
    return (o.join(lt, "order_id").filter(diff * 10 > F.col("amount"))
            .select("order_id", "user_id", "status", _dbl("amount").alias("amount"),
                    _dbl("lines_total").alias("lines_total"), diff.cast("double").alias("abs_diff"),
                    F.try_divide(diff.cast("double") * F.lit(100.0), _dbl("amount")).alias("diff_pct")))


@register("basket_diversity", "Q-B1", oracle="""
SELECT i.order_id, COUNT(DISTINCT i.product_id) AS products_cnt,
       COUNT(DISTINCT p.category) AS categories_cnt,
       CAST(COUNT(DISTINCT p.category) AS DOUBLE) / CAST(COUNT(DISTINCT i.product_id) AS DOUBLE) AS diversity
FROM b_items i JOIN b_orders o ON o.order_id = i.order_id
JOIN b_products p ON p.product_id = i.product_id WHERE o.status = 'paid' GROUP BY i.order_id
""")
def basket_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct categories / distinct products per paid order, sorted
    descending (the driver compares unordered)."""
    # One row per (order, product), then per (order, category): counts of
    # groups instead of two distinct counts, which would double the lines.
    pairs = _paid_lines(spark, sf_dir).groupBy("order_id", "product_id").agg(F.first("category").alias("category"))
    agg = (pairs.groupBy("order_id", "category").agg(F.count(F.lit(1)).alias("n"))
           .groupBy("order_id").agg(F.sum("n").alias("products_cnt"), F.count(F.lit(1)).alias("categories_cnt")))
    rows = agg.select("order_id", "products_cnt", "categories_cnt", _ratio("categories_cnt", "products_cnt").alias("diversity"))
    by, n = (F.col("diversity").desc(), F.col("order_id").asc()), part_count(rows)
    return (rows.repartitionByRange(n, *by) if n else rows).orderBy(*by)


@register("single_category_users", "Q-B2", oracle="""
SELECT o.user_id, u.email, MIN(p.category) AS category, COUNT(DISTINCT o.order_id) AS orders_cnt,
       CAST(SUM(i.quantity * i.price) AS DOUBLE) AS spend
FROM b_items i JOIN b_orders o ON o.order_id = i.order_id
JOIN b_products p ON p.product_id = i.product_id JOIN b_users u ON u.user_id = o.user_id
WHERE o.status = 'paid' GROUP BY o.user_id, u.email HAVING COUNT(DISTINCT p.category) = 1
""")
def single_category_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose paid orders all fall in one category, with order count and spend."""
    per_user = (_paid_lines(spark, sf_dir).groupBy("user_id")
                .agg(F.min("category").alias("category"), F.max("category").alias("max_cat"),
                     F.countDistinct("order_id").alias("orders_cnt"), F.sum("line_value").alias("spend"))
                .filter(F.col("category") == F.col("max_cat")))
    return (per_user.join(b.users(spark, sf_dir).select("user_id", "email"), "user_id")
            .select("user_id", "email", "category", "orders_cnt", _dbl("spend").alias("spend")))


@register("price_spread", "Q-B3", oracle="""
SELECT i.product_id, p.product_name, CAST(MIN(i.price) AS DOUBLE) AS min_price,
       CAST(MAX(i.price) AS DOUBLE) AS max_price, CAST(MAX(i.price) - MIN(i.price) AS DOUBLE) AS price_diff,
       COUNT(DISTINCT i.order_id) AS orders_cnt
FROM b_items i JOIN b_products p ON p.product_id = i.product_id
GROUP BY i.product_id, p.product_name HAVING MIN(i.price) <> MAX(i.price)
""")
def price_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products sold at more than one price: min, max, spread and orders."""
    agg = (b.order_items(spark, sf_dir).groupBy("product_id")
           .agg(F.min("price").alias("lo"), F.max("price").alias("hi"),
                F.countDistinct("order_id").alias("orders_cnt"))
           .filter(F.col("lo") != F.col("hi")))
    return (agg.join(b.products(spark, sf_dir).select("product_id", "product_name"), "product_id")
            .select("product_id", "product_name", _dbl("lo").alias("min_price"), _dbl("hi").alias("max_price"),
                    (F.col("hi") - F.col("lo")).cast("double").alias("price_diff"), "orders_cnt"))
