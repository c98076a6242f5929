"""Join operators: size-checked broadcast, anti/mismatch reports, relational
division, skew salting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_BOUND_CHECKS: dict = {}


def broadcast_if_bounded(df: DataFrame, max_rows: int, memo_key=None) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows.  Beyond the bound the
    frame is returned as is and the planner (with AQE's runtime statistics)
    picks a shuffle join instead.  ``memo_key`` (application id + input
    path) reuses a check already made for the same input in this
    application.
    """
    key = (memo_key, max_rows) if memo_key is not None else None
    small = _BOUND_CHECKS.get(key) if key is not None else None
    if small is None:
        small = df.limit(max_rows + 1).count() <= max_rows
        if key is not None:
            _BOUND_CHECKS[key] = small
    return F.broadcast(df) if small else df


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a match in ``right`` (NOT EXISTS)."""
    return left.join(right, on=on, how="left_anti")


def mismatch_report(left: DataFrame, right: DataFrame, key: str,
                    left_name: str, right_name: str) -> DataFrame:
    """Keys present on one side only, labelled with ``issue_type``."""
    lk = left.select(key).distinct().withColumn("__l", F.lit(True))
    rk = right.select(key).distinct().withColumn("__r", F.lit(True))
    return (lk.join(rk, key, "full_outer").filter(F.col("__l").isNull() | F.col("__r").isNull())
            .select(key, F.when(F.col("__r").isNull(), F.lit(f"missing_in_{right_name}"))
                    .otherwise(F.lit(f"missing_in_{left_name}")).alias("issue_type")))


def all_members_match(members: DataFrame, group_key: str, matched: Column | str) -> DataFrame:
    """J9 relational division: groups where every member row has a match.

    ``matched`` is a boolean column on ``members`` (typically ``other_key IS
    NOT NULL`` after a left join).
    """
    m = F.col(matched) if isinstance(matched, str) else matched
    return (members.groupBy(group_key)
            .agg(F.count(F.lit(1)).alias("members"),
                 F.count(F.when(m, 1)).alias("matched"))
            .filter(F.col("members") == F.col("matched")))


def hot_keys(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """Keys holding at least ``min_share`` of all rows.

    At most ``1 / min_share`` keys can qualify, so the result has a proven
    size bound and may be broadcast.  Counting is a partial aggregate; the
    total is a scalar subquery.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    # Exact decimal threshold: a key with exactly min_share of the rows qualifies.
    threshold = total.cast("decimal(38,0)") * F.lit(repr(min_share)).cast("decimal(20,10)")
    return counts.filter(F.col("__n") >= threshold).select(key)


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int, how: str = "inner",
                salt_by: str | None = None, hot_share: float | None = None) -> DataFrame:
    """Join on a hot key by spreading it over ``salts`` sub-keys.

    Each ``big`` row gets a salt from a hash of ``salt_by`` (or of all its
    columns) — stable under re-execution, unlike ``rand``.  ``small`` rows
    are replicated once per salt.  With ``hot_share`` only the keys holding
    at least that share of ``big`` are salted (found by ``hot_keys``, at most
    ``1 / hot_share`` of them, broadcast); every other row keeps salt 0 and
    its ``small`` row is not replicated.  Output equals the plain join.
    """
    salt_col = "__salt"
    src = F.xxhash64(F.col(salt_by)) if salt_by else F.xxhash64(*[F.col(c) for c in big.columns])
    salted = F.pmod(src, F.lit(salts))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    if hot_share is None:
        big_s = big.withColumn(salt_col, salted)
        small_s = small.withColumn(salt_col, F.explode(every_salt))
    else:
        hot = F.broadcast(hot_keys(big, key, hot_share).withColumn("__hot", F.lit(True)))
        big_s = (big.join(hot, key, "left")
                 .withColumn(salt_col, F.when(F.col("__hot"), salted).otherwise(F.lit(0).cast("bigint")))
                 .drop("__hot"))
        small_s = (small.join(hot, key, "left")
                   .withColumn(salt_col, F.explode(F.when(F.col("__hot"), every_salt)
                                                   .otherwise(F.array(F.lit(0).cast("bigint")))))
                   .drop("__hot"))
    return big_s.join(small_s, on=[key, salt_col], how=how).drop(salt_col)
