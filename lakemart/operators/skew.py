"""Skewed inputs: a derived event stream where one key holds most rows.

The lab generates a star schema with ``rand``; here the skew is derived from
the given ``events`` table with a deterministic rule, so the skewed data grows
with the input and every engine can rebuild it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Share of rows moved to the hot key (8 of every 10 event ids)
# and the hot user / key they are moved to.
HOT_BUCKETS = 8
BUCKETS = 10
HOT_USER_ID = 0
HOT_KEY = "hot"


def skewed_events(events: DataFrame) -> DataFrame:
    """Events where 80 % of rows share one user and one ``skew_key``."""
    hot = F.pmod(F.col("event_id"), F.lit(BUCKETS)) < HOT_BUCKETS
    return events.select(
        "event_id",
        F.when(hot, F.lit(HOT_USER_ID).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.col("user_id").alias("source_user_id"),
        "event_type",
        F.col("value").cast("decimal(12,2)").alias("event_value"),
        F.when(hot, F.lit(HOT_KEY)).otherwise(
            F.concat(F.lit("k"), F.col("user_id").cast("string"))).alias("skew_key"),
    )


def key_histogram(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and each key's share of all rows (skew report)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_cnt"))
    # The total is a scalar subquery: one extra partial+final count, no join.
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.select(
        key, "rows_cnt", (F.col("rows_cnt").cast("double") / total.cast("double")).alias("share"))
