"""Window-style operators written to stay bounded under key skew.

* ``top_n_per_group`` — row_number ≤ n; Catalyst plans a WindowGroupLimit
  before the shuffle, so each map task forwards at most n rows per group.
* ``running_total_by_date`` — RANGE running sum computed on per-(group, date)
  totals, so the per-group window holds one row per date, not per event.
* ``trim_edges`` — drop the k lowest and k highest keys with two top-k
  (TakeOrderedAndProject) results instead of a global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rn") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def running_total_by_date(df: DataFrame, group: str, date_col: str, value_col: str,
                          out_col: str) -> DataFrame:
    """Running sum of ``value_col`` per ``group`` ordered by ``date_col`` with
    the SQL default frame (RANGE UNBOUNDED PRECEDING → CURRENT ROW): rows that
    share a date share the total through that date.

    Values are first summed per (group, date) — a partial aggregate, safe
    for a hot group — then the window runs over those daily totals and the
    result is joined back on (group, date), a key spread over dates.
    """
    daily = df.groupBy(group, date_col).agg(F.sum(value_col).alias("__day_total"))
    w = (Window.partitionBy(group).orderBy(date_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cumulative = daily.select(F.col(group).alias("__g"), F.col(date_col).alias("__d"),
                              F.sum("__day_total").over(w).alias(out_col))
    return _join_back(df, cumulative, group, date_col)


def _join_back(df: DataFrame, per_chunk: DataFrame, group: str, date_col: str) -> DataFrame:
    """Join per-(group, date) results back to the rows; NULL groups and
    dates match too (a window keeps them in their own partition)."""
    cond = F.col(group).eqNullSafe(F.col("__g")) & F.col(date_col).eqNullSafe(F.col("__d"))
    return df.join(per_chunk, cond).drop("__g", "__d")


def trim_edges(df: DataFrame, order: list[Column], desc_order: list[Column], key: str,
               k: int) -> DataFrame:
    lowest = df.orderBy(*order).limit(k).select(key)
    highest = df.orderBy(*desc_order).limit(k).select(key)
    return (df.join(F.broadcast(lowest), key, "left_anti")
            .join(F.broadcast(highest), key, "left_anti"))


def lag_by_date(df: DataFrame, group: str, date_col: str, tiebreak: str, value_col: str,
                out_col: str) -> DataFrame:
    """``lag(value) over (partition by group order by date, tiebreak)``
    without a per-group window.

    Rows are numbered inside (group, date) chunks, so a hot group is spread
    over its dates.  The first row of a chunk takes its previous value from
    the last row of the group's preceding chunk: chunk tails come from an
    aggregate (``max_by``), and the window that orders them holds one row
    per (group, date).
    """
    in_chunk = Window.partitionBy(group, date_col).orderBy(tiebreak)
    numbered = (df.withColumn(out_col, F.lag(value_col).over(in_chunk))
                .withColumn("__rn", F.row_number().over(in_chunk)))
    tails = df.groupBy(group, date_col).agg(
        F.max_by(F.col(value_col), F.col(tiebreak)).alias("__tail"))
    by_date = Window.partitionBy(group).orderBy(date_col)
    prev_tail = tails.select(F.col(group).alias("__g"), F.col(date_col).alias("__d"),
                             F.lag("__tail").over(by_date).alias("__prev_tail"))
    return (_join_back(numbered, prev_tail, group, date_col)
            .withColumn(out_col, F.when(F.col("__rn") == 1, F.col("__prev_tail"))
                        .otherwise(F.col(out_col)))
            .drop("__prev_tail", "__rn"))
