"""Aggregation operators that need more than one ``groupBy``.

* ``salted_aggregate`` — two-phase aggregation for a hot key (A14).
* ``word_count`` — map (tokenise) → combine (partial agg) → reduce (A13).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: token separators for word counting (ASCII whitespace, the
# same class in Java regex and RE2).
WORD_SEPARATORS = r"[\t\n\x0B\f\r ]+"


def salted_aggregate(df: DataFrame, key: str, salts: int, salt_by: str | None,
                     counts: dict[str, str] | None = None,
                     sums: dict[str, str] | None = None,
                     distinct_of: dict[str, str] | None = None) -> DataFrame:
    """Aggregate ``df`` by ``key`` in two phases so one hot key is split.

    Phase 1 groups by (key, salt) and phase 2 merges the partial results by
    key.  The salt is taken from ``salt_by`` (a column hash) so that the
    result is stable when tasks are retried.  Distinct counts stay exact
    because the salt is derived from the counted column itself: each
    distinct value lands in exactly one salt, so per-salt distinct counts add
    up.  ``counts``: out name → column counted (``*`` for rows); ``sums``:
    out name → column summed; ``distinct_of``: out name → column.
    """
    counts, sums, distinct_of = counts or {}, sums or {}, distinct_of or {}
    if len(distinct_of) > 1:
        raise ValueError("salting keeps one distinct count exact, not several")
    salt_src = salt_by or (next(iter(distinct_of.values())) if distinct_of else None)
    if distinct_of and salt_src != next(iter(distinct_of.values())):
        raise ValueError("salt by the distinct-counted column")
    salt = (F.pmod(F.xxhash64(F.col(salt_src)), F.lit(salts)) if salt_src
            else F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)))
    phase1 = [F.count(F.lit(1) if c == "*" else F.col(c)).alias(n) for n, c in counts.items()]
    phase1 += [F.sum(c).alias(n) for n, c in sums.items()]
    phase1 += [F.countDistinct(c).alias(n) for n, c in distinct_of.items()]
    partial = df.groupBy(key, salt.alias("__salt")).agg(*phase1)
    phase2 = [F.sum(n).alias(n) for n in counts]
    phase2 += [F.sum(n).alias(n) for n in sums]
    phase2 += [F.sum(n).alias(n) for n in distinct_of]
    return partial.groupBy(key).agg(*phase2)


def tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens of a whole text (empty tokens dropped)."""
    return F.array_remove(F.split(F.lower(text), WORD_SEPARATORS), "")


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A13 word count over whole texts: explode tokens, count per word.

    ``groupBy().count()`` runs a partial aggregate on each map task (the
    MapReduce combiner) before the shuffle, so a frequent word costs one
    row per task in the shuffle, not one row per occurrence.
    """
    return (docs.select(F.explode(tokens(F.col(text_col))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
