"""Typed projection of all-string raw rows.

Raw layers land text as is; the staging step casts every field to its
declared type.  ANSI mode stays on: trusted inputs use ``cast`` (a bad value
fails the job), raw inputs use ``try_cast`` and count the fields that did not
parse into ``_bad_fields`` so rejects can be routed instead of lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_projection(df: DataFrame, types: dict[str, str], strict: bool = False,
                     rename: dict[str, str] | None = None, with_load_time: bool = False) -> DataFrame:
    rename = rename or {}
    cols, bad = [], []
    for name, typ in types.items():
        raw = F.col(name)
        typed = raw.cast(typ) if strict else raw.try_cast(typ)
        cols.append(typed.alias(rename.get(name, name)))
        if not strict:
            bad.append(F.when(raw.isNotNull() & typed.isNull(), 1).otherwise(0))
    if bad:
        total = bad[0]
        for x in bad[1:]:
            total = total + x
        cols.append(total.cast("int").alias("_bad_fields"))
    if with_load_time:
        cols.append(F.current_timestamp().alias("loaded_at"))
    return df.select(*cols)


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text (what a header CSV read without inference gives)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
