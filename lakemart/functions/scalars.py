"""Scalar expressions as compositions of built-in
``pyspark.sql.functions``: everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---- dates (P6, P9) -------------------------------------------------------

def day_range(ts: Column, day: str) -> Column:
    """``ts`` falls on ``day`` as a half-open range, so the predicate is
    pushed to the Parquet scan (``date_trunc(ts) = day`` is not)."""
    start = F.lit(day).cast("timestamp_ntz")
    return (ts >= start) & (ts < start + F.expr("INTERVAL 1 DAY"))


def month_start(d: Column) -> Column:
    """date_trunc('month', d) as DATE (date_trunc on a DATE gives TIMESTAMP)."""
    return F.date_trunc("month", d).cast("date")


def yyyymm(d: Column) -> Column:
    """Month number like ``toYYYYMM``: 199501."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def parse_timestamp_any(s: Column, formats: list[str]) -> Column:
    """Best-effort parse: the first format that fits wins, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


# Fixed value: the input formats accepted by the raw-order loader.  ISO-8601
# with an offset ("Z" or "+03:00") is an instant; the others are read in the
# session time zone.
TIMESTAMP_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
                     "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


# ---- strings (P8) ---------------------------------------------------------

def email_domain(email: Column) -> Column:
    return F.substring_index(email, "@", -1)


# ---- math (P10) -----------------------------------------------------------

def safe_pct(part: Column, whole: Column) -> Column:
    """100 × part / whole in DOUBLE, NULL when whole is 0 (``/0`` raises
    under ANSI)."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def rate_as_decimal(rate: Column) -> Column:
    """A two-decimal rate (0.05) as an exact decimal."""
    return rate.cast("decimal(4,2)")


# ---- arrays / maps / nested (P11–P13) -------------------------------------

def first_or_default(arr: Column, default) -> Column:
    """First element of an array or ``default`` (``get`` gives NULL out of
    bounds where ``arr[0]`` raises under ANSI)."""
    return F.coalesce(F.get(arr, 0), F.lit(default))


def json_member(text: Column, path: str, cast: str | None = None) -> Column:
    v = F.get_json_object(text, path)
    return v.cast(cast) if cast else v


# ---- conditional (P14) ----------------------------------------------------

# Order size bands (lower bounds, inclusive).
SIZE_BANDS = [("large", 300000), ("medium", 100000)]


def size_label(amount: Column) -> Column:
    expr = None
    for label, lo in SIZE_BANDS:
        cond = amount >= lo
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("small")


# ---- missing values (P15) -------------------------------------------------

def fill_missing(df, defaults: dict):
    """``na.fill`` per column (only the columns named; types must match)."""
    return df.na.fill(defaults)


# ---- row quality (P5, D5) -------------------------------------------------

def is_clean(*positive_cols: str, mode: str = "and") -> Column:
    """Clean when every column is > 0 (``mode='or'`` keeps the original
    looser any-column form as an option)."""
    conds = [F.col(c) > 0 for c in positive_cols]
    out = conds[0]
    for c in conds[1:]:
        out = (out & c) if mode == "and" else (out | c)
    return out


def is_bad(clean: Column) -> Column:
    """Complement of ``clean`` that also catches NULLs: clean and bad
    partition the input."""
    return ~F.coalesce(clean, F.lit(False))
