"""Scalar column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_flag(c: str | Column) -> Column:
    """'True' (any case, padded) -> 1, anything else including NULL -> 0."""
    return F.when(F.lower(F.trim(col_or(c))) == F.lit("true"), F.lit(1)).otherwise(F.lit(0)).cast("int")


def blank_to_null(c: str | Column) -> Column:
    """Trimmed text, blank -> NULL; apply before any cast (ANSI casts of '' throw)."""
    return F.nullif(F.trim(col_or(c)), F.lit(""))


def days_in_month(d: str | Column) -> Column:
    return F.dayofmonth(F.last_day(col_or(d)))


def is_month_end(d: str | Column) -> Column:
    d = col_or(d)
    return F.when(d == F.last_day(d), F.lit(1)).otherwise(F.lit(0))


def calendar_month_diff(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries crossed (31 Jan -> 1 Feb = 1)."""
    s, e = col_or(start), col_or(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def month_bucket(d: str | Column) -> Column:
    return F.trunc(col_or(d), "month")


def guarded_pct(num: str | Column, den: str | Column) -> Column:
    """num / den * 100, 0.0 when den <= 0 (or NULL)."""
    n, d = col_or(num), col_or(den)
    return F.when(d > 0, n / d * F.lit(100.0)).otherwise(F.lit(0.0))


def driver_label(name: str | Column) -> Column:
    """'net_mrr_delta' -> 'Net Mrr Delta'."""
    return F.initcap(F.regexp_replace(col_or(name), "_", " "))


def sign_label(total: str | Column) -> Column:
    return F.when(col_or(total) >= 0, F.lit("Positive")).otherwise(F.lit("Negative"))


def money_double(c: str | Column, scale: int = 4) -> Column:
    """Decimal/avg result -> rounded double, the form used in reports."""
    return F.round(col_or(c), scale).cast("double")


def cents(c: str | Column) -> Column:
    """Exact 2-decimal money value as integer cents."""
    return (col_or(c) * 100).cast("bigint")


def half_up_ratio(num: str | Column, den: str | Column, scale: int = 4) -> Column:
    """num / den for integer-valued inputs, rounded half-up on the exact
    quotient (decimal(18,0) / decimal(18,0) keeps 19 fractional digits);
    NULL when den is 0 or NULL.  Gives the same digits on every engine."""
    n, d = col_or(num), col_or(den)
    q = n.cast("decimal(18,0)") / d.cast("decimal(18,0)")
    return F.when(d != 0, F.round(q, scale).cast("double"))


def ts_on_days(ts: str | Column, first=None, last=None) -> Column:
    """``to_date(ts)`` between ``first`` and ``last`` (either may be None),
    written on the raw timestamp_ntz column as a half-open range so that
    Parquet can use it (min/max statistics, pushed filters)."""
    c = col_or(ts)
    cond = F.lit(True)
    if first is not None:
        cond = cond & (c >= F.lit(str(first)).cast("timestamp_ntz"))
    if last is not None:
        cond = cond & (c < F.date_add(F.lit(str(last)).cast("date"), 1).cast("timestamp_ntz"))
    return cond
