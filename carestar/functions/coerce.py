"""Null-tolerant coercions (the ``errors="coerce"`` family) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text -> double, unparsable -> NULL (ANSI-safe ``try_cast``)."""
    return _c(c).try_cast("double")


def to_int(c) -> Column:
    """Text/number -> int, unparsable -> NULL.  Parses ``"3.0"`` as 3."""
    col = _c(c)
    return F.coalesce(col.try_cast("int"), col.try_cast("double").try_cast("int"))


def with_default(c, default) -> Column:
    """``fillna(default)`` after coercion."""
    return F.coalesce(_c(c), F.lit(default))


def number_or(c, default) -> Column:
    return F.coalesce(to_number(c), F.lit(float(default)))


def int_or(c, default) -> Column:
    return F.coalesce(to_int(c), F.lit(int(default)))


def to_date(c) -> Column:
    """Text / timestamp -> date.  Accepts ``yyyy-MM-dd`` optionally followed by a
    time part; impossible dates such as 2024-02-30 become NULL."""
    col = _c(c)
    return F.coalesce(col.try_cast("date"), F.substring(col.cast("string"), 1, 10).try_cast("date"))


def iso_date(c) -> Column:
    """Text -> ``yyyy-MM-dd`` text; invalid -> NULL."""
    return F.date_format(to_date(c), "yyyy-MM-dd")


def date_key(c) -> Column:
    """The first ten characters of the value, as a date (reference ``str[:10]``)."""
    return F.substring(_c(c).cast("string"), 1, 10).try_cast("date")


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)`` in double."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def divide_or_zero(num, den) -> Column:
    """DAX ``DIVIDE(a, b, 0)``: 0 when b is 0 or blank."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def pct(num, den, digits: int = 2) -> Column:
    """``ROUND(num * 100.0 / den, digits)`` in double; NULL when den is 0."""
    return F.round(safe_div(_c(num).cast("double") * F.lit(100.0), den), digits)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int, NULL -> 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def ntz(value) -> Column:
    """A ``timestamp_ntz`` literal built from text: the wall-clock value is kept
    whatever the session or Python process time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def literal_like(value, dtype) -> Column:
    """``value`` as a literal of ``dtype``; datetimes go through text so that a
    naive Python datetime compares as the same wall-clock value."""
    if hasattr(value, "isoformat") and hasattr(value, "hour"):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)
