"""Reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN (and +-inf) are the reference's missing values; make them NULL."""
    c = col_(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def to_double(c) -> Column:
    """Coercing numeric parse: bad text -> NULL, NaN/inf -> NULL."""
    return nan_to_null(F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double"))


def safe_div(a, b) -> Column:
    """Division with x/0 and 0/0 -> NULL (the reference's inf/NaN)."""
    return F.try_divide(col_(a), col_(b))


def rolling(fn, c, k: int, w: WindowSpec) -> Column:
    """pandas ``rolling(k, min_periods=k)``: NULL unless all k rows are
    non-null."""
    frame = w.rowsBetween(-(k - 1), 0)
    c = col_(c)
    return F.when(F.count(c).over(frame) == k, fn(c).over(frame))


def envelope_high(high="high", open_="open", close="close", low="low") -> Column:
    """high = max(high, open, close, low) with a NULL high staying NULL."""
    h = col_(high)
    return F.when(h.isNotNull(), F.greatest(h, col_(open_), col_(close), col_(low)))


def envelope_low(low="low", open_="open", close="close", high="high") -> Column:
    """low = min(low, open, close, high), computed with the repaired high."""
    lo = col_(low)
    return F.when(lo.isNotNull(), F.least(lo, col_(open_), col_(close), col_(high)))


def iso_utc(ts) -> Column:
    """ISO-8601 text with a +00:00 offset and microseconds only when
    non-zero (the format of Python's ``isoformat`` on a UTC timestamp)."""
    ts = col_(ts)
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, ".SSSSSS")
    has_frac = (F.unix_micros(ts.cast("timestamp")) % 1_000_000) != 0
    return F.concat(base, F.when(has_frac, frac).otherwise(F.lit("")), F.lit("+00:00"))


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ (NTZ read
    as UTC)."""
    return F.unix_micros(col_(ts).cast("timestamp"))


__all__ = [
    "Window", "nan_to_null", "to_double", "safe_div", "rolling",
    "envelope_high", "envelope_low", "iso_utc", "epoch_micros",
]
