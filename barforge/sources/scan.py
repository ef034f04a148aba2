"""Bounded multi-symbol scan: one read, symbol and time predicates pushed to
the source (partition pruning on ``symbol``, Parquet statistics on the
time column)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.intervals import resolve_window


def bounded_scan(df: DataFrame, symbols=None, start=None, end=None, open_time: str = "open_time") -> DataFrame:
    """Rows of the given symbols with ``start <= open_time < end``."""
    out = df
    if symbols:
        out = out.filter(F.upper(F.col("symbol")).isin([s.upper() for s in symbols]))
    if start is not None:
        out = out.filter(F.col(open_time) >= F.lit(start))
    if end is not None:
        out = out.filter(F.col(open_time) < F.lit(end))
    return out


def fetch_window(df: DataFrame, symbols=None, days: int | None = None, start: str | None = None,
                 end: str | None = None, interval: str = "1m", now: datetime | None = None,
                 open_time: str = "open_time") -> DataFrame:
    """``fetch_klines`` over landed data: resolve the window on the driver,
    then a bounded scan."""
    s, e = resolve_window(days, start, end, interval, now)
    if dict(df.dtypes).get(open_time) == "timestamp_ntz":
        s, e = s.replace(tzinfo=None), e.replace(tzinfo=None)
    return bounded_scan(df, symbols, s, e, open_time)
