"""Load-time cleaning of raw candles (row-level expressions plus one
keyed de-duplication).

Order, as in the reference: parse times -> (symbol check) -> rename
``open_time`` to ``ts`` -> keep the last row per timestamp -> coerce numbers
-> drop rows without ``ts`` or ``close`` -> repair the OHLC envelope.
Row-level steps commute with the de-duplication, so they are applied first
and the de-duplication can share the exchange of the window operator that
follows (see ``SeriesPlan.dedup_order``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.functions.columns import envelope_high, envelope_low, nan_to_null, to_double
from barforge.sources.schema import NUMERIC_COLUMNS


def parse_time(c: str, dtype) -> Column:
    """Timestamp parse with bad input -> NULL.  Text: any ISO-8601 form
    (offset honoured, naive read as UTC); integers: epoch milliseconds."""
    col = F.col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return F.timestamp_millis(col)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.timestamp_millis(col.cast("long"))
    s = F.trim(col.cast("string"))
    # a bare number is epoch milliseconds; the cast would read short ones as years
    return F.when(s.rlike(r"^-?\d{9,}$"), F.timestamp_millis(s.try_cast("long"))).otherwise(s.try_cast("timestamp"))


def check_symbol(df: DataFrame, expected_symbol: str | None, symbol: str = "symbol") -> None:
    """Raise unless ``expected_symbol`` occurs.  One pruned lookup; the
    message names a few of the symbols there are."""
    if expected_symbol is None:
        return
    if df.filter(F.col(symbol).cast("string") == expected_symbol).limit(1).count() == 0:
        some = [str(r[0]) for r in df.select(F.col(symbol).cast("string")).distinct().limit(10).collect()]
        raise ValueError(f"no rows of symbol {expected_symbol!r}; the input holds, among others, {sorted(some)}")


def prepare_rows(df: DataFrame) -> DataFrame:
    """Row-level part of cleaning: parse times, rename, coerce, envelope."""
    sch = {f.name: f.dataType for f in df.schema.fields}
    if "open_time" not in sch or "close_time" not in sch:
        raise ValueError("raw candles need open_time and close_time")
    out = df
    for c in ("open_time", "close_time"):
        out = out.withColumn(c, parse_time(c, sch[c]))
    out = out.withColumnRenamed("open_time", "ts")
    for c in NUMERIC_COLUMNS:
        if c in sch:
            dt = sch[c]
            out = out.withColumn(c, nan_to_null(F.col(c).cast("double")) if isinstance(dt, T.NumericType)
                                 else to_double(c))
    if "trades" in sch and isinstance(sch["trades"], T.StringType):
        out = out.withColumn("trades", F.col("trades").try_cast("double").try_cast("long"))
    out = out.withColumn("high", envelope_high())
    out = out.withColumn("low", envelope_low())
    return out


def dedup_order(columns) -> list[Column]:
    """Deterministic "keep last": ingestion order if the frame has one
    (``_ingest_seq``), else the largest close_time, trades, then every other
    column."""
    cols = list(columns)
    order = []
    for c in ("_ingest_seq", "close_time", "trades"):
        if c in cols:
            order.append(F.col(c).desc_nulls_last())
    for c in cols:
        if c not in ("_ingest_seq", "close_time", "trades", "symbol", "ts"):
            order.append(F.col(c).desc_nulls_last())
    return order


def keep_valid() -> Column:
    return F.col("ts").isNotNull() & F.col("close").isNotNull()


def dedup_last(df: DataFrame, keys=("symbol", "ts"), order=None) -> DataFrame:
    """One row per key: the last by the tie-break (a keyed window; the groups
    are duplicates of one bar, so they are small)."""
    order = order or dedup_order(df.columns)
    w = Window.partitionBy(*[k for k in keys if k in df.columns]).orderBy(*order)
    return df.withColumn("_dup", F.row_number().over(w)).filter("_dup = 1").drop("_dup")


def prepare_bars(df: DataFrame, expected_symbol: str | None = None) -> DataFrame:
    """Full ``load_and_prepare`` as one DataFrame transform."""
    if "symbol" not in df.columns:
        df = df.withColumn("symbol", F.lit(None).cast("string"))
    check_symbol(df, expected_symbol)
    rows = prepare_rows(df)
    return dedup_last(rows).filter(keep_valid())
