"""Missing-candle reports.

* ``check_gaps`` (ingest side): per symbol, every bar whose open time is not
  the previous bar's open time plus one step, with the number of whole
  steps missing in between.
* ``find_time_gaps`` (feature side): runs of missing points of the regular
  grid anchored at each symbol's first bar, ``(gap_start, gap_end,
  missing_count)``; off-grid bars are ignored.
* ``grid_missing``: the same missing grid points listed one per row, from
  presence bitmaps of 64 grid points each.

Time is cut into chunks of ``Layout.bucket_steps`` steps, the same for every
symbol, and rows are dealt by ``(symbol, chunk)``.  Bars are paired with
their predecessor inside a chunk; what crosses a border comes from a table
of one row per chunk (its first and last bar), which also carries the
symbol's first bar to its chunks.  So a symbol is never one task, and bars
are joined and grouped by symbol and chunk, never by the symbol alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.config import Layout
from barforge.functions.columns import epoch_micros, iso_utc
from barforge.functions.intervals import ingest_step_ms, step_micros
from barforge.operators.series import with_series_key

#: Grid points of one bitmap, the bits of a long.
WORD = 64


def _whole(value: Column, width: int) -> Column:
    """``value`` divided by ``width`` and rounded down, exactly."""
    return ((value - F.pmod(value, F.lit(width))) / F.lit(width)).cast("long")


def _dealt(df: DataFrame, symbol: str, ts: str, step_us: int, layout: Layout | None) -> DataFrame:
    """``(symbol, us, chunk)`` of the bars with a time, dealt by symbol and chunk."""
    us = df.select(F.col(symbol).alias("symbol"), epoch_micros(ts).cast("long").alias("us")).where("us IS NOT NULL")
    width = step_us * (layout or Layout()).bucket_steps
    return us.withColumn("chunk", _whole(F.col("us"), width)).repartition("symbol", "chunk")


def _pairs(points: DataFrame, at: str, *carried: str, after: DataFrame | None = None) -> DataFrame:
    """``points`` (one row per bar, dealt by symbol and chunk) with the
    place ``before`` of the bar before, without each symbol's first bar.
    ``carried`` columns are the same for all bars of a symbol; ``after``:
    one more place for each symbol, behind all its bars."""
    inside = Window.partitionBy("symbol", "chunk").orderBy(at)
    within = points.select("symbol", at, *carried, F.lag(at).over(inside).alias("before"))
    ends = points.groupBy("symbol", "chunk").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), *[F.first(c).alias(c) for c in carried])
    if after is not None:
        ends = ends.unionByName(after.select("symbol", F.lit(2**62).alias("chunk"), F.col(at).alias("lo"), F.col(at).alias("hi"), *carried))
    chunks = Window.partitionBy("symbol").orderBy("chunk")
    across = ends.select("symbol", F.col("lo").alias(at), *carried, F.lag("hi").over(chunks).alias("before"))
    return within.unionByName(across).where("before IS NOT NULL")


def check_gaps(df: DataFrame, interval: str, symbol: str = "symbol", ts: str = "open_time",
               layout: Layout | None = None) -> DataFrame:
    """``(symbol, gap_before, missing_candles)``; empty frame keeps the
    schema.  All series are cut alike."""
    step = ingest_step_ms(interval) * 1000
    apart = F.col("us") - F.col("before")
    missing = F.greatest(_whole(apart, step) - 1, F.lit(0)).cast("long")
    return _pairs(_dealt(df, symbol, ts, step, layout), "us").where(apart != step).select(
        "symbol", iso_utc(F.timestamp_micros("us")).alias("gap_before"), missing.alias("missing_candles"))


def _on_grid(df: DataFrame, symbol: str, ts: str, step_us: int, layout: Layout | None) -> tuple[DataFrame, DataFrame]:
    """The bars on the grid of their symbol's first bar, ``(symbol, chunk,
    k, phase)`` with time = k * step + phase, and the grid's ends ``(symbol,
    phase, k0, k1)``, one row per symbol."""
    bars = _dealt(df, symbol, ts, step_us, layout)
    chunks = bars.groupBy("symbol", "chunk").agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    first = F.min("lo").over(Window.partitionBy("symbol"))
    phases = chunks.select("symbol", "chunk", F.pmod(first, F.lit(step_us)).alias("phase"))
    points = (bars.join(phases, ["symbol", "chunk"]).where(F.pmod("us", F.lit(step_us)) == F.col("phase"))
              .select("symbol", "chunk", _whole(F.col("us"), step_us).alias("k"), "phase"))
    ends = chunks.groupBy("symbol").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        "symbol", F.pmod("lo", F.lit(step_us)).alias("phase"), _whole(F.col("lo"), step_us).alias("k0"), "hi")
    return points, ends.select("symbol", "phase", "k0", _whole(F.col("hi") - F.col("phase"), step_us).alias("k1"))


def _time(k: Column, step_us: int, like: str) -> Column:
    at = F.timestamp_micros(k * F.lit(step_us) + F.col("phase"))
    return at.cast("timestamp_ntz") if like == "timestamp_ntz" else at


def find_time_gaps(df: DataFrame, interval: str = "5m", max_allow_miss: int = 0, symbol: str = "symbol",
                   ts: str = "ts", layout: Layout | None = None) -> DataFrame:
    """``(symbol, gap_start, gap_end, missing_count)`` for runs of missing
    grid points longer than ``max_allow_miss``.  All series
    are cut alike."""
    if ts not in df.columns:
        raise ValueError(f"gap search needs the time column {ts!r}; clean the candles first")
    step, like = step_micros(interval), dict(df.dtypes)[ts]
    df, restore = with_series_key(df, symbol)
    points, ends = _on_grid(df, symbol, ts, step, layout)
    # a place after the grid's end closes a run that ends there (last bar off the grid)
    after = ends.select("symbol", (F.col("k1") + 1).alias("k"), "phase")
    missing = F.col("k") - F.col("before") - 1
    runs = _pairs(points, "k", "phase", after=after).where((missing > max_allow_miss) & (missing > 0)).select(
        "symbol", _time(F.col("before") + 1, step, like).alias("gap_start"), _time(F.col("k") - 1, step, like).alias("gap_end"),
        missing.cast("long").alias("missing_count"))
    return restore(runs) if symbol == "symbol" else runs


def grid_missing(df: DataFrame, interval: str = "5m", symbol: str = "symbol", ts: str = "ts",
                 chunk: int = 4096, layout: Layout | None = None) -> DataFrame:
    """Missing grid points ``(symbol, ts)`` from each symbol's first to last
    bar.  Present bars set bits of 64-point words; the words of the grid,
    made ``chunk`` points at a time, are joined with them, full words go,
    and only the zero bits of the others become rows."""
    step, like = step_micros(interval), dict(df.dtypes)[ts]
    df, restore = with_series_key(df, symbol)
    points, ends = _on_grid(df, symbol, ts, step, layout)
    bit = F.expr(f"shiftleft(1L, CAST(pmod(k, {WORD}) AS INT))")
    present = points.groupBy("symbol", _whole(F.col("k"), WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    words = max(1, chunk // WORD)
    first, last = _whole(F.col("k0"), WORD), _whole(F.col("k1"), WORD)
    blocks = ends.select("*", F.explode(F.sequence(_whole(first, words), _whole(last, words))).alias("block")).repartition("symbol", "block")
    low, high = F.greatest(F.col("block") * words, first), F.least(F.col("block") * words + (words - 1), last)
    grid = blocks.select("symbol", "phase", "k0", "k1", F.explode(F.sequence(low, high)).alias("word"))
    gaps = grid.join(present, ["symbol", "word"], "left").withColumn("bits", F.coalesce("bits", F.lit(0).cast("long"))).where("bits <> -1")
    place = F.expr(f"explode(filter(sequence(0, {WORD - 1}), i -> getbit(bits, i) = 0 AND word * {WORD} + i BETWEEN k0 AND k1))")
    out = gaps.select("symbol", "phase", "word", place.alias("i")).select(
        "symbol", _time(F.col("word") * WORD + F.col("i"), step, like).alias("ts"))
    return restore(out) if symbol == "symbol" else out


def first_gaps(gaps: DataFrame, n: int = 20, order=("symbol", "gap_start")) -> DataFrame:
    """The first ``n`` gap rows (the reports print only these)."""
    return gaps.orderBy(*order).limit(n)
