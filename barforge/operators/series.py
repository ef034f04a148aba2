"""Per-symbol series layout for window work.

Every time-series operator here is a window over ``(symbol ORDER BY ts)``.
Spark evaluates such a window one partition key at a time, so a symbol that
holds a large share of all bars would become a single task.  One layout serves
all series, whatever their length:

1. Rows are dealt by ``(symbol, _tb)``, a bucket of ``Layout.bucket_steps`` steps
   of time.  De-duplication and the place in the bucket are windows there.
2. A table with one row per bucket (its count) gives by a prefix sum what lies
   before each bucket, so every row has its exact number ``_rn`` in its series.
3. Rows are dealt by ``(symbol, _blk)``, blocks of ``Layout.block_rows`` numbers;
   all windows of an operator share this exchange.  Each block also receives the
   last ``back`` rows of the block before it and the first ``ahead`` rows of the
   next one as *halo* rows (``_core = false``), so bounded frames, ``lag`` and
   ``lead`` are exact inside every block.  Halo rows are dropped after the windows.

No task holds more than a bucket or a block with its halo, the driver holds
nothing of the data, and results do not depend on the sizes chosen.

Where the caller knows that no series is longer than a block (``longest``), every series is its block: rows are dealt by
symbol once, and nothing is numbered, counted or joined.  A ``longest`` that is too small makes long tasks, not wrong rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barforge.config import Layout
from barforge.functions.columns import epoch_micros

BLK = "_blk"
RN = "_rn"
CORE = "_core"
#: Does the series go on after the row's block?
MORE = "_more"
INTERNAL = (BLK, RN, CORE, MORE)


#: Stands for a NULL symbol while rows are keyed by it (joins match no NULLs).
NO_SYMBOL = "\x00"


def with_series_key(df: DataFrame, symbol: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with a symbol that is never NULL, and the way back."""
    if dict(df.dtypes).get(symbol) != "string":
        return df, lambda out: out
    keyed = df.withColumn(symbol, F.coalesce(symbol, F.lit(NO_SYMBOL)))
    return keyed, lambda out: out.withColumn(symbol, F.nullif(F.col(symbol), F.lit(NO_SYMBOL))) if symbol in out.columns else out


#: Bucket of the rows without a time; like NULL, it comes before all others.
NO_TIME = -(2**63)


@dataclass
class SeriesPlan:
    """Lays out ``df`` (one row per bar, keyed ``symbol, ts``) for windows.

    ``back`` / ``ahead``: rows before / after the current row that any window
    of the operator reads (halo sizes).
    ``dedup_order``: when given, keep one row per ``(symbol, ts)``: the first
    in this order (ties beyond it broken by the listed columns only).
    ``keep``: row filter applied after de-duplication, before numbering.
    ``step_us``: bar step, used to size the time buckets.
    ``longest``: a number of rows that no series exceeds, if the caller knows one.
    """

    df: DataFrame
    symbol: str = "symbol"
    ts: str = "ts"
    back: int = 0
    ahead: int = 0
    dedup_order: Sequence[Column] | None = None
    keep: Column | None = None
    step_us: int = 60_000_000
    layout: Layout = field(default_factory=Layout)
    longest: int | None = None

    def __post_init__(self):
        # without joins a NULL symbol needs no marker, and rows that lie dealt by symbol stay so
        self.df, self._restore = (self.df, lambda out: out) if self.whole else with_series_key(self.df, self.symbol)
        if self.back >= self.layout.block_rows or self.ahead >= self.layout.block_rows:
            raise ValueError("halo larger than a block")

    # ------------------------------------------------------------------
    @property
    def whole(self) -> bool:
        """Is every series known to be one block?"""
        return self.longest is not None and self.longest <= self.layout.block_rows

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(self.symbol, *([] if self.whole else [BLK])).orderBy(self.ts)

    def _bucketed(self) -> DataFrame:
        """De-duplicated, kept rows with their bucket, dealt by ``(symbol, _tb)``."""
        width = max(1, self.step_us) * self.layout.bucket_steps
        return self._kept(self.df.withColumn("_tb", F.coalesce(F.floor(epoch_micros(self.ts) / F.lit(width)), F.lit(NO_TIME))), "_tb")

    def _kept(self, df: DataFrame, *keys: str) -> DataFrame:
        """De-duplicated, kept rows of ``df``, dealt by symbol and ``keys``."""
        if self.dedup_order is not None:
            # copies are neighbours in this order: the same exchange and sort as the numbering's
            w = Window.partitionBy(self.symbol, *keys).orderBy(self.ts, *self.dedup_order)
            df = df.select("*", F.row_number().over(w).alias("_at"), F.lag(self.ts).over(w).alias("_ts0"))
            df = df.filter((F.col("_at") == 1) | ~F.col("_ts0").eqNullSafe(F.col(self.ts))).drop("_at", "_ts0")
        return df if self.keep is None else df.filter(self.keep)

    def numbered(self) -> DataFrame:
        """Rows with ``_rn``, their exact number in the series (from 1), and ``_total``, its length."""
        rows = self._bucketed()
        counts = rows.groupBy(F.col(self.symbol).alias("_osym"), F.col("_tb").alias("_otb")).agg(F.count(F.lit(1)).alias("_cnt"))
        before = Window.partitionBy("_osym").orderBy("_otb").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("_osym", "_otb", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                                F.sum("_cnt").over(Window.partitionBy("_osym")).alias("_total"))
        place = F.row_number().over(Window.partitionBy(self.symbol, "_tb").orderBy(self.ts)).alias("_at")
        same = F.col(self.symbol) == F.col("_osym")
        if dict(rows.dtypes)[self.symbol] != "string":  # a NULL symbol has no marker then
            same = F.col(self.symbol).eqNullSafe(F.col("_osym"))
        out = rows.select("*", place).join(offsets, same & (F.col("_tb") == F.col("_otb")))
        return out.withColumn(RN, (F.col("_off") + F.col("_at")).cast("long")).drop("_osym", "_otb", "_off", "_at", "_tb")

    def blocks(self) -> DataFrame:
        """Numbered rows with their block, and the halo rows of every block."""
        df, size = self.numbered(), self.layout.block_rows
        blk = F.floor((F.col(RN) - 1) / size).cast("long")
        if not (self.back or self.ahead):
            return df.withColumns({BLK: blk, CORE: F.lit(True), MORE: (blk + 1) * size < F.col("_total")}).drop("_total")
        place = (F.col(RN) - 1) % size
        own = F.struct(blk.alias("b"), F.lit(True).alias("c"))
        after = F.struct((blk + 1).alias("b"), F.lit(False).alias("c"))
        ahead = F.struct((blk - 1).alias("b"), F.lit(False).alias("c"))
        last, first = place >= size - self.back, (place < self.ahead) & (blk > 0)
        to = (F.when(last & first, F.array(own, after, ahead)).when(last, F.array(own, after))
              .when(first, F.array(own, ahead)).otherwise(F.array(own)))
        return df.withColumn("_t", F.explode(to)).withColumns(
            {BLK: F.col("_t.b"), CORE: F.col("_t.c"), MORE: (F.col("_t.b") + 1) * size < F.col("_total")}).drop("_t", "_total")

    # ------------------------------------------------------------------
    def map(self, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Apply ``fn`` to the laid-out frame.

        ``fn`` sees halo rows (``_core = false``) and may use ``self.window``;
        it must keep ``_core`` or drop halo rows itself.  The internal columns
        are removed from the result.  Where series are ``whole`` there are neither.
        """
        out = fn(self._kept(self.df) if self.whole else self.blocks())
        if CORE in out.columns:
            out = out.filter(F.col(CORE))
        out = self._restore(out)
        return out.drop(*[c for c in INTERNAL if c in out.columns])
