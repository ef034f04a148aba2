"""Recursive exponentially weighted mean (pandas ``ewm(adjust=False)``) as a
blocked affine scan built from window aggregates.

Definition (per symbol, rows in ``ts`` order, ``x`` possibly NULL):
the first non-NULL x seeds ``y = x``; a NULL row repeats the last ``y``;
a non-NULL row ``d`` rows after the previous non-NULL one gives
``y = (o*y_prev + a*x) / (o + a)`` with ``o = (1-a)^d`` (``d = 1``: the
usual ``(1-a)*y_prev + a*x``).  ``y`` is reported once ``min_periods``
non-NULL values were seen.

Every row is an affine map ``y -> A*y + B``; maps compose associatively.

1. Rows that stand in a layout block with a later block in their series (``_more``: none in a series of one
   block) are cut into e-blocks of ``Be`` consecutive rows (``_rn``).  Inside
   an e-block, with ``L = sum(ln A)`` and ``S = sum(B * exp(-L))`` as running
   window sums, the value assuming a zero carry-in is ``exp(L) * S``.  ``Be``
   bounds ``|L|`` so the exponentials stay finite.  The first non-NULL row
   of an e-block is left out of these sums (its map needs the distance to
   the previous non-NULL row, which may sit in an earlier e-block).
2. One summary row per e-block (count, first/last non-NULL position, block
   map).  Prefix counts and last positions give each block's first-row map,
   then the composite block map ``(A_E, B_E)``.
3. Carry-in of a layout block: the maps of the e-blocks before it, composed in
   order, nothing cut off, as a tree: those of a layout block first (an array
   bounded by ``block_rows / Be``), then the layout blocks' composites.  A scan cuts
   its array into pieces and scans the pieces' composites before the pieces, so
   its work stays near the array's length.  A value
   that decays below the smallest double stays that, with its sign, as a
   step-by-step recurrence does: it never turns into zero.
4. The carries, one row for every layout block but the first ones, are broadcast to the
   rows, which are not shuffled again, and the rows' maps are composed by doubling steps
   (numpy, a batch of sorted rows at a time, ``barforge.operators.arrow``).

The summary tables hold one row per ``Be`` bars of series of more than one layout block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.operators.arrow import AT, Step, add_doubles, numbers
from barforge.operators.series import BLK, CORE, MORE, RN
from barforge.session import persist

TINY = 5e-324         # the smallest double


@dataclass(frozen=True)
class EwmSpec:
    name: str            # output column
    x: str               # input column (already on the frame)
    alpha: float
    min_periods: int = 0
    dense: bool = False  # True: x has no NULL after its first value (one running sum suffices)

    @staticmethod
    def span(name: str, x: str, span: float, min_periods: int | None = None, dense: bool = False) -> "EwmSpec":
        return EwmSpec(name, x, 2.0 / (span + 1.0), int(span if min_periods is None else min_periods), dense)

    @staticmethod
    def wilder(name: str, x: str, period: int, dense: bool = False) -> "EwmSpec":
        return EwmSpec(name, x, 1.0 / period, period, dense)


def eblock_size(alpha: float, cap: int = 512) -> int:
    """Largest power of two <= cap with (Be-1)*|ln(1-alpha)| <= 600."""
    if alpha >= 1.0:
        return 1
    la = -math.log1p(-alpha)
    be = 1
    while be * 2 <= cap and (be * 2 - 1) * la <= 600.0:
        be *= 2
    return be


def _decayed(y, carry, factor, added):
    """``y``, or the smallest double of the carry's sign where a value that
    only decays (``factor`` > 0, nothing ``added``) has become zero."""
    return F.when((y == 0) & (carry != 0) & (factor > 0) & (added == 0), F.signum(carry) * F.lit(TINY)).otherwise(y)


#: Maps that are composed one after the other; longer arrays are cut into pieces of so many.
PIECE = 512


def _walk(maps, start):
    """The value before each map of an ordered array (A_E, B_E, A_f), from ``start``.
    Each step copies the values so far, so ``maps`` is a piece."""
    def step(acc, e):
        y = _decayed(e["A_E"] * acc["y"] + e["B_E"], acc["y"], e["A_f"], e["B_E"])
        return F.struct(y.alias("y"), F.concat(acc["ys"], F.array(acc["y"])).alias("ys"))
    first = F.struct(start.alias("y"), F.array().cast("array<double>").alias("ys"))
    return F.aggregate(maps, first, step)["ys"]


def _composite(maps):
    """The one map that an ordered array of maps amounts to; its A_f is 0 if some map forgets what was before."""
    def step(m, e):
        added = _decayed(e["A_E"] * m["B_E"] + e["B_E"], m["B_E"], e["A_f"], e["B_E"])
        return F.struct((e["A_E"] * m["A_E"]).alias("A_E"), added.alias("B_E"), F.least(m["A_f"], e["A_f"]).alias("A_f"))
    return F.aggregate(maps, F.struct(F.lit(1.0).alias("A_E"), F.lit(0.0).alias("B_E"), F.lit(1.0).alias("A_f")), step)


def _scan(maps: str, start):
    """``_walk`` over an array of any length, in two levels: pieces are composed, the
    composites walked, then each piece from the value before it."""
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(maps) - 1) / PIECE).cast("int")), lambda i: F.slice(maps, i * PIECE + 1, PIECE))
    return F.flatten(F.zip_with(pieces, _walk(F.transform(pieces, _composite), start), _walk))


def _ln1m(alpha: float) -> float:
    return math.log1p(-alpha) if alpha < 1.0 else float("-inf")


def _prefix(tbl: DataFrame, keys: list[str], cols: dict[str, tuple[str, str]]) -> DataFrame:
    """Exclusive prefix aggregates over e-blocks in ``(_blk, _eb)`` order
    within ``keys``.  ``cols``: out -> (input column, 'sum'|'max').

    Two levels: inside each layout block (bounded number of e-blocks), then
    over the per-block totals (one row per layout block).
    """
    agg = {"sum": F.sum, "max": F.max}
    w_in = Window.partitionBy(*keys, BLK).orderBy("_eb").rowsBetween(Window.unboundedPreceding, -1)
    out = tbl.select("*", *[agg[how](c).over(w_in).alias(n) for n, (c, how) in cols.items()])
    tot = tbl.groupBy(*keys, BLK).agg(*[agg[how](c).alias(f"_t_{n}") for n, (c, how) in cols.items()])
    w_b = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, BLK, *[agg[how](f"_t_{n}").over(w_b).alias(f"_p_{n}") for n, (c, how) in cols.items()])
    out = out.join(tot, [*keys, BLK])
    fixed = []
    for n, (c, how) in cols.items():
        if how == "sum":
            z = F.lit(0).cast(out.schema[n].dataType)
            e = F.coalesce(F.col(n), z) + F.coalesce(F.col(f"_p_{n}"), z)
            fixed.append(F.when(F.col(n).isNull() & F.col(f"_p_{n}").isNull(), F.lit(None)).otherwise(e).alias(n))
        else:
            fixed.append(F.greatest(F.col(n), F.col(f"_p_{n}")).alias(n))
    rest = [c for c in out.columns if c not in cols and not c.startswith("_p_")]
    return out.select(*rest, *fixed)


def _groups(specs: Sequence[EwmSpec], cap: int) -> list[tuple[int, list[EwmSpec]]]:
    """Specs by the size of their e-blocks."""
    groups: dict[int, list[EwmSpec]] = {}
    for s in specs:
        if s.dense and s.alpha >= 1.0:  # e-blocks of one row: nothing to sum
            s = EwmSpec(s.name, s.x, s.alpha, s.min_periods, False)
        groups.setdefault(eblock_size(s.alpha, cap), []).append(s)
    return sorted(groups.items(), reverse=True)


def ewm_carries(df: DataFrame, specs: Sequence[EwmSpec], symbol: str = "symbol", ts: str = "ts",
                block_rows: int = 1 << 20, cap: int = 512) -> list[DataFrame]:
    """For each group of specs what reaches the layout blocks from those before them: one row per block that is not
    the first of its series.  Only rows of ``df`` (laid out by ``SeriesPlan``) whose series goes on after their block are read."""
    rows = df.filter(F.col(MORE)) if MORE in df.columns else df
    rows = rows.filter(F.col(CORE)) if CORE in df.columns else rows
    return [_carries(rows, group, be, symbol, ts, block_rows) for be, group in _groups(specs, cap)]


def add_ewms(df: DataFrame, specs: Sequence[EwmSpec], symbol: str = "symbol", ts: str = "ts",
             block_rows: int = 1 << 20, cap: int = 512, carries: list[DataFrame] | None = None) -> DataFrame:
    """Add one column per spec to ``df`` (laid out by ``SeriesPlan``: rows
    carry ``_blk``, ``_rn`` and ``_core``).  Halo rows pass through with
    NULL results; only core rows enter the scan.  ``carries``: those of the same rows, by default
    found here."""
    given = df.columns
    df = join_carries(df, specs, ewm_carries(df, specs, symbol, ts, block_rows, cap) if carries is None else carries, symbol, cap)
    if AT not in given:
        df = df.withColumn(AT, F.row_number().over(Window.partitionBy(symbol, BLK).orderBy(ts)))
    return add_doubles(df, [ewm_step(specs, cap)]).select(*given, *[s.name for s in specs])


def join_carries(df: DataFrame, specs: Sequence[EwmSpec], carries: list[DataFrame], symbol: str = "symbol", cap: int = 512) -> DataFrame:
    """``df`` with a column of carries for every group of specs, which ``ewm_step`` reads; its rows stay in their order."""
    for (_, group), carry in zip(_groups(specs, cap), carries):
        carry = F.broadcast(carry.toDF("_csym", "_cblk", _carry_name(group)))
        df = df.join(carry, F.col(symbol).eqNullSafe(F.col("_csym")) & (F.col(BLK) == F.col("_cblk")), "left").drop("_csym", "_cblk")
    return df


def _carry_name(group: list[EwmSpec]) -> str:
    return f"_carry_{group[0].name}"


def ewm_step(specs: Sequence[EwmSpec], cap: int = 512) -> Step:
    """The columns of ``add_ewms`` as a step over numbered rows with their carries (without them: each series is one block)."""
    groups = [group for _, group in _groups(specs, cap)]
    return [s.name for group in groups for s in group], _recursion(groups)


def _state(text: str) -> list:
    """(value, rows since the last observation, observations) of each spec, None without one."""
    values = [float(v) if v else None for v in text.split(",")]
    return [None if values[i] is None else tuple(values[i:i + 3]) for i in range(0, len(values), 3)]


def _maps(x: np.ndarray, ok: np.ndarray, first: np.ndarray, of: np.ndarray, alpha: float, states: dict[int, tuple]):
    """(A, B) of every row: ``ok`` marks observations, ``first`` the first rows of series, ``of`` the series of a row;
    ``states`` are those in which series go on, by their number.  Also the observations counted up to the row."""
    at = np.arange(len(x))
    begin = first[of]
    prev = np.concatenate([[-1], np.maximum.accumulate(np.where(ok, at, -1))[:-1]])
    gap, value, count = np.full(len(first), -1.0), np.zeros(len(first)), np.zeros(len(first))
    for i, state in states.items():
        value[i], gap[i], count[i] = state
    inside, goes_on = prev >= begin, gap[of] >= 0
    d = np.where(inside, at - prev, at - begin + gap[of] + 1.0)
    o = (1.0 - alpha) ** d
    after = ok & (inside | goes_on)
    a = np.where(ok, np.where(after, np.where(d == 1, 1.0 - alpha, o / (o + alpha)), 0.0), 1.0)
    b = np.where(ok, np.where(after, np.where(d == 1, alpha * x, alpha * x / (o + alpha)), x), 0.0)
    start = first[gap >= 0]
    if len(start):
        y0, added = value[gap >= 0], b[start]
        y = a[start] * y0 + added
        b[start] = np.where((y == 0) & (y0 != 0) & (a[start] > 0) & (added == 0), np.copysign(TINY, y0), y)
    seen = np.cumsum(ok)
    return a, b, seen - (seen[begin] - ok[begin]) + count[of]


def _kept_tiny(y: np.ndarray, decays: np.ndarray, first: np.ndarray, of: np.ndarray) -> np.ndarray:
    """``y`` with the smallest double of its sign where a value that only ``decays`` has become zero."""
    if y.all():
        return y
    mark = ~decays | (y != 0)
    mark[first] = True
    last = np.maximum.accumulate(np.where(mark, np.arange(len(y)), 0))
    return np.where((y == 0) & (y[last] != 0), np.copysign(TINY, y[last]), y)


def _recursion(groups: list[list[EwmSpec]]):
    """Step of ``add_doubles``: the values of core rows, from the carries of a block or the state after the last batch."""
    specs = [s for group in groups for s in group]

    def run(batches):
        left = None  # states after the last row
        for b, at in batches:
            begins = at == 1
            series = np.cumsum(begins)  # 0 goes on from the last batch
            rows = np.flatnonzero(b.column(CORE).to_numpy(zero_copy_only=False)) if CORE in b.schema.names else np.arange(b.num_rows)
            states = {0: left} if left is not None and not begins[0] else {}
            where, offset = np.flatnonzero(begins), 0
            for group in groups:
                carried = b.column(_carry_name(group)).take(where) if _carry_name(group) in b.schema.names else pa.nulls(len(where))
                for j in np.flatnonzero(carried.is_valid().to_numpy(zero_copy_only=False)):
                    states.setdefault(int(series[where[j]]), [None] * len(specs))[offset:offset + len(group)] = _state(carried[int(j)].as_py())
                offset += len(group)
            out = [(np.zeros(b.num_rows), np.zeros(b.num_rows, bool)) for _ in specs]
            last = int(series[-1])
            left = states.get(last)
            if len(rows):
                mine = series[rows]
                first = np.flatnonzero(np.diff(mine, prepend=-1))
                of = np.cumsum(np.bincount(first, minlength=len(rows))) - 1
                number = {int(s): i for i, s in enumerate(mine[first])}
                given = {c: tuple(v[rows] for v in numbers(b.column(c))) for c in {s.x for s in specs}}
                a, y, seen = (np.empty((len(specs), len(rows))) for _ in range(3))
                with np.errstate(all="ignore"):
                    for j, s in enumerate(specs):
                        own = {number[k]: v[j] for k, v in states.items() if k in number and v[j] is not None}
                        a[j], y[j], seen[j] = _maps(*given[s.x], first, of, s.alpha, own)
                    decays = (a > 0) & (y == 0)
                    a[:, first] = 0.0
                    # maps of 1, 2, 4, ... rows; nothing is composed beyond a series' first row here
                    k, longest = 1, int(np.diff(first, append=len(rows)).max())
                    while k < longest:
                        y[:, k:] += np.where(a[:, k:] != 0, a[:, k:] * y[:, :-k], 0.0)
                        a[:, k:] = a[:, k:] * a[:, :-k]
                        k *= 2
                    y = np.array([_kept_tiny(v, free, first, of) for v, free in zip(y, decays)])
                for j, s in enumerate(specs):
                    out[j][0][rows], out[j][1][rows] = y[j], seen[j] >= max(1, int(s.min_periods))
                if mine[-1] == last:
                    left = [_after(y[j], seen[j], given[s.x][1], first[-1], own) for j, (s, own) in enumerate(zip(specs, left or [None] * len(specs)))]
            yield out
    return run


def _after(y: np.ndarray, seen: np.ndarray, ok: np.ndarray, begin: int, before: tuple | None) -> tuple | None:
    """The state after the last row of a series that begins, in this batch, at ``begin``."""
    if not seen[-1]:
        return None
    held = np.flatnonzero(ok[begin:])
    gap = len(ok) - begin - 1 - held[-1] if len(held) else len(ok) - begin + before[1]
    return float(y[-1]), float(gap), float(seen[-1])


def _carries(df: DataFrame, specs: list[EwmSpec], be: int, symbol: str, ts: str, block_rows: int) -> DataFrame:
    """symbol, ``_blk`` and, per spec in one text, (value, rows since the last observation, observations) before the block.
    (The text of a double is exact, and Spark's writer of Arrow goes through a batch's arrays anew for every row.)"""
    keys = [symbol]
    d = df.withColumn("_eb", F.floor((F.col(RN) - 1) / be).cast("long"))
    wb = Window.partitionBy(symbol, BLK, "_eb").orderBy(ts)
    upto = wb.rowsBetween(Window.unboundedPreceding, 0)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_eb") * be + 1                      # first _rn of the e-block
    dense = [i for i, s in enumerate(specs) if s.dense]
    gen = [i for i, s in enumerate(specs) if not s.dense]

    def g(i):
        # exp(|ln(1-a)| * (rn - start)) <= e^600 inside an e-block
        return F.exp(F.lit(-_ln1m(specs[i].alpha)) * (F.col(RN) - start).cast("double"))

    # --- 1. in-block running sums -------------------------------------------
    # dense inputs (no NULL after the first value): the value assuming a zero carry-in is
    #   a * exp(ln(1-a) * (t - start)) * (G - x_f * g_f) with G = sum(x * g), a plain aggregate below
    # general inputs: running sums of ln A and B * exp(-L) (holes renormalise)
    if gen:
        step1 = []
        for i in gen:
            x = F.col(specs[i].x)
            step1 += [F.count(x).over(upto).alias(f"_lc{i}"), F.last(F.when(x.isNotNull(), F.col(RN)), True).over(before).alias(f"_pv{i}")]
        d = d.select("*", *step1)
        step2 = []
        for i in gen:
            s = specs[i]
            x, a, la = F.col(s.x), float(s.alpha), _ln1m(s.alpha)
            inner = x.isNotNull() & F.col(f"_pv{i}").isNotNull()
            dd = (F.col(RN) - F.col(f"_pv{i}")).cast("double")
            o = F.exp(dd * F.lit(la))
            step2 += [F.when(inner, dd * F.lit(la) - F.log(o + F.lit(a))).otherwise(F.lit(0.0)).alias(f"_ln{i}"),
                      F.when(inner, F.lit(a) * x / (o + F.lit(a))).otherwise(F.lit(0.0)).alias(f"_bt{i}")]
        d = d.select("*", *step2)
        d = d.select("*", *[F.sum(f"_ln{i}").over(upto).alias(f"_cum{i}") for i in gen])
        d = d.select("*", *[F.sum(F.col(f"_bt{i}") * F.exp(-F.col(f"_cum{i}"))).over(upto).alias(f"_acc{i}")
                            for i in gen])
        d = d.select(*[c for c in d.columns if not c.startswith(("_acc", "_bt", "_ln"))],
                     *[(F.exp(F.col(f"_cum{i}")) * F.col(f"_acc{i}")).alias(f"_loc{i}") for i in gen])

    # --- 2. one summary row per e-block, long format (spec, symbol, e-block) --
    def long_rows(frame, idxs, cols_of):
        summ = frame.groupBy(symbol, BLK, "_eb").agg(*[c for i in idxs for c in cols_of(i)])
        return summ.select(
            symbol, BLK, "_eb",
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("spec"), F.col(f"n{i}").alias("n_obs"), F.col(f"f{i}").alias("f_rn"),
                         F.col(f"xf{i}").alias("x_f"), F.col(f"lo{i}").alias("last_obs"),
                         F.col(f"Lend{i}").alias("L_end"), F.col(f"locend{i}").alias("loc_end"))
                for i in idxs])).alias("s"),
        ).select(symbol, BLK, "_eb", "s.*")

    def dense_cols(i):
        s = specs[i]
        x, a, la = F.col(s.x), float(s.alpha), _ln1m(s.alpha)
        nn = F.when(x.isNotNull(), F.col(RN))
        return [F.count(x).alias(f"n{i}"), F.min(nn).alias(f"f{i}"), F.min_by(x, nn).alias(f"xf{i}"),
                F.max(nn).alias(f"lo{i}"), F.sum(x * g(i)).alias(f"_gs{i}"),
                F.min_by(x * g(i), nn).alias(f"_gf{i}")]

    def dense_finish(frame, idxs):
        st = F.col("_eb") * be + 1
        extra = []
        for i in idxs:
            a, la = float(specs[i].alpha), _ln1m(specs[i].alpha)
            extra += [(F.lit(la) * (F.col(f"n{i}") - 1).cast("double")).alias(f"Lend{i}"),
                      (F.lit(a) * F.exp(F.lit(la) * (F.col(f"lo{i}") - st).cast("double"))
                       * (F.col(f"_gs{i}") - F.col(f"_gf{i}"))).alias(f"locend{i}")]
        return frame.select("*", *extra)

    def gen_cols(i):
        x = F.col(specs[i].x)
        first = x.isNotNull() & (F.col(f"_lc{i}") == 1)
        return [F.count(x).alias(f"n{i}"), F.min(F.when(x.isNotNull(), F.col(RN))).alias(f"f{i}"),
                F.max(F.when(first, x)).alias(f"xf{i}"), F.max(F.when(x.isNotNull(), F.col(RN))).alias(f"lo{i}"),
                F.max_by(F.col(f"_cum{i}"), F.col(RN)).alias(f"Lend{i}"),
                F.max_by(F.col(f"_loc{i}"), F.col(RN)).alias(f"locend{i}")]

    parts = []
    if dense:
        # plain aggregate over the input rows: no window recomputation
        base = df.withColumn("_eb", F.floor((F.col(RN) - 1) / be).cast("long"))
        summ = base.groupBy(symbol, BLK, "_eb").agg(*[c for i in dense for c in dense_cols(i)])
        summ = dense_finish(summ, dense)
        parts.append(summ.select(
            symbol, BLK, "_eb",
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("spec"), F.col(f"n{i}").alias("n_obs"), F.col(f"f{i}").alias("f_rn"),
                         F.col(f"xf{i}").alias("x_f"), F.col(f"lo{i}").alias("last_obs"),
                         F.col(f"Lend{i}").alias("L_end"), F.col(f"locend{i}").alias("loc_end"))
                for i in dense])).alias("s")).select(symbol, BLK, "_eb", "s.*"))
    if gen:
        parts.append(long_rows(d, gen, gen_cols))
    longf = parts[0]
    for p_ in parts[1:]:
        longf = longf.unionByName(p_)
    pk = ["spec", *keys]
    # one row per e-block, read by the prefixes, the maps and the scan: the windows under it run once
    longf = persist(longf)
    upto_block = Window.partitionBy(*pk).orderBy(BLK).rowsBetween(Window.unboundedPreceding, 0)
    observed = (longf.groupBy(*pk, BLK).agg(F.sum("n_obs").alias("n"), F.max("last_obs").alias("last"))
                .select(*pk, (F.col(BLK) + 1).alias(BLK), F.sum("n").over(upto_block).alias("n"), F.max("last").over(upto_block).alias("last")))
    longf = _prefix(longf, pk, {"cnt_before": ("n_obs", "sum"), "prev_obs": ("last_obs", "max")})

    alpha = F.element_at(F.array(*[F.lit(float(s.alpha)) for s in specs]), F.col("spec") + 1)
    la = F.element_at(F.array(*[F.lit(_ln1m(s.alpha)) for s in specs]), F.col("spec") + 1)
    has = F.col("n_obs") > 0
    seed = has & F.col("prev_obs").isNull()
    dfn = (F.col("f_rn") - F.col("prev_obs")).cast("double")
    o = F.exp(dfn * la)
    longf = longf.select(
        *pk, BLK, "_eb", "n_obs", "cnt_before", "f_rn", "x_f",
        F.when(seed, F.lit(0.0)).otherwise(o / (o + alpha)).alias("A_f"),
        F.when(seed, F.col("x_f")).otherwise(alpha * F.col("x_f") / (o + alpha)).alias("b_f"),
        "L_end", "loc_end")
    longf = longf.select(
        *pk, BLK, "_eb", "f_rn", "x_f", "A_f", "b_f", F.coalesce("cnt_before", F.lit(0)).cast("long").alias("cb"),
        F.when(has, F.exp("L_end") * F.col("A_f")).otherwise(F.lit(1.0)).alias("A_E"),
        F.when(has, F.exp("L_end") * F.col("b_f") + F.col("loc_end")).otherwise(F.lit(0.0)).alias("B_E"))

    # --- 3. carry-in: the maps composed in order ------------------------------
    blocks = longf.groupBy(*pk, BLK).agg(F.sort_array(F.collect_list(F.struct("_eb", "A_E", "B_E", "A_f"))).alias("_ebs"))
    maps = blocks.select(*pk, BLK, _composite(F.col("_ebs")).alias("_m"))
    starts = maps.groupBy(*pk).agg(F.sort_array(F.collect_list(F.struct(BLK, "_m.*"))).alias("_ms"))
    # one place more than blocks: what reaches the last block of the series
    one = F.struct((F.element_at("_ms", -1)[BLK] + 1).alias(BLK), F.lit(1.0).alias("A_E"), F.lit(0.0).alias("B_E"), F.lit(1.0).alias("A_f"))
    starts = starts.select(*pk, F.concat("_ms", F.array(one)).alias("_ms"))
    starts = starts.select(*pk, F.explode(F.arrays_zip(F.col(f"_ms.{BLK}").alias(BLK), _scan("_ms", F.lit(0.0)).alias("_c0"))).alias("_s"))
    carried = starts.select(*pk, f"_s.{BLK}", "_s._c0").join(observed, [*pk, BLK]).where(F.col("n") > 0)

    # --- 4. one row per (symbol, layout block) ----------
    def of(i, value):
        return F.max(F.when(F.col("spec") == i, value.cast("double")))
    gap = F.col(BLK) * block_rows - F.col("last")
    return carried.groupBy(*keys, BLK).agg(F.concat_ws(",", *[
        F.coalesce(v.cast("string"), F.lit("")) for i in range(len(specs)) for v in (of(i, F.col("_c0")), of(i, gap), of(i, F.col("n")))]).alias("_carry"))
