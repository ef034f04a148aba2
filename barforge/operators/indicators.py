"""Technical indicators and supervised targets over a cleaned bar table.

One window spec (``PARTITION BY symbol, _blk ORDER BY ts``) serves every
lag, lead and bounded rolling frame, so the rolling family costs one hash
exchange and one sort.  Every rolling mean and deviation comes from sliding
moments that all widths of an input share (``barforge.operators.moments``).  The recursive averages (EMA, Wilder RSI/ATR, MACD
signal) go through the blocked scan of ``barforge.operators.ewm``: all
close/gain/loss/true-range averages in one pass, the MACD signal (whose seed
is the first non-NULL MACD) in a second.
"""

from __future__ import annotations

import re

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.config import DEFAULT_HORIZONS, DEFAULT_TASK, DEFAULT_THRESH, Layout, WindowsConfig
from barforge.functions.columns import safe_div
from barforge.functions.intervals import step_micros
from barforge.operators.arrow import AT, Step, add_doubles, numbers
from barforge.operators.ewm import EwmSpec, ewm_carries, ewm_step, join_carries
from barforge.operators.moments import moments_step
from barforge.operators.series import CORE, MORE, RN, SeriesPlan
from barforge.session import persist

RAW_FEATURE_BASE = ["symbol", "ts", "open", "high", "low", "close", "volume", "close_time",
                    "quote_volume", "trades", "taker_buy_base", "taker_buy_quote"]


def feature_names(cfg: WindowsConfig, present: Iterable[str]) -> list[str]:
    """Indicator column names in the reference's order."""
    present = set(present)
    out = ["ret_simple", "ret_log", "hl_spread"]
    for w in cfg.ma:
        out += [f"sma_{w}", f"ema_{w}", f"vol_sma_{w}"]
    out += [f"rsi_{cfg.rsi}", f"macd_{cfg.macd_fast}_{cfg.macd_slow}", f"macd_signal_{cfg.macd_signal}", "macd_hist"]
    p = cfg.bb_period
    out += [f"bb_mid_{p}", f"bb_up_{p}", f"bb_low_{p}", "bb_percent_b", f"atr_{cfg.atr_period}"]
    out += [f"vol_logret_{w}" for w in cfg.vol]
    out.append("dollar_volume")
    if "taker_buy_base" in present and "volume" in present:
        out.append("taker_buy_ratio")
    if "taker_buy_quote" in present and "quote_volume" in present:
        out.append("taker_buy_quote_ratio")
    for w in cfg.vol_feat:
        out += [f"vol_roll_mean_{w}", f"vol_roll_std_{w}", f"trades_roll_mean_{w}",
                f"trades_roll_std_{w}", f"dollar_vol_roll_mean_{w}"]
    return out


def target_names(horizons: Iterable[int], task: str) -> list[str]:
    prefix = {"reg": "target_ret", "multiclass": "target_cls"}.get(task, "target_up")
    return [f"{prefix}_{h}" for h in horizons]


def label(fr: Column, task: str, thresh: float) -> Column:
    """Target of one horizon from the forward log return ``fr``."""
    t = F.lit(float(thresh))
    if task == "reg":
        return fr
    if task == "multiclass":
        # later masks override earlier ones: -1 wins, then 0, then 1
        return (F.when(fr < -t, F.lit(-1)).when((fr >= -t) & (fr <= t), F.lit(0))
                .when(fr > t, F.lit(1)).cast("long"))
    return F.coalesce((fr > t).cast("long"), F.lit(0).cast("long"))


def _window_columns(d: DataFrame, cfg: WindowsConfig, w, horizons, task, thresh, wanted: Iterable[str] | None = None) -> DataFrame:
    """Lags, leads, ratios, and the rolling family from shared sliding moments; ``wanted``: only these of it."""
    cols = set(d.columns)
    return _rolled_columns(_lagged_columns(d, w, horizons, task, thresh), cfg, feature_names(cfg, cols) if wanted is None else wanted)


def _lagged_columns(d: DataFrame, w, horizons, task, thresh) -> DataFrame:
    """Lags, leads, ratios, and the row's place in its block."""
    cols = set(d.columns)
    close, high, low, vol = F.col("close"), F.col("high"), F.col("low"), F.col("volume")
    prev = F.lag(close, 1).over(w)
    exprs: dict[str, Column] = {}
    exprs["ret_simple"] = safe_div(close, prev) - F.lit(1.0)
    exprs["ret_log"] = F.ln(close) - F.lag(F.ln(close), 1).over(w)
    exprs["hl_spread"] = safe_div(high - low, close)
    dollar = F.col("quote_volume") if "quote_volume" in cols else close * vol
    exprs["dollar_volume"] = dollar
    if "taker_buy_base" in cols:
        exprs["taker_buy_ratio"] = safe_div(F.col("taker_buy_base"), vol)
    if "taker_buy_quote" in cols and "quote_volume" in cols:
        exprs["taker_buy_quote_ratio"] = safe_div(F.col("taker_buy_quote"), F.col("quote_volume"))
    if horizons is not None:
        for h in horizons:
            fr = F.ln(F.lead(close, h).over(w)) - F.ln(close)
            exprs[target_names([h], task)[0]] = label(fr, task, thresh)
        max_h = max(horizons) if len(horizons) else 0
        exprs["_tail_ok"] = F.lead(F.lit(1), max_h).over(w).isNotNull() if max_h > 0 else F.lit(True)
    exprs[AT] = F.row_number().over(w)
    return d.select("*", *[e.alias(n) for n, e in exprs.items()])


def _rolled_columns(d: DataFrame, cfg: WindowsConfig, wanted: Iterable[str], before: Sequence[Step] = (), drop: Iterable[str] = ()) -> DataFrame:
    """The rolling family of ``_lagged_columns``, as far as ``wanted``, after the steps ``before``; without the columns in ``drop``."""
    cols, names = set(d.columns), set(wanted)
    bands = {f"bb_mid_{cfg.bb_period}", f"bb_up_{cfg.bb_period}", f"bb_low_{cfg.bb_period}", "bb_percent_b"} & names
    rolled = {  # feature -> (input, width, what of it)
        **{f"sma_{k}": ("close", k, "mean") for k in cfg.ma}, **{f"vol_sma_{k}": ("volume", k, "mean") for k in cfg.ma},
        **{f"vol_logret_{k}": ("ret_log", k, "std") for k in cfg.vol}, **{f"vol_roll_mean_{k}": ("volume", k, "mean") for k in cfg.vol_feat},
        **{f"vol_roll_std_{k}": ("volume", k, "std") for k in cfg.vol_feat}, **{f"dollar_vol_roll_mean_{k}": ("dollar_volume", k, "mean") for k in cfg.vol_feat}}
    if "trades" in cols:
        rolled |= {f"trades_roll_{x}_{k}": ("trades", k, x) for k in cfg.vol_feat for x in ("mean", "std")}
    rolled = {n: v for n, v in rolled.items() if n in names}
    if bands:
        rolled |= {"_bbm": ("close", cfg.bb_period, "mean"), "_bbs": ("close", cfg.bb_period, "std")}
    widths: dict[str, set[int]] = {}
    for c, k, _ in rolled.values():
        widths.setdefault(c, set()).add(k)
    steps = list(before)
    if widths:
        steps.append(moments_step(widths, {c for c, _, x in rolled.values() if x == "std"}))
    if steps:
        d = add_doubles(d, steps, drop)
    out = [F.col(f"_{x}{k}_{c}").alias(n) for n, (c, k, x) in rolled.items()]
    if "trades" not in cols:
        out += [F.lit(None).cast("double").alias(n) for k in cfg.vol_feat for n in (f"trades_roll_mean_{k}", f"trades_roll_std_{k}") if n in names]
    return d.select(*[c for c in d.columns if not c.startswith(("_mean", "_std"))], *out)


def _difference(x: str, y: str):
    """Step of ``add_doubles``: x - y."""
    def run(batches):
        for b, _ in batches:
            (left, held), (right, also) = numbers(b.column(x)), numbers(b.column(y))
            yield [(left - right, held & also)]
    return run


def add_all_features(bars: DataFrame, cfg: WindowsConfig | None = None, interval: str = "5m",
                     horizons: Iterable[int] | None = DEFAULT_HORIZONS, task: str = DEFAULT_TASK,
                     thresh: float = DEFAULT_THRESH, trim_warmup: bool = True,
                     layout: Layout | None = None,
                     dedup_order=None, keep: Column | None = None,
                     columns: Iterable[str] | None = None, close_known: bool = False,
                     longest: int | None = None) -> DataFrame:
    """Features (and, unless ``horizons`` is None, targets) of a cleaned bar
    table keyed ``(symbol, ts)``.

    ``close_known``: the caller's promise that no row (after ``keep``) lacks
    ``close``, as ``keep_valid()`` ensures; the recursive averages then need
    no hole handling.

    ``columns``: only these indicator columns (default: all).  Unused
    rolling frames are pruned by the optimizer; the recursive averages are
    only scanned when a requested column needs them.

    ``longest``: a number of rows that no symbol exceeds, if the caller knows one.
    Within a block's it means one exchange, and nothing kept or carried over.

    Output columns: base columns present in the input, indicators in the
    reference's order, then targets.  The first ``cfg.warmup_rows()`` rows
    of every symbol are dropped when ``trim_warmup``; with targets the last
    ``max(horizons)`` rows of every symbol are dropped too.
    """
    cfg = cfg or WindowsConfig()
    layout = layout or Layout()
    horizons = tuple(horizons) if horizons is not None else None
    present = bars.columns
    base = [c for c in RAW_FEATURE_BASE if c in present]
    feats = feature_names(cfg, present)
    if columns is not None:
        wanted = set(columns)
        unknown = wanted - set(feats)
        if unknown:
            raise ValueError(f"unknown feature columns: {sorted(unknown)}")
        feats = [c for c in feats if c in wanted]
    tgts = target_names(horizons, task) if horizons is not None else []
    macd_name = f"macd_{cfg.macd_fast}_{cfg.macd_slow}"
    need_signal = bool({f"macd_signal_{cfg.macd_signal}", "macd_hist"} & set(feats))
    need_macd = need_signal or macd_name in feats
    need_rsi = f"rsi_{cfg.rsi}" in feats
    need_atr = f"atr_{cfg.atr_period}" in feats
    ema_spans = {w_ for w_ in cfg.ma if f"ema_{w_}" in feats}
    if need_macd:
        ema_spans |= {cfg.macd_fast, cfg.macd_slow}
    back = cfg.lookback_rows()
    ahead = max(horizons) if horizons else 0
    plan = SeriesPlan(bars, back=back, ahead=ahead, step_us=step_micros(interval), layout=layout,
                      dedup_order=dedup_order, keep=keep, longest=longest)
    spans = sorted(ema_spans)
    warm = cfg.warmup_rows()

    def add(d: DataFrame) -> DataFrame:
        w = plan.window
        close, high, low = F.col("close"), F.col("high"), F.col("low")
        d = d.select("*", F.lag(close, 1).over(w).alias("_prev"))
        if plan.whole:  # all lags and leads are one window pass
            d = _lagged_columns(d, w, horizons, task, thresh)
        delta = close - F.col("_prev")
        d = d.select("*",
                     F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0))).alias("_gain"),
                     F.when(delta.isNotNull(), -F.least(delta, F.lit(0.0))).alias("_loss"),
                     F.greatest(high - low, F.abs(high - F.col("_prev")), F.abs(low - F.col("_prev"))).alias("_tr"))
        dn = close_known
        specs = [EwmSpec.span(f"_ema{s}", "close", s, dense=dn) for s in spans]
        if need_rsi:
            specs += [EwmSpec.wilder("_ag", "_gain", cfg.rsi, dense=dn),
                      EwmSpec.wilder("_al", "_loss", cfg.rsi, dense=dn)]
        if need_atr:
            specs.append(EwmSpec.wilder(f"atr_{cfg.atr_period}", "_tr", cfg.atr_period))
        macd = macd_name
        sig = f"macd_signal_{cfg.macd_signal}"
        sizes = {"block_rows": layout.block_rows, "cap": layout.ewm_block}
        if specs and not plan.whole:
            # narrow frame (raw columns + EWM inputs), read again where a series goes on after its block;
            # with the FLT-2 filter in the pass, close has no NULL: close, its
            # changes and MACD are NULL-free after their first value (dense);
            # the true range may have holes (NULL high and low)
            d = persist(d)
            carries = ewm_carries(d, specs, **sizes)

        # lags, leads and the rows' places in one window pass over the same partitions; the
        # recursive and rolling means follow in that order
        steps = []
        if not plan.whole:
            d = _lagged_columns(d, w, horizons, task, thresh)
            more = d.filter(F.col(MORE))
        if specs:
            if not plan.whole:
                d, more = (join_carries(x, specs, carries, cap=layout.ewm_block) for x in (d, more))
            steps.append(ewm_step(specs, layout.ewm_block))
        if need_macd:
            steps.append(([macd], _difference(f"_ema{cfg.macd_fast}", f"_ema{cfg.macd_slow}")))
        if need_signal:
            signal = [EwmSpec.span(sig, macd, cfg.macd_signal, dense=dn)]
            if not plan.whole:
                d = join_carries(d, signal, ewm_carries(add_doubles(more, steps), signal, **sizes), cap=layout.ewm_block)
            steps.append(ewm_step(signal, layout.ewm_block))
        inputs = {"_gain", "_loss", "_tr", "_prev", MORE, *([] if plan.whole else [AT]), *(c for c in d.columns if c.startswith("_carry_")),
                  *(f"_ema{s}" for s in spans if s not in cfg.ma)}
        d = _rolled_columns(d, cfg, feats, steps, drop=inputs)
        extra = {}
        if "_bbm" in d.columns:
            p, k = cfg.bb_period, F.lit(float(cfg.bb_std))
            up = F.col("_bbm") + k * F.col("_bbs")
            lo = F.col("_bbm") - k * F.col("_bbs")
            extra = {f"bb_mid_{p}": F.col("_bbm"), f"bb_up_{p}": up, f"bb_low_{p}": lo,
                     "bb_percent_b": safe_div(F.col("close") - lo, up - lo)}
        if need_rsi:
            rs = safe_div(F.col("_ag"), F.nullif(F.col("_al"), F.lit(0.0)))
            extra[f"rsi_{cfg.rsi}"] = F.lit(100.0) - safe_div(F.lit(100.0), F.lit(1.0) + rs)
        if need_signal:
            extra["macd_hist"] = F.col(macd) - F.col(sig)
        extra |= {f"ema_{w_}": F.col(f"_ema{w_}") for w_ in cfg.ma if w_ in ema_spans}
        d = d.select("*", *[e.alias(n) for n, e in extra.items()])
        cond = F.lit(True) if plan.whole else F.col(CORE)
        if trim_warmup and warm > 0:
            cond = cond & (F.col(AT if plan.whole else RN) > warm)
        if horizons is not None:
            cond = cond & F.col("_tail_ok")
        return d.filter(cond).select(*base, *feats, *tgts, *([] if plan.whole else [CORE]))

    return plan.map(add)


def _only(bars: DataFrame, columns: list[str], options: dict, **windows) -> DataFrame:
    """The base columns and some indicators, no row trimmed."""
    return add_all_features(bars, WindowsConfig(**windows), horizons=None, trim_warmup=False, columns=columns, **options)


def add_moving_averages(bars: DataFrame, windows: Iterable[int] = WindowsConfig.ma, **options) -> DataFrame:
    """sma_<n> and ema_<n> of the close; ``options`` as of ``add_all_features``."""
    ns = tuple(windows)
    return _only(bars, [f"{kind}_{n}" for n in ns for kind in ("sma", "ema")], options, ma=ns)


def add_rsi(bars: DataFrame, period: int = WindowsConfig.rsi, **options) -> DataFrame:
    return _only(bars, [f"rsi_{period}"], options, rsi=period)


def add_macd(bars: DataFrame, fast: int = WindowsConfig.macd_fast, slow: int = WindowsConfig.macd_slow,
             signal: int = WindowsConfig.macd_signal, **options) -> DataFrame:
    return _only(bars, [f"macd_{fast}_{slow}", f"macd_signal_{signal}", "macd_hist"], options,
                 macd_fast=fast, macd_slow=slow, macd_signal=signal)


def add_bbands(bars: DataFrame, period: int = WindowsConfig.bb_period, width: float = WindowsConfig.bb_std, **options) -> DataFrame:
    return _only(bars, [f"bb_{kind}_{period}" for kind in ("mid", "up", "low")] + ["bb_percent_b"], options, bb_period=period, bb_std=width)


def add_atr(bars: DataFrame, period: int = WindowsConfig.atr_period, **options) -> DataFrame:
    return _only(bars, [f"atr_{period}"], options, atr_period=period)


def add_roll_volatility(bars: DataFrame, windows: Iterable[int] = WindowsConfig.vol, **options) -> DataFrame:
    ns = tuple(windows)
    return _only(bars, [f"vol_logret_{n}" for n in ns], options, vol=ns)


def add_volume_features(bars: DataFrame, windows: Iterable[int] = WindowsConfig.vol_feat, **options) -> DataFrame:
    """Dollar volume, taker ratios, and rolling statistics of volume and trades."""
    cfg = WindowsConfig(vol_feat=tuple(windows))
    own = re.compile(r"dollar_volume|taker_buy_.*|(vol|trades|dollar_vol)_roll_.*")
    return _only(bars, [c for c in feature_names(cfg, bars.columns) if own.fullmatch(c)], options, vol_feat=cfg.vol_feat)


def make_targets(df: DataFrame, horizons: Iterable[int] = DEFAULT_HORIZONS, task: str = DEFAULT_TASK,
                 thresh: float = DEFAULT_THRESH, layout: Layout | None = None) -> DataFrame:
    """Forward-return targets per horizon, then drop the last
    ``max(horizons)`` rows of every symbol (one ``lead`` window pass)."""
    horizons = tuple(horizons)
    max_h = max(horizons) if horizons else 0
    plan = SeriesPlan(df, ahead=max_h, layout=layout or Layout())
    names = target_names(horizons, task)

    def fn(d: DataFrame) -> DataFrame:
        close = F.col("close")
        cols = [label(F.ln(F.lead(close, h).over(plan.window)) - F.ln(close), task, thresh).alias(n)
                for h, n in zip(horizons, names)]
        tail = F.lead(F.lit(1), max_h).over(plan.window).isNotNull() if max_h > 0 else F.lit(True)
        d = d.select("*", *cols, tail.alias("_tail_ok"))
        return d.filter(F.col("_tail_ok")).drop("_tail_ok")

    return plan.map(fn)


def future_return(df: DataFrame, horizon: int, name: str | None = None, layout: Layout | None = None) -> DataFrame:
    """``ln(close[t+h]) - ln(close[t])`` per symbol (no trimming)."""
    plan = SeriesPlan(df, ahead=horizon, layout=layout or Layout())
    nm = name or f"future_ret_{horizon}"
    return plan.map(lambda d: d.select(
        "*", (F.ln(F.lead("close", horizon).over(plan.window)) - F.ln("close")).alias(nm)))
