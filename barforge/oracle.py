"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: plain window functions for
lags/leads/rolling frames (guarded by the non-NULL count, as
``rolling(min_periods=k)``), and the exponentially weighted means as a
sequential ``list_reduce`` over the ordered history (NULL-aware state
``(y, old_weight)``).  Doubles are rounded with the same table as the Spark
side (``barforge.rounding``).
"""

from __future__ import annotations

from barforge.config import WindowsConfig
from barforge.operators.indicators import feature_names, target_names
from barforge.rounding import digits, rnd_sql
from barforge.sources.fixtures import DAILY_BARS_SQL, HOURLY_BARS_SQL, RISING_BARS_SQL, SUPPLIER_BARS_SQL

CFG = WindowsConfig()
RAW12 = ["symbol", "ts", "open", "high", "low", "close", "volume", "close_time", "quote_volume",
         "trades", "taker_buy_base", "taker_buy_quote"]
INT_COLS = {"trades"}


def r(c: str, scaled: bool = False) -> str:
    return f"{rnd_sql(c, digits(c, scaled))} AS {c}"


def rcols(cols, doubles, scaled=()) -> str:
    return ", ".join(r(c, c in scaled) if c in doubles else c for c in cols)


# --------------------------------------------------------------- building ---
def clean_sql(src: str) -> str:
    """Bars (already typed) -> cleaned, with the envelope repair."""
    return f"""
SELECT symbol, ts, open,
       CASE WHEN high IS NULL THEN NULL ELSE greatest(high, open, close, low) END AS high,
       CASE WHEN low IS NULL THEN NULL ELSE least(low, open, close,
            CASE WHEN high IS NULL THEN NULL ELSE greatest(high, open, close, low) END) END AS low,
       close, volume, close_time, quote_volume, trades, taker_buy_base, taker_buy_quote
FROM (SELECT * EXCLUDE (open_time), open_time AS ts FROM ({src}))
"""


def roll(fn: str, x: str, k: int) -> str:
    fr = f"(PARTITION BY symbol ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    if fn == "avg":
        # oldest-first sum, the order of a sliding frame, then / k
        w = "(PARTITION BY symbol ORDER BY ts)"
        terms = [f"lag({x}, {j}) OVER {w}" for j in range(k - 1, 0, -1)] + [x]
        total = terms[0]
        for t in terms[1:]:
            total = f"({total} + {t})"
        return f"CASE WHEN count({x}) OVER {fr} = {k} THEN {total} / {float(k)!r} END"
    return f"CASE WHEN count({x}) OVER {fr} = {k} THEN {fn}({x}) OVER {fr} END"


def ewm(x: str, alpha: float, mp: int) -> str:
    a = repr(float(alpha))
    q = repr(1.0 - float(alpha))
    st = "{'y': NULL::DOUBLE, 'ow': 1.0::DOUBLE}"
    upd = (f"CASE WHEN v IS NULL THEN (CASE WHEN acc.y IS NULL THEN acc "
           f"ELSE {{'y': acc.y, 'ow': acc.ow * {q}::DOUBLE}} END) "
           f"ELSE (CASE WHEN acc.y IS NULL THEN {{'y': v::DOUBLE, 'ow': 1.0::DOUBLE}} "
           f"ELSE {{'y': (acc.ow * {q}::DOUBLE * acc.y + {a}::DOUBLE * v) / (acc.ow * {q}::DOUBLE + {a}::DOUBLE), "
           f"'ow': 1.0::DOUBLE}} END) END")
    wu = "(PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    mp = max(1, int(mp))
    return (f"CASE WHEN count({x}) OVER {wu} >= {mp} THEN "
            f"list_reduce(list({x}) OVER {wu}, lambda acc, v: {upd}, {st}).y END")


def ln(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


def features_sql(bars_src: str, horizons=(1, 5, 15), task="binclass", thresh=0.0, trim=True) -> str:
    """Full feature (+ target) table of the given bars, reference order."""
    cfg = CFG
    w = "(PARTITION BY symbol ORDER BY ts)"
    l1 = [
        "*",
        f"row_number() OVER {w} AS rn",
        f"CASE WHEN lag(close) OVER {w} = 0 THEN NULL ELSE close / lag(close) OVER {w} - 1 END AS ret_simple",
        f"{ln('close')} - lag({ln('close')}) OVER {w} AS ret_log",
        "CASE WHEN close = 0 THEN NULL ELSE (high - low) / close END AS hl_spread",
        f"close - lag(close) OVER {w} AS delta",
        f"greatest(high - low, abs(high - lag(close) OVER {w}), abs(low - lag(close) OVER {w})) AS tr",
        "quote_volume AS dollar_volume",
        "CASE WHEN volume = 0 THEN NULL ELSE taker_buy_base / volume END AS taker_buy_ratio",
        "CASE WHEN quote_volume = 0 THEN NULL ELSE taker_buy_quote / quote_volume END AS taker_buy_quote_ratio",
    ]
    for m in cfg.ma:
        l1 += [f"{roll('avg', 'close', m)} AS sma_{m}", f"{ewm('close', 2 / (m + 1), m)} AS ema_{m}",
               f"{roll('avg', 'volume', m)} AS vol_sma_{m}"]
    for s in (cfg.macd_fast, cfg.macd_slow):
        l1.append(f"{ewm('close', 2 / (s + 1), s)} AS _ema{s}")
    p = cfg.bb_period
    l1 += [f"{roll('avg', 'close', p)} AS bb_mid_{p}", f"{roll('stddev_pop', 'close', p)} AS _bbs"]
    for v in cfg.vol_feat:
        l1 += [f"{roll('avg', 'volume', v)} AS vol_roll_mean_{v}", f"{roll('stddev_pop', 'volume', v)} AS vol_roll_std_{v}",
               f"{roll('avg', 'trades', v)} AS trades_roll_mean_{v}", f"{roll('stddev_pop', 'trades', v)} AS trades_roll_std_{v}",
               f"{roll('avg', 'quote_volume', v)} AS dollar_vol_roll_mean_{v}"]
    tg = target_names(horizons, task) if horizons is not None else []
    if horizons is not None:
        for h, name in zip(horizons, tg):
            fr = f"({ln(f'lead(close, {h}) OVER {w}')} - {ln('close')})"
            t = repr(float(thresh))
            if task == "reg":
                l1.append(f"{fr} AS {name}")
            elif task == "multiclass":
                l1.append(f"(CASE WHEN {fr} < -{t} THEN -1 WHEN {fr} >= -{t} AND {fr} <= {t} THEN 0 "
                          f"WHEN {fr} > {t} THEN 1 END)::BIGINT AS {name}")
            else:
                l1.append(f"coalesce(({fr} > {t})::BIGINT, 0) AS {name}")
        mh = max(horizons) if horizons else 0
        l1.append(f"lead(1, {mh}) OVER {w} IS NOT NULL AS tail_ok" if mh > 0 else "TRUE AS tail_ok")
    l2 = [
        "*",
        f"CASE WHEN delta IS NULL THEN NULL ELSE greatest(delta, 0.0) END AS gain",
        f"CASE WHEN delta IS NULL THEN NULL ELSE -least(delta, 0.0) END AS loss",
        f"_ema{cfg.macd_fast} - _ema{cfg.macd_slow} AS macd_{cfg.macd_fast}_{cfg.macd_slow}",
    ] + [f"{roll('stddev_pop', 'ret_log', v)} AS vol_logret_{v}" for v in cfg.vol]
    l3 = [
        "*",
        f"{ewm('gain', 1 / cfg.rsi, cfg.rsi)} AS _ag",
        f"{ewm('loss', 1 / cfg.rsi, cfg.rsi)} AS _al",
        f"{ewm('tr', 1 / cfg.atr_period, cfg.atr_period)} AS atr_{cfg.atr_period}",
        f"{ewm(f'macd_{cfg.macd_fast}_{cfg.macd_slow}', 2 / (cfg.macd_signal + 1), cfg.macd_signal)} AS macd_signal_{cfg.macd_signal}",
    ]
    macd, sig = f"macd_{cfg.macd_fast}_{cfg.macd_slow}", f"macd_signal_{cfg.macd_signal}"
    k = repr(float(cfg.bb_std))
    l4 = [
        "*",
        f"100.0 - 100.0 / (1.0 + CASE WHEN _al = 0 THEN NULL ELSE _ag / _al END) AS rsi_{cfg.rsi}",
        f"{macd} - {sig} AS macd_hist",
        f"bb_mid_{p} + {k} * _bbs AS bb_up_{p}",
        f"bb_mid_{p} - {k} * _bbs AS bb_low_{p}",
        f"CASE WHEN (bb_mid_{p} + {k} * _bbs) - (bb_mid_{p} - {k} * _bbs) = 0 THEN NULL ELSE "
        f"(close - (bb_mid_{p} - {k} * _bbs)) / ((bb_mid_{p} + {k} * _bbs) - (bb_mid_{p} - {k} * _bbs)) END AS bb_percent_b",
    ]
    warm = cfg.warmup_rows() if trim else 0
    cond = [f"rn > {warm}"]
    if horizons is not None:
        cond.append("tail_ok")
    cols = RAW12 + feature_names(cfg, RAW12) + tg
    return f"""
WITH b AS ({clean_sql(bars_src)}),
f1 AS (SELECT {', '.join(l1)} FROM b),
f2 AS (SELECT {', '.join(l2)} FROM f1),
f3 AS (SELECT {', '.join(l3)} FROM f2),
f4 AS (SELECT {', '.join(l4)} FROM f3)
SELECT {', '.join(cols)} FROM f4 WHERE {' AND '.join(cond)}
"""


DOUBLE_RAW = {"open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base", "taker_buy_quote"}


def feature_doubles() -> set[str]:
    return DOUBLE_RAW | set(feature_names(CFG, RAW12)) | {"target_ret_1", "target_ret_5", "target_ret_15"}


def select_rounded(inner: str, cols: list[str], scaled=()) -> str:
    return f"SELECT {rcols(cols, feature_doubles() | set(scaled), scaled)} FROM ({inner})"


SB = SUPPLIER_BARS_SQL
HB = HOURLY_BARS_SQL


def feat_cols_sql(cols, trim=False) -> str:
    return select_rounded(features_sql(SB, horizons=None, trim=trim), ["symbol", "ts", *cols])


# ----------------------------------------------------------------- dirty ---
DIRTY = f"""
WITH hb AS ({HB})
SELECT symbol, CASE WHEN trades = 4 THEN 'n/a' ELSE strftime(open_time, '%Y-%m-%d %H:%M:%S') END AS open_time,
       open::VARCHAR AS open, high::VARCHAR AS high, low::VARCHAR AS low,
       CASE WHEN trades = 2 THEN 'bad' ELSE close::VARCHAR END AS close,
       CASE WHEN trades = 1 THEN 'n/a' ELSE volume::VARCHAR END AS volume,
       strftime(close_time, '%Y-%m-%d %H:%M:%S.%g') AS close_time, quote_volume::VARCHAR AS quote_volume,
       trades::VARCHAR AS trades, taker_buy_base::VARCHAR AS taker_buy_base, taker_buy_quote::VARCHAR AS taker_buy_quote
FROM hb
UNION ALL
SELECT symbol, strftime(open_time, '%Y-%m-%d %H:%M:%S'), open::VARCHAR, low::VARCHAR, high::VARCHAR, close::VARCHAR,
       volume::VARCHAR, strftime(close_time + INTERVAL 1 MILLISECOND, '%Y-%m-%d %H:%M:%S.%g'), quote_volume::VARCHAR,
       trades::VARCHAR, taker_buy_base::VARCHAR, taker_buy_quote::VARCHAR
FROM hb WHERE trades >= 3
"""

ROWS_SQL = f"""
SELECT symbol, TRY_CAST(open_time AS TIMESTAMP) AS ts, TRY_CAST(open AS DOUBLE) AS open,
       TRY_CAST(high AS DOUBLE) AS high0, TRY_CAST(low AS DOUBLE) AS low0, TRY_CAST(close AS DOUBLE) AS close,
       TRY_CAST(volume AS DOUBLE) AS volume, TRY_CAST(close_time AS TIMESTAMP) AS close_time,
       TRY_CAST(quote_volume AS DOUBLE) AS quote_volume, TRY_CAST(trades AS BIGINT) AS trades,
       TRY_CAST(taker_buy_base AS DOUBLE) AS taker_buy_base, TRY_CAST(taker_buy_quote AS DOUBLE) AS taker_buy_quote
FROM ({DIRTY})
"""

PREP_SQL = f"""
SELECT symbol, ts, open,
       CASE WHEN high0 IS NULL THEN NULL ELSE greatest(high0, open, close, low0) END AS high,
       CASE WHEN low0 IS NULL THEN NULL ELSE least(low0, open, close,
            CASE WHEN high0 IS NULL THEN NULL ELSE greatest(high0, open, close, low0) END) END AS low,
       close, volume, close_time, quote_volume, trades, taker_buy_base, taker_buy_quote
FROM ({ROWS_SQL})
"""

DEDUP_ORDER = ("close_time DESC NULLS LAST, trades DESC NULLS LAST, open DESC NULLS LAST, high DESC NULLS LAST, "
               "low DESC NULLS LAST, close DESC NULLS LAST, volume DESC NULLS LAST, quote_volume DESC NULLS LAST, "
               "taker_buy_base DESC NULLS LAST, taker_buy_quote DESC NULLS LAST")

CLEAN_DIRTY = f"""
SELECT * FROM ({PREP_SQL})
QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY {DEDUP_ORDER}) = 1
"""


# ------------------------------------------------------------------ gaps ---
def gap_points(step_us: int) -> str:
    return f"""
WITH b AS (SELECT DISTINCT symbol, ts FROM (
              SELECT symbol, open_time AS ts FROM ({HB})
              UNION ALL SELECT event_type, date_trunc('minute', max(ts)) FROM events GROUP BY event_type)),
a AS (SELECT symbol, min(ts) AS t0, max(ts) AS t1 FROM b GROUP BY symbol),
g AS (SELECT DISTINCT b.symbol, a.t0, (epoch_us(b.ts) - epoch_us(a.t0)) // {step_us} AS g
      FROM b JOIN a USING (symbol) WHERE (epoch_us(b.ts) - epoch_us(a.t0)) % {step_us} = 0),
s AS (SELECT symbol, t0, (epoch_us(t1) - epoch_us(t0)) // {step_us} + 1 AS g FROM a)
"""


def gap_ranges_sql(max_allow: int = 0, step_us: int = 3_600_000_000) -> str:
    return gap_points(step_us) + f"""
, l AS (SELECT symbol, t0, g, lag(g) OVER (PARTITION BY symbol ORDER BY g) AS pg
        FROM (SELECT * FROM g UNION ALL SELECT * FROM s))
SELECT symbol, t0 + to_microseconds((pg + 1) * {step_us}) AS gap_start,
       t0 + to_microseconds((g - 1) * {step_us}) AS gap_end, (g - pg - 1)::BIGINT AS missing_count
FROM l WHERE pg IS NOT NULL AND g - pg - 1 > {max_allow} AND g - pg - 1 > 0
"""


GRID_SQL = gap_points(3_600_000_000) + """
, grid AS (SELECT a.symbol, a.t0, unnest(range(0, (epoch_us(a.t1) - epoch_us(a.t0)) // 3600000000 + 1)) AS g FROM a)
SELECT symbol, t0 + to_microseconds(g * 3600000000) AS ts
FROM grid ANTI JOIN g USING (symbol, g)
"""

GAPS_BY_CANDLE = f"""
SELECT symbol, strftime(open_time, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS gap_before,
       greatest((epoch_ms(open_time) - epoch_ms(prev)) // 3600000 - 1, 0)::BIGINT AS missing_candles
FROM (SELECT symbol, open_time, lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time) AS prev FROM ({HB}))
WHERE prev IS NOT NULL AND epoch_us(open_time) - epoch_us(prev) <> 3600000000
"""


# -------------------------------------------------------------- dataset ----
def ml_features() -> list[str]:
    cols = RAW12 + feature_names(CFG, RAW12)
    return [c for c in cols if c not in ("symbol", "ts", "close_time")]


def ml_sql(bars_src: str) -> str:
    feats = ml_features()
    cond = " AND ".join(f"{c} IS NOT NULL" for c in feats + ["target_up_1"])
    return f"SELECT symbol, ts, {', '.join(feats)}, target_up_1 FROM ({features_sql(bars_src)}) WHERE {cond}"


def split_sql(bars_src: str) -> str:
    a, b = 0.7, 0.7 + 0.15
    return f"""
SELECT *, CASE WHEN pos < floor(n * {a!r}) THEN 'train' WHEN pos < floor(n * {b!r}) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY ts, symbol) - 1 AS pos, count(*) OVER () AS n FROM ({ml_sql(bars_src)}))
"""


RANDOM_SPLIT_SQL = """
SELECT symbol, ts, CASE WHEN pos < te THEN 'test' WHEN pos < te + ceil(0.15 / (0.7 + 0.15) * (n - te)) THEN 'valid' ELSE 'train' END AS split
FROM (SELECT *, ceil((1.0::DOUBLE - 0.7::DOUBLE - 0.15::DOUBLE) * n) AS te FROM (
  SELECT symbol, ts, count(*) OVER () AS n, row_number() OVER (
    ORDER BY ('0x' || substr(md5(symbol || '|' || epoch_us(ts) || '|42'), 1, 15))::BIGINT, ts, symbol) - 1 AS pos FROM ({src})))
"""

DAILY_GAPS_SQL = """
SELECT symbol, pt + INTERVAL 1 DAY AS gap_start, ts - INTERVAL 1 DAY AS gap_end, (date_diff('day', pt, ts) - 1)::BIGINT AS missing_count
FROM (SELECT symbol, open_time AS ts, lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time) AS pt FROM ({src}))
WHERE date_diff('day', pt, ts) - 1 > 2
"""


def scaler_params_sql(bars_src: str) -> str:
    feats = ml_features()
    parts = []
    for c in feats:
        m, v = f"avg({c}::DOUBLE)", f"var_pop({c}::DOUBLE)"
        scale = (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} <= count(*) * 2.220446049250313e-16 * {v} + "
                 f"pow(count(*) * {m} * 2.220446049250313e-16, 2) THEN 1.0 ELSE sqrt({v}) END")
        parts.append(f"SELECT '{c}' AS feature, {m} AS mean, {scale} AS scale FROM sp WHERE split = 'train'")
    return f"WITH sp AS ({split_sql(bars_src)}) " + " UNION ALL ".join(parts)


def scaled_sql(bars_src: str) -> str:
    feats = ml_features()
    params = ", ".join(
        f"avg({c}::DOUBLE) FILTER (WHERE split = 'train') AS m_{c}, var_pop({c}::DOUBLE) FILTER (WHERE split = 'train') AS v_{c}"
        for c in feats) + ", count(*) FILTER (WHERE split = 'train') AS n_train"
    cols = []
    for c in feats:
        scale = (f"CASE WHEN v_{c} <= n_train * 2.220446049250313e-16 * v_{c} + pow(n_train * m_{c} * 2.220446049250313e-16, 2) "
                 f"THEN 1.0 ELSE sqrt(v_{c}) END")
        cols.append(f"{rnd_sql(f'((sp.{c} - m_{c}) / ({scale}))', 6)} AS {c}")
    return f"""
WITH sp AS ({split_sql(bars_src)}), p AS (SELECT {params} FROM sp)
SELECT sp.symbol, sp.ts, {', '.join(cols)}, sp.target_up_1, sp.split FROM sp, p
"""


def union_sql() -> str:
    common = sorted(["symbol", "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume",
                     "trades", "taker_buy_base", "taker_buy_quote"])
    doubles = DOUBLE_RAW
    sel = ", ".join(r(c) if c in doubles else c for c in common)
    return f"SELECT {sel} FROM (SELECT * FROM ({SB}) UNION ALL SELECT * FROM ({HB}))"


def raw_bars_sql() -> str:
    sel = ", ".join(r(c) if c in DOUBLE_RAW else c for c in
                    ["symbol", "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume",
                     "trades", "taker_buy_base", "taker_buy_quote"])
    return f"SELECT {sel} FROM ({SB})"


CORRECTED_SQL = """SELECT * REPLACE (
  CASE WHEN open_time >= '1997-01-01' AND open_time < '1998-01-01' THEN close / 4.0 WHEN open_time >= '1996-01-01' AND open_time < '1997-01-01' THEN close / 2.0 ELSE close END AS close,
  CASE WHEN open_time >= '1996-01-01' AND open_time < '1998-01-01' OR {late} THEN 0 ELSE trades END AS trades) FROM ({src})"""


OVERLAP_SQL = """SELECT * REPLACE (
  CASE WHEN open_time >= '1996-01-01' AND open_time < '1998-01-01' THEN close / 2.0 ELSE close END AS close,
  CASE WHEN open_time >= '1996-01-01' AND open_time < '1998-01-01' THEN 0 ELSE trades END AS trades) FROM ({src})"""


def oracle_queries() -> dict[str, str]:
    fd = feature_doubles()
    feats_all = RAW12 + feature_names(CFG, RAW12) + target_names((1, 5, 15), "binclass")
    ml_cols = ["symbol", "ts", *ml_features(), "target_up_1"]
    q = {
        "clean_dedup": f"SELECT {rcols(RAW12, DOUBLE_RAW)} FROM ({CLEAN_DIRTY}) WHERE ts IS NOT NULL AND close IS NOT NULL",
        "numeric_coerce": f"""SELECT symbol, count(*) AS rows, count(ts) AS ts_ok, count(close) AS close_ok,
                count(volume) AS volume_ok, count(trades) AS trades_ok FROM ({PREP_SQL}) GROUP BY symbol""",
        "ohlc_envelope": f"""SELECT symbol, count(*) AS rows, {rnd_sql("sum(high - low)", 6)} AS sum_range,
                count(*) FILTER (WHERE high < low) AS inverted FROM ({PREP_SQL})
                WHERE ts IS NOT NULL AND close IS NOT NULL GROUP BY symbol""",
        "time_range_scan": f"""SELECT * FROM ({raw_bars_sql()}) WHERE open_time >= TIMESTAMP '1996-01-01 00:00:00'
                AND open_time < TIMESTAMP '1997-01-01 00:00:00'""",
        "symbol_manifest": f"""SELECT symbol, min(open_time) AS first_open, max(open_time) AS last_open, count(*) AS rows,
                symbol || '_1d_' || strftime(min(open_time), '%Y%m%d') || '_' || strftime(max(open_time), '%Y%m%d') AS file_stem
                FROM ({SB}) GROUP BY symbol""",
        "distinct_symbols": f"SELECT DISTINCT symbol FROM ({SB})",
        "returns_spread": feat_cols_sql(["ret_simple", "ret_log", "hl_spread"]),
        "sma": feat_cols_sql([f"sma_{w}" for w in CFG.ma]),
        "vol_sma": feat_cols_sql([f"vol_sma_{w}" for w in CFG.ma]),
        "bbands": feat_cols_sql(["bb_mid_20", "bb_up_20", "bb_low_20", "bb_percent_b"]),
        "roll_volatility": feat_cols_sql([f"vol_logret_{w}" for w in CFG.vol]),
        "volume_stats": feat_cols_sql([c for w in CFG.vol_feat for c in (
            f"vol_roll_mean_{w}", f"vol_roll_std_{w}", f"trades_roll_mean_{w}", f"trades_roll_std_{w}",
            f"dollar_vol_roll_mean_{w}")]),
        "taker_ratios": feat_cols_sql(["dollar_volume", "taker_buy_ratio", "taker_buy_quote_ratio"]),
        "ema": feat_cols_sql([f"ema_{w}" for w in CFG.ma]),
        "rsi": feat_cols_sql(["rsi_14"]),
        "macd": feat_cols_sql(["macd_12_26", "macd_signal_9", "macd_hist"]),
        "atr": feat_cols_sql(["atr_14"]),
        "warmup_trim": feat_cols_sql(["close", "sma_50", "ema_50"], trim=True),
        "all_features": select_rounded(features_sql(SB), feats_all),
        "gaps_by_candle": GAPS_BY_CANDLE,
        "gap_ranges": gap_ranges_sql(0),
        "gap_ranges_allow2": gap_ranges_sql(2),
        "gap_grid_antijoin": GRID_SQL,
        "gap_top20": f"SELECT * FROM ({gap_ranges_sql(0)}) ORDER BY symbol, gap_start LIMIT 20",
        "union_common_columns": union_sql(),
        "ml_dropna": f"SELECT {rcols(ml_cols, fd)} FROM ({ml_sql(SB)})",
        "split_time": f"SELECT symbol, ts, split FROM ({split_sql(SB)})",
        "split_random": RANDOM_SPLIT_SQL.format(src=ml_sql(SB)),
        "split_null_time": f"""SELECT symbol, ts, CASE WHEN pos < floor(n * 0.7) THEN 'train' WHEN pos < floor(n * {0.7 + 0.15!r})
                THEN 'valid' ELSE 'test' END AS split
                FROM (SELECT symbol, ts, row_number() OVER (ORDER BY ts NULLS LAST, symbol) - 1 AS pos, count(*) OVER () AS n
                      FROM (SELECT symbol, CASE WHEN NOT ends_with(symbol, '7') THEN open_time END AS ts FROM ({SB})))""",
        "rsi_long_run": "SELECT symbol, ts, " + ", ".join(r(c) for c in ("ema_50", "rsi_14", "atr_14")) + f" FROM ({features_sql(RISING_BARS_SQL, horizons=(), trim=False)})",
        "symbolless_features": "SELECT symbol, ts, " + ", ".join(r(c) for c in ("sma_20", "ema_20", "rsi_14", "macd_hist", "vol_logret_12"))
                               + f" FROM ({features_sql(DAILY_BARS_SQL, horizons=(), trim=False)})",
        "ts_parse": "SELECT o_orderkey, o_orderdate::TIMESTAMP AS ts FROM orders",
        "raw_two_saves": select_rounded(clean_sql(SB), RAW12),
        "raw_corrected_save": select_rounded(clean_sql(CORRECTED_SQL.format(src=SB, late="false")), RAW12),
        "raw_compacted_saves": select_rounded(clean_sql(CORRECTED_SQL.format(src=SB, late="open_time >= '1998-01-01'")), RAW12),
        "daily_gap_ranges_allow2": DAILY_GAPS_SQL.format(src=SB),
        "split_sizes": f"SELECT split, count(*) AS n FROM ({split_sql(SB)}) GROUP BY split",
        "scaler_fit": f"SELECT feature, {rnd_sql('mean', 3)} AS mean, {rnd_sql('scale', 3)} AS scale FROM ({scaler_params_sql(SB)})",
        "scaled_dataset": scaled_sql(SB),
        "kline_pages": raw_bars_sql(),
        "kline_pages_overlap": select_rounded(OVERLAP_SQL.format(src=SB), ["open_time" if c == "ts" else c for c in RAW12]),
        "raw_mixed_headers": select_rounded(clean_sql(SB), RAW12),
        "raw_roundtrip": select_rounded(clean_sql(SB), RAW12),
        "feature_roundtrip": "SELECT * FROM (" + select_rounded(features_sql(SB), feats_all) + ") UNION ALL SELECT * FROM ("
                             + select_rounded(features_sql(SB), feats_all) + ")",
        "feature_dataset": select_rounded(features_sql(SB), feats_all),
        "end_to_end_dataset": scaled_sql(f"SELECT upper(symbol) AS symbol, * EXCLUDE (symbol) FROM ({HB})"),
    }
    for name, (task, th) in {"target_binclass": ("binclass", 0.0), "target_multiclass": ("multiclass", 0.01),
                             "target_reg": ("reg", 0.0)}.items():
        tg = target_names((1, 5, 15), task)
        w = "(PARTITION BY symbol ORDER BY ts)"
        parts = []
        for h, nm in zip((1, 5, 15), tg):
            fr = f"({ln(f'lead(close, {h}) OVER {w}')} - {ln('close')})"
            t = repr(th)
            if task == "reg":
                parts.append(f"{rnd_sql(fr, 8)} AS {nm}")
            elif task == "multiclass":
                parts.append(f"(CASE WHEN {fr} < -{t} THEN -1 WHEN {fr} >= -{t} AND {fr} <= {t} THEN 0 "
                             f"WHEN {fr} > {t} THEN 1 END)::BIGINT AS {nm}")
            else:
                parts.append(f"coalesce(({fr} > {t})::BIGINT, 0) AS {nm}")
        q[name] = f"""SELECT symbol, ts, {rnd_sql('close', 6)} AS close, {', '.join(tg)} FROM (
            SELECT symbol, ts, close, {', '.join(parts)}, lead(1, 15) OVER {w} IS NOT NULL AS tail_ok
            FROM ({clean_sql(SB)})) WHERE tail_ok"""
    return q
