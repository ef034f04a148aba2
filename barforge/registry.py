"""Registered queries: one per operator family, over bars that Spark derives
from the driver's test tables (``sources.fixtures``).  Each takes
``(spark, sf_dir)`` and returns a DataFrame whose column names match the
oracle SQL in ``barforge.oracle``.  Round-trip queries write into the shared
scratch folder (``spark.checkpoint.dir``) and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.config import Layout, WindowsConfig
from barforge.operators.clean import dedup_order, keep_valid, parse_time, prepare_bars, prepare_rows
from barforge.operators.gaps import check_gaps, find_time_gaps, first_gaps, grid_missing
from barforge.operators.indicators import add_all_features, make_targets
from barforge.operators.scale import fit_scaler
from barforge.operators.union import concat_intersection
from barforge.plans.dataset import get_ml_datasets, ml_frame
from barforge.operators.split import split_random, split_time
from barforge.plans.features import get_features_dataset
from barforge.plans.workflow import run_chain
from barforge.rounding import round_frame
from barforge.session import ensure_utc, release_cached, scratch_path, shuffles_removed
from barforge.sources.files import compact_raw, gather_input_files, load_and_prepare, load_time_index, manifest, save_features, save_raw
from barforge.sources.fixtures import daily_bars, hourly_bars, rising_bars, supplier_bars, supplier_lines, table
from barforge.sources.klines import read_kline_pages, write_kline_pages
from barforge.sources.scan import bounded_scan

CFG = WindowsConfig()
LAYOUT = Layout()
TIME_LO, TIME_HI = "1996-01-01 00:00:00", "1997-01-01 00:00:00"


def _ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as TIMESTAMP_NTZ (UTC wall time), the oracle's type."""
    return df.selectExpr(*[f"CAST(`{n}` AS TIMESTAMP_NTZ) AS `{n}`" if t == "timestamp" else f"`{n}`"
                           for n, t in df.dtypes])


def _out(df: DataFrame, scaled: set[str] | None = None) -> DataFrame:
    return round_frame(_ntz(df), scaled)


def sb_clean(spark, d):
    return prepare_rows(supplier_bars(spark, d))


def hb_clean(spark, d):
    return prepare_rows(hourly_bars(spark, d))


def sb_features(spark, d, horizons=(1, 5, 15), task="binclass", thresh=0.0, trim=True, columns=None):
    lines, longest = supplier_lines(spark, d)
    rows = prepare_rows(supplier_bars(spark, d, lines=lines if longest <= LAYOUT.block_rows else None))
    return add_all_features(rows, CFG, interval="1d", horizons=horizons, task=task, thresh=thresh,
                            trim_warmup=trim, dedup_order=dedup_order(rows.columns), keep=keep_valid(), close_known=True,
                            columns=columns, layout=LAYOUT, longest=longest)


def dirty_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw text candles with the usual defects, derived from hourly bars:
    every bar once as delivered (volume 'n/a' for one-event bars, close
    'bad' for two-event bars, unparseable open time for four-event bars),
    and bars with three or more events delivered again 1 ms later with high
    and low swapped."""
    hb = hourly_bars(spark, d)
    s = lambda c: F.col(c).cast("string")
    ot = F.date_format("open_time", "yyyy-MM-dd HH:mm:ss")
    ct = F.date_format("close_time", "yyyy-MM-dd HH:mm:ss.SSS")
    a = hb.select(
        "symbol", F.when(F.col("trades") == 4, F.lit("n/a")).otherwise(ot).alias("open_time"),
        s("open").alias("open"), s("high").alias("high"), s("low").alias("low"),
        F.when(F.col("trades") == 2, F.lit("bad")).otherwise(s("close")).alias("close"),
        F.when(F.col("trades") == 1, F.lit("n/a")).otherwise(s("volume")).alias("volume"),
        ct.alias("close_time"), s("quote_volume").alias("quote_volume"), s("trades").alias("trades"),
        s("taker_buy_base").alias("taker_buy_base"), s("taker_buy_quote").alias("taker_buy_quote"))
    b = hb.filter(F.col("trades") >= 3).select(
        "symbol", ot.alias("open_time"), s("open").alias("open"), s("low").alias("high"), s("high").alias("low"),
        s("close").alias("close"), s("volume").alias("volume"),
        F.date_format(F.col("close_time") + F.expr("INTERVAL '0.001' SECOND"), "yyyy-MM-dd HH:mm:ss.SSS").alias("close_time"),
        s("quote_volume").alias("quote_volume"), s("trades").alias("trades"),
        s("taker_buy_base").alias("taker_buy_base"), s("taker_buy_quote").alias("taker_buy_quote"))
    return a.unionByName(b)


RAW12 = ["symbol", "ts", "open", "high", "low", "close", "volume", "close_time", "quote_volume",
         "trades", "taker_buy_base", "taker_buy_quote"]


# ---------------------------------------------------------------- cleaning ---
def q_clean_dedup(spark, d):
    return _out(prepare_bars(dirty_raw(spark, d)).select(*RAW12))


def q_numeric_coerce(spark, d):
    rows = prepare_rows(dirty_raw(spark, d))
    return _out(rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.count("ts").alias("ts_ok"), F.count("close").alias("close_ok"),
        F.count("volume").alias("volume_ok"), F.count("trades").alias("trades_ok")))


def q_ohlc_envelope(spark, d):
    raw = dirty_raw(spark, d)
    rows = prepare_rows(raw)
    return _out(rows.filter(keep_valid()).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("high") - F.col("low")).alias("sum_range"),
        F.count(F.when(F.col("high") < F.col("low"), 1)).alias("inverted")))


# ------------------------------------------------------ scans / aggregates ---
def q_time_range_scan(spark, d):
    bars = supplier_bars(spark, d)
    lo = F.lit(TIME_LO).cast("timestamp_ntz")
    hi = F.lit(TIME_HI).cast("timestamp_ntz")
    return _out(bounded_scan(bars, None, lo, hi))


def q_symbol_manifest(spark, d):
    return _out(manifest(supplier_bars(spark, d), "1d"))


def q_distinct_symbols(spark, d):
    return supplier_bars(spark, d).select("symbol").distinct()


# --------------------------------------------------------------- indicators --
def _feat_cols(spark, d, cols, trim=False):
    """Only the requested indicator family is computed."""
    f = sb_features(spark, d, horizons=None, trim=trim, columns=[c for c in cols if c not in RAW12])
    return _out(f.select("symbol", "ts", *cols))


def q_returns_spread(spark, d):
    return _feat_cols(spark, d, ["ret_simple", "ret_log", "hl_spread"])


def q_sma(spark, d):
    return _feat_cols(spark, d, [f"sma_{w}" for w in CFG.ma])


def q_vol_sma(spark, d):
    return _feat_cols(spark, d, [f"vol_sma_{w}" for w in CFG.ma])


def q_bbands(spark, d):
    return _feat_cols(spark, d, ["bb_mid_20", "bb_up_20", "bb_low_20", "bb_percent_b"])


def q_roll_volatility(spark, d):
    return _feat_cols(spark, d, [f"vol_logret_{w}" for w in CFG.vol])


def q_volume_stats(spark, d):
    cols = []
    for w in CFG.vol_feat:
        cols += [f"vol_roll_mean_{w}", f"vol_roll_std_{w}", f"trades_roll_mean_{w}", f"trades_roll_std_{w}",
                 f"dollar_vol_roll_mean_{w}"]
    return _feat_cols(spark, d, cols)


def q_taker_ratios(spark, d):
    return _feat_cols(spark, d, ["dollar_volume", "taker_buy_ratio", "taker_buy_quote_ratio"])


def q_ema(spark, d):
    return _feat_cols(spark, d, [f"ema_{w}" for w in CFG.ma])


def q_rsi(spark, d):
    return _feat_cols(spark, d, ["rsi_14"])


def q_macd(spark, d):
    return _feat_cols(spark, d, ["macd_12_26", "macd_signal_9", "macd_hist"])


def q_atr(spark, d):
    return _feat_cols(spark, d, ["atr_14"])


def q_warmup_trim(spark, d):
    return _feat_cols(spark, d, ["close", "sma_50", "ema_50"], trim=True)


def q_all_features(spark, d):
    return _out(sb_features(spark, d))


# --------------------------------------------------------------------- gaps --
def hb_with_offgrid(spark, d):
    """Hourly bars plus, per symbol, one off-grid bar at the minute of the
    symbol's last event (the report must ignore it for the grid)."""
    hb = hourly_bars(spark, d).select("symbol", F.col("open_time").alias("ts"))
    ev = table(spark, d, "events")
    extra = ev.groupBy(F.col("event_type").alias("symbol")).agg(F.date_trunc("minute", F.max("ts")).alias("ts"))
    return hb.unionByName(extra).distinct()


def q_gaps_by_candle(spark, d):
    return check_gaps(hourly_bars(spark, d), "1h")


def q_gap_ranges(spark, d):
    return _out(find_time_gaps(hb_with_offgrid(spark, d), interval="1h"))


def q_gap_ranges_allow2(spark, d):
    return _out(find_time_gaps(hb_with_offgrid(spark, d), interval="1h", max_allow_miss=2))


def q_gap_grid_antijoin(spark, d):
    return _out(grid_missing(hb_with_offgrid(spark, d), interval="1h"))


def q_gap_top20(spark, d):
    return _out(first_gaps(find_time_gaps(hb_with_offgrid(spark, d), interval="1h"), 20))


# ------------------------------------------------------------------ targets --
def _targets(spark, d, task, thresh):
    rows = sb_clean(spark, d).select("symbol", "ts", "close")
    return _out(make_targets(rows, (1, 5, 15), task, thresh))


def q_target_binclass(spark, d):
    return _targets(spark, d, "binclass", 0.0)


def q_target_multiclass(spark, d):
    return _targets(spark, d, "multiclass", 0.01)


def q_target_reg(spark, d):
    return _targets(spark, d, "reg", 0.0)


# ------------------------------------------------------------------ dataset --
def _ml(spark, d):
    data, target, feats = ml_frame([sb_features(spark, d)])
    return data, target, feats


def q_union_common_columns(spark, d):
    a = supplier_bars(spark, d).withColumn("sb_spread", F.col("high") - F.col("low"))
    b = hourly_bars(spark, d).withColumn("hb_events", F.col("trades") * 2)
    return _out(concat_intersection([a, b]))


def q_ml_dropna(spark, d):
    data, _, _ = _ml(spark, d)
    return _out(data)


def q_split_time(spark, d):
    data, _, _ = _ml(spark, d)
    n = data.count()
    return _out(split_time(data, n).select("symbol", "ts", "split"))


def q_split_sizes(spark, d):
    data, _, _ = _ml(spark, d)
    n = data.count()
    return split_time(data, n).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_split_random(spark, d):
    data, _, _ = _ml(spark, d)
    n = data.count()
    return _out(split_random(data, n, random_state=42).select("symbol", "ts", "split"))


def q_split_null_time(spark, d):
    """Rows without a time stay, in the last part."""
    rows = sb_clean(spark, d).select("symbol", F.when(~F.col("symbol").endswith("7"), F.col("ts")).alias("ts"))
    return _out(split_time(rows, rows.count()))


def q_rsi_long_run(spark, d):
    rows = prepare_rows(rising_bars(spark, d))
    out = add_all_features(rows, CFG, interval="1d", horizons=None, trim_warmup=False, dedup_order=dedup_order(rows.columns),
                           keep=keep_valid(), close_known=True, columns=["ema_50", "rsi_14", "atr_14"])
    return _out(out.select("symbol", "ts", "ema_50", "rsi_14", "atr_14"))


def q_symbolless_features(spark, d):
    rows = prepare_rows(daily_bars(spark, d))
    out = add_all_features(rows, CFG, interval="1d", horizons=None, trim_warmup=False, dedup_order=dedup_order(rows.columns),
                           keep=keep_valid(), close_known=True, columns=["sma_20", "ema_20", "rsi_14", "macd_hist", "vol_logret_12"])
    return _out(out.select("symbol", "ts", "sma_20", "ema_20", "rsi_14", "macd_hist", "vol_logret_12"))


def q_ts_parse(spark, d):
    """Order dates written in ten forms, read back."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    forms = [day, F.concat(day, F.lit(" 00:00:00")), F.concat(day, F.lit("T00:00:00Z")), F.concat(day, F.lit("T00:00:00+0000")),
             F.concat(day, F.lit(" 00:00:00 +00:00")), F.concat(day, F.lit(" 00:00:00 UTC")), F.concat(day, F.lit(" 00:00:00.000000000")),
             F.concat(F.lit("  "), day, F.lit("T01:30:00+01:30 ")), (F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * F.lit(86_400_000)).cast("string"),
             F.concat(day, F.lit(" 00:00"))]
    text = F.element_at(F.array(*forms), (F.pmod("o_orderkey", F.lit(len(forms))) + 1).cast("int"))
    rows = table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return _out(rows.select("o_orderkey", parse_time("text", rows.schema["text"].dataType).alias("ts")))


def q_raw_two_saves(spark, d):
    """Updates add up: two saves of different symbols, then part of them again."""
    root = scratch_path(spark, "raw")
    bars = supplier_bars(spark, d)
    save_raw(bars.where(F.col("symbol") < "S00050"), root, "parquet", "1d")
    save_raw(bars.where(F.col("symbol") >= "S00050"), root, "parquet", "1d")
    save_raw(bars.where(F.col("open_time") >= "1997-01-01"), root, "parquet", "1d")
    return _out(load_and_prepare(spark, f"{root}/interval=1d", fmt="parquet").select(*RAW12))


def _corrected_saves(spark, d) -> str:
    """All bars, then those of 1996 and 1997 again with half the close and no trades, then those of 1997 with a quarter."""
    root = scratch_path(spark, "raw")
    bars = supplier_bars(spark, d)
    save_raw(bars, root, "parquet", "1d")
    for since, part in (("1996-01-01", 2.0), ("1997-01-01", 4.0)):
        again = bars.where((F.col("open_time") >= since) & (F.col("open_time") < "1998-01-01"))
        save_raw(again.withColumns({"close": F.col("close") / part, "trades": F.lit(0).cast("long")}), root, "parquet", "1d")
    return root


def q_raw_corrected_save(spark, d):
    """The last save of a candle counts, though its other columns are smaller."""
    return _out(load_and_prepare(spark, f"{_corrected_saves(spark, d)}/interval=1d", fmt="parquet").select(*RAW12))


def q_raw_compacted_saves(spark, d):
    """One save is left of three, with a row for each candle; a later save still corrects it."""
    root = _corrected_saves(spark, d)
    compact_raw(spark, root, "parquet", "1d")
    late = supplier_bars(spark, d).where("open_time >= '1998-01-01'")
    save_raw(late.withColumn("trades", F.lit(0).cast("long")), root, "parquet", "1d")
    return _out(load_and_prepare(spark, f"{root}/interval=1d", fmt="parquet").select(*RAW12))


def q_daily_gap_ranges_allow2(spark, d):
    return _out(find_time_gaps(sb_clean(spark, d).select("symbol", "ts"), interval="1d", max_allow_miss=2))


def q_scaler_fit(spark, d):
    data, _, feats = _ml(spark, d)
    n = data.count()
    s = split_time(data, n)
    p = fit_scaler(s, feats, F.col("split") == "train")
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__scale`" for c in feats)
    return _out(p.selectExpr(f"stack({len(feats)}, {stack}) as (feature, mean, scale)"))


def q_scaled_dataset(spark, d):
    out, meta = get_ml_datasets(spark, None, frames=[sb_features(spark, d)], verbose=False)
    return _out(out, scaled=set(meta["feature_cols"]))


# ----------------------------------------------------------- sources/sinks --
def q_kline_pages(spark, d):
    root = scratch_path(spark, "pages")
    write_kline_pages(supplier_bars(spark, d), root, interval="1d")
    return _out(read_kline_pages(spark, root, whole_files=False))


def q_kline_pages_overlap(spark, d):
    """Candles of two years come again later in the same files: the last page counts."""
    root = scratch_path(spark, "pages")
    bars = supplier_bars(spark, d)
    again = bars.where("open_time >= '1996-01-01' AND open_time < '1998-01-01'")
    write_kline_pages(bars, root, interval="1d", again=again.withColumns({"close": F.col("close") / 2.0, "trades": F.lit(0).cast("long")}))
    return _out(read_kline_pages(spark, root, whole_files=False))


def q_raw_mixed_headers(spark, d):
    """CSV files in two orders of columns, one of them with a column more."""
    root = scratch_path(spark, "raw")
    bars = supplier_bars(spark, d)
    bars.where("open_time < '1996-01-01'").write.option("header", True).csv(f"{root}/part=1")
    other = bars.where("open_time >= '1996-01-01'").withColumn("venue", F.lit("x"))
    other.select(*reversed(other.columns)).write.option("header", True).csv(f"{root}/part=2")
    return _out(load_and_prepare(spark, root, mixed_headers=True).select(*RAW12))


def q_raw_roundtrip(spark, d):
    root = scratch_path(spark, "raw")
    save_raw(supplier_bars(spark, d), root, "csv", "1d")
    back = load_and_prepare(spark, f"{root}/interval=1d", fmt="csv")
    return _out(back.select(*RAW12))


def q_feature_roundtrip(spark, d):
    root = scratch_path(spark, "features")
    f = sb_features(spark, d)
    # the rest reads what this save writes: the features are computed once, and what they kept and shuffled can go
    with shuffles_removed(spark):
        save_features(f, f"{root}/part_a.parquet", "PARQUET", compression="zstd")
    release_cached()
    save_features(load_time_index(spark, f"{root}/part_a.parquet"), f"{root}/part_b.csv", "csv", compression="gzip")
    frames = [load_time_index(spark, p) for p in gather_input_files(spark, root)]
    return _out(concat_intersection(frames))


def q_feature_dataset(spark, d):
    root = scratch_path(spark, "rawcsv")
    save_raw(supplier_bars(spark, d), root, "csv", "1d")
    df, feats, tgts, _ = get_features_dataset(spark, f"{root}/interval=1d", interval="1d", log_gaps=False,
                                           input_format="csv")
    return _out(df.select(*feats, *tgts))


def q_end_to_end_dataset(spark, d):
    pages = scratch_path(spark, "e2e-pages")
    write_kline_pages(hourly_bars(spark, d), pages, interval="1h")
    out = run_chain(spark, pages, scratch_path(spark, "e2e-raw"), scratch_path(spark, "e2e-features"),
                    interval="1h", pages_whole_files=False)
    ds, meta = out
    return _out(ds, scaled=set(meta["feature_cols"]))


QUERIES = {
    "clean_dedup": q_clean_dedup,
    "numeric_coerce": q_numeric_coerce,
    "ohlc_envelope": q_ohlc_envelope,
    "time_range_scan": q_time_range_scan,
    "symbol_manifest": q_symbol_manifest,
    "distinct_symbols": q_distinct_symbols,
    "returns_spread": q_returns_spread,
    "sma": q_sma,
    "vol_sma": q_vol_sma,
    "bbands": q_bbands,
    "roll_volatility": q_roll_volatility,
    "volume_stats": q_volume_stats,
    "taker_ratios": q_taker_ratios,
    "ema": q_ema,
    "rsi": q_rsi,
    "macd": q_macd,
    "atr": q_atr,
    "warmup_trim": q_warmup_trim,
    "all_features": q_all_features,
    "gaps_by_candle": q_gaps_by_candle,
    "gap_ranges": q_gap_ranges,
    "gap_ranges_allow2": q_gap_ranges_allow2,
    "gap_grid_antijoin": q_gap_grid_antijoin,
    "gap_top20": q_gap_top20,
    "target_binclass": q_target_binclass,
    "target_multiclass": q_target_multiclass,
    "target_reg": q_target_reg,
    "union_common_columns": q_union_common_columns,
    "ml_dropna": q_ml_dropna,
    "split_time": q_split_time,
    "split_sizes": q_split_sizes,
    "split_random": q_split_random,
    "split_null_time": q_split_null_time,
    "rsi_long_run": q_rsi_long_run,
    "symbolless_features": q_symbolless_features,
    "ts_parse": q_ts_parse,
    "raw_two_saves": q_raw_two_saves,
    "raw_corrected_save": q_raw_corrected_save,
    "raw_compacted_saves": q_raw_compacted_saves,
    "daily_gap_ranges_allow2": q_daily_gap_ranges_allow2,
    "scaler_fit": q_scaler_fit,
    "scaled_dataset": q_scaled_dataset,
    "kline_pages": q_kline_pages,
    "kline_pages_overlap": q_kline_pages_overlap,
    "raw_mixed_headers": q_raw_mixed_headers,
    "raw_roundtrip": q_raw_roundtrip,
    "feature_roundtrip": q_feature_roundtrip,
    "feature_dataset": q_feature_dataset,
    "end_to_end_dataset": q_end_to_end_dataset,
}


def wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        # intermediates persisted for the previous query are released here:
        # its result has been consumed by then (a later reuse recomputes)
        release_cached()
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run
