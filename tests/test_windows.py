"""Indicator operators against pandas goldens and the hand goldens."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import golden
from barforge.config import Layout, WindowsConfig
from barforge.functions.columns import nan_to_null
from barforge.operators.clean import dedup_order, keep_valid, prepare_rows
from barforge.operators.ewm import EwmSpec, add_ewms
from barforge.operators.indicators import add_all_features, make_targets
from barforge.operators.series import SeriesPlan
from barforge.sources.fixtures import hourly_bars, supplier_bars
from datasets import SF001

TINY = Layout(block_rows=96, bucket_steps=16, ewm_block=16)


def _series(spark, values, symbol="A"):
    pdf = pd.DataFrame({"symbol": symbol, "ts": pd.date_range("2024-01-01", periods=len(values), freq="h"),
                        "x": pd.array(values, dtype="float64")})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df.withColumn("x", nan_to_null("x")), pdf


def _ewm(spark, df, alpha, mp, layout=Layout(), dense=False):
    plan = SeriesPlan(df, layout=layout)
    out = plan.map(lambda d: add_ewms(d.filter("_core"), [EwmSpec("y", "x", alpha, mp, dense)],
                                      block_rows=layout.block_rows, cap=layout.ewm_block))
    return out.orderBy("symbol", "ts").toPandas()["y"].to_numpy(dtype="float64", na_value=np.nan)


def test_ewm_hole_golden(spark):
    df, _ = _series(spark, [None, 1, 2, None, 4, 5])
    got = _ewm(spark, df, 0.5, 2)
    exp = [np.nan, np.nan, 1.5, 1.5, 3.166667, 4.083333]
    assert np.allclose(got, exp, atol=1e-6, equal_nan=True)


@pytest.mark.parametrize("alpha", [2 / 51, 1 / 14, 1 / 3, 1.0])
@pytest.mark.parametrize("split", [False, True])
def test_ewm_matches_pandas(spark, alpha, split):
    rng = np.random.default_rng(7)
    x = np.cumsum(rng.normal(size=700)) + 50
    x[rng.random(700) < 0.15] = np.nan
    x[:3] = np.nan
    df, pdf = _series(spark, list(x))
    got = _ewm(spark, df, alpha, 5, TINY if split else Layout(ewm_block=32))
    exp = pdf["x"].ewm(alpha=alpha, adjust=False, min_periods=5).mean().to_numpy()
    assert np.allclose(got, exp, rtol=1e-10, atol=1e-10, equal_nan=True)


@pytest.mark.parametrize("alpha", [2 / 51, 1 / 3, 1.0])
@pytest.mark.parametrize("split", [False, True])
def test_ewm_dense_matches_pandas(spark, alpha, split):
    rng = np.random.default_rng(11)
    x = np.cumsum(rng.normal(size=900)) + 80
    x[:30] = np.nan  # leading NULLs only
    df, pdf = _series(spark, list(x))
    got = _ewm(spark, df, alpha, 9, TINY if split else Layout(ewm_block=64), dense=True)
    exp = pdf["x"].ewm(alpha=alpha, adjust=False, min_periods=9).mean().to_numpy()
    assert np.allclose(got, exp, rtol=1e-10, atol=1e-10, equal_nan=True)


def _features(spark, layout=Layout(), horizons=(1, 5, 15)):
    rows = prepare_rows(hourly_bars(spark, SF001))
    f = add_all_features(rows, interval="1h", layout=layout, horizons=horizons,
                         dedup_order=dedup_order(rows.columns), keep=keep_valid(), close_known=True)
    return f.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True), rows.toPandas()


def _compare(got, exp):
    assert set(got.columns) == set(exp.columns)
    assert len(got) == len(exp)
    for c in got.columns:
        if c in ("symbol",):
            assert (got[c].values == exp[c].values).all()
        elif c in ("ts", "close_time"):
            assert (pd.to_datetime(got[c]).values == pd.to_datetime(exp[c]).values).all()
        else:
            a = got[c].to_numpy(dtype="float64", na_value=np.nan)
            b = exp[c].to_numpy(dtype="float64", na_value=np.nan)
            assert np.allclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True), c


def test_all_features_vs_pandas(spark):
    got, raw = _features(spark)
    _compare(got, golden.all_features(raw))


@pytest.mark.parametrize("layout", [TINY, Layout(block_rows=75, bucket_steps=1000, ewm_block=1)])
def test_all_features_any_block_size(spark, layout):
    """Tiny blocks with halos, blocks hardly longer than their halo: same result."""
    got, raw = _features(spark, layout=layout)
    _compare(got, golden.all_features(raw))


def test_invariant_to_partitioning_and_order(spark):
    rows = prepare_rows(supplier_bars(spark, SF001))
    a = add_all_features(rows, interval="1d").orderBy("symbol", "ts").toPandas()
    shuffled = rows.repartition(3).orderBy(F.rand(3))
    b = add_all_features(shuffled, interval="1d").orderBy("symbol", "ts").toPandas()
    _compare(a, b)
    one = rows.filter(F.col("symbol") == a["symbol"].iloc[0])
    c = add_all_features(one, interval="1d").orderBy("ts").toPandas()
    _compare(c, a[a["symbol"] == a["symbol"].iloc[0]].reset_index(drop=True))


def test_single_indicators(spark):
    from barforge.operators import indicators as I
    rows = prepare_rows(hourly_bars(spark, SF001)).filter(F.col("symbol") == "view")
    whole = add_all_features(rows, interval="1h", horizons=None, trim_warmup=False).orderBy("ts").toPandas()
    for fn in (I.add_moving_averages, I.add_rsi, I.add_macd, I.add_bbands, I.add_atr, I.add_roll_volatility, I.add_volume_features):
        one = fn(rows, interval="1h").orderBy("ts").toPandas()
        _compare(one, whole[list(one.columns)])
        assert len(one.columns) < len(whole.columns)
    assert "rsi_7" in I.add_rsi(rows, 7).columns and "macd_3_8" in I.add_macd(rows, 3, 8, 4).columns


def test_prefix_stability(spark):
    """Features of a row do not change when later rows are appended."""
    rows = prepare_rows(hourly_bars(spark, SF001)).filter(F.col("symbol") == "view")
    full = add_all_features(rows, interval="1h", horizons=None).toPandas()
    cut = full["ts"].iloc[len(full) // 2]
    part = add_all_features(rows.filter(F.col("ts") <= F.lit(cut)), interval="1h", horizons=None).toPandas()
    _compare(part, full[full["ts"] <= cut].reset_index(drop=True))


def test_hand_goldens(spark):
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=4, freq="h"),
                        "open": 1.0, "high": [12.0, 1, 1, 1], "low": [10.0, 0, 0, 0], "close": [0.0, 1, 0, 0],
                        "volume": [0.0, 1, 1, 1], "taker_buy_base": [3.0, 0, 0, 0]})
    df = spark.createDataFrame(pdf)
    cfg = WindowsConfig(ma=(2,), vol=(2,), vol_feat=(2,), rsi=2, macd_fast=2, macd_slow=3, macd_signal=2,
                        bb_period=2, atr_period=1)
    out = add_all_features(df, cfg, interval="1h", horizons=None, trim_warmup=False).orderBy("ts").toPandas()
    assert out["ret_simple"].isna().tolist() == [True, True, False, True]
    assert out["ret_simple"][2] == -1.0
    assert out["atr_1"][0] == 2.0  # true range of the first row = high - low
    assert pd.isna(out["taker_buy_ratio"][0])


def test_rsi_and_percent_b_nulls(spark):
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=40, freq="h"),
                        "open": 1.0, "high": 100.0, "low": 0.5, "close": np.arange(1.0, 41.0), "volume": 1.0})
    out = add_all_features(spark.createDataFrame(pdf), interval="1h", horizons=None, trim_warmup=False).orderBy("ts").toPandas()
    assert out["rsi_14"].isna().all()  # no loss -> NULL, not 100
    flat = pdf.assign(close=5.0)
    out2 = add_all_features(spark.createDataFrame(flat), interval="1h", horizons=None, trim_warmup=False).orderBy("ts").toPandas()
    assert out2["bb_percent_b"].isna().all()


def test_targets(spark):
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=20, freq="h"),
                        "close": np.exp(np.linspace(0, 1, 20))})
    df = spark.createDataFrame(pdf)
    assert make_targets(df, (1, 5, 15)).count() == 5
    c = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=4, freq="h"),
                      "close": [1.0, np.exp(0.1), 1.0, 1.0]})
    t = make_targets(spark.createDataFrame(c), (1,), "binclass", 0.0).orderBy("ts").toPandas()
    assert t["target_up_1"].tolist() == [1, 0, 0]
    r = np.cumsum([0, 0.02, 0.005, -0.005, -0.02])
    m = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=6, freq="h"),
                      "close": np.exp(np.append(r, 1.0))})
    md = spark.createDataFrame(m).withColumn("close", F.when(F.col("close") != F.lit(float(np.e)), F.col("close")))
    mt = make_targets(md, (1,), "multiclass", 0.01).orderBy("ts").toPandas()
    assert mt["target_cls_1"].tolist()[:4] == [1, 0, 0, -1]
    assert pd.isna(mt["target_cls_1"].tolist()[4])


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("dense", [False, True])
def test_ewm_long_decay(spark, split, dense):
    """Nothing is cut off: after the last non-zero value the mean decays for
    thousands of rows and, like the step-by-step recurrence, never becomes zero."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.random(50), np.zeros(12_000), rng.random(3), np.zeros(300)])
    df, pdf = _series(spark, list(x))
    got = _ewm(spark, df, 1 / 14, 14, Layout(block_rows=2048, bucket_steps=512, ewm_block=256) if split else Layout(), dense=dense)
    y, want = x[0], []
    for v in x:
        y = y * (13 / 14) + v / 14
        want.append(y)
    want = np.array(want)
    seen = want > 1e-290
    assert (got[13:] > 0).all()
    assert np.allclose(got[13:][seen[13:]], want[13:][seen[13:]], rtol=1e-9)


def test_rsi_of_long_flat_and_rising_runs(spark):
    rng = np.random.default_rng(6)
    head = 50 + np.cumsum(rng.normal(size=200))
    runs = {"flat": np.full(3000, head[-1]), "up": head[-1] + np.arange(1, 3001) * 0.01}
    frames = []
    for name, run in runs.items():
        c = np.concatenate([head, run])
        frames.append(pd.DataFrame({"symbol": name, "ts": pd.date_range("2024-01-01", periods=len(c), freq="min"), "open": c, "high": c,
                                    "low": c, "close": c, "volume": 1.0}))
    bars = spark.createDataFrame(pd.concat(frames)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = add_all_features(bars, interval="1m", horizons=None, trim_warmup=False, columns=["rsi_14"]).toPandas()
    for name, run in runs.items():
        c = np.concatenate([head, run])
        rsi = got[got["symbol"] == name].sort_values("ts")["rsi_14"].to_numpy(dtype="float64", na_value=np.nan)
        gain, loss, want = None, None, []
        for d in np.diff(c):
            g, ls = max(d, 0.0), max(-d, 0.0)
            gain = g if gain is None else gain * (13 / 14) + g / 14
            loss = ls if loss is None else loss * (13 / 14) + ls / 14
            want.append(100 - 100 / (1 + gain / loss) if loss else np.nan)
        assert np.isnan(rsi).sum() == 14, name
        assert np.allclose(rsi[14:], want[13:], atol=1e-6)


def test_layout_numbers_and_halos(spark):
    """Exact numbers whatever the sizes, rows without a time first, one of equal times kept, halos of both sides."""
    rng = np.random.default_rng(8)
    rows = [(s, None if rng.random() < 0.02 else int(t), float(v)) for s, n in (("A", 300), ("B", 7), (None, 40), ("C", 1))
            for t, v in zip(rng.integers(0, 50 * n, n), rng.random(n))]
    rows += [("A", r[1], r[2] + 1) for r in rows[:30]]
    df = spark.createDataFrame(rows, "symbol string, m long, x double").withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    want = {}
    for s in {r[0] for r in rows}:
        best = {}
        for _, m, x in (r for r in rows if r[0] == s):
            best[m] = max(best.get(m, -1.0), x)
        for i, m in enumerate(sorted(best, key=lambda v: (v is not None, v or 0))):
            want[s, m] = (i + 1, best[m])
    for layout in (Layout(), Layout(block_rows=4, bucket_steps=3, ewm_block=4), Layout(block_rows=64, bucket_steps=10**6, ewm_block=4)):
        plan = SeriesPlan(df, back=3, ahead=2, dedup_order=[F.col("x").desc()], layout=layout)
        got = [(None if r.symbol == "\0" else r.symbol, r.m, r.x, r._rn, r._blk, r._core) for r in plan.blocks().collect()]
        assert {(s, m): (n, x) for s, m, x, n, _, core in got if core} == want
        assert sum(r[-1] for r in got) == len(want)
        for s in {r[0] for r in got}:
            size, total = layout.block_rows, sum(k[0] == s for k in want)
            for b in range((total - 1) // size + 1):
                held = sorted(r[3] for r in got if r[0] == s and r[4] == b)
                assert held == list(range(max(1, b * size + 1 - 3), min(total, (b + 1) * size + 2) + 1))


def test_ewm_of_many_blocks_is_linear(spark):
    """100,000 blocks of one series: their maps are composed as a tree, in seconds."""
    import time
    from barforge.operators import ewm
    n = 100_000
    maps = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(
        F.when(i == 5, F.lit(0.0)).otherwise(F.lit(0.9)).alias("A_E"), (i % 7).cast("double").alias("B_E"),
        F.when(i == 5, F.lit(0.0)).otherwise(F.lit(1.0)).alias("A_f"))).alias("_m"))
    began = time.time()
    got = maps.select(ewm._scan("_m", F.lit(3.0)).alias("y")).first().y
    assert time.time() - began < 30
    y, want = 3.0, []
    for i in range(1, n + 1):
        want.append(y)
        y = (0.0 if i == 5 else 0.9) * y + i % 7
    assert np.allclose(got, want, rtol=1e-12)
