"""Shared sliding moments against plain loops, and saves of raw candles."""

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barforge.operators import ewm, indicators
from barforge.operators.indicators import add_all_features
from barforge.operators.moments import add_sliding_moments, pieces
from barforge.plans import dataset
from barforge.session import path_exists, persist, scratch_path
from barforge.sources.files import compact_raw, load_and_prepare, load_time_index, save_features, save_raw, saves
from barforge.sources.klines import read_kline_pages, write_kline_pages


def test_pieces_fill_every_width():
    for width in range(1, 400):
        at = 0
        for level, offset in pieces(width):
            assert offset == at
            at += 4 ** level
        assert at == width and len(pieces(width)) <= 3 * 5


@pytest.mark.parametrize("kind", ["holes", "equal", "far", "short"])
def test_moments_against_loops(spark, kind):
    rng = random.Random(kind)
    n = {"short": 3}.get(kind, 150)
    value = {"holes": lambda i: None if rng.random() < 0.03 else rng.gauss(0, 1), "equal": lambda i: 0.1 if i > 20 else 0.7,
             "far": lambda i: 1e9 + rng.random(), "short": lambda i: float(i)}[kind]
    xs = [value(i) for i in range(n)]
    rows = [(s, i, x) for s in ("a", "b") for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "symbol string, ts int, x double")
    widths = [1, 2, 3, 4, 5, 12, 20, 50, 72]
    got = add_sliding_moments(df, Window.partitionBy("symbol").orderBy("ts"), {"x": widths, "ts": [5]}, {"x"}).collect()
    assert len(got) == 2 * n and got[0].asDict().keys() == {"symbol", "ts", "x", "_mean5_ts", *(f"_{m}{k}_x" for m in ("mean", "std") for k in widths)}
    for r in got:
        for k in widths:
            own = xs[r.ts - k + 1:r.ts + 1] if r.ts >= k - 1 else [None]
            if None in own:
                assert r[f"_mean{k}_x"] is None and r[f"_std{k}_x"] is None
                continue
            mean, std = math.fsum(own) / k, statistics.pstdev(own)
            assert abs(r[f"_mean{k}_x"] - mean) <= 1e-14 * max(1, abs(mean)) and abs(r[f"_std{k}_x"] - std) <= 1e-12 + 1e-15 * abs(mean)  # sums of squares would be off by 1e2 at 1e9
            if len(set(own)) == 1:
                assert r[f"_std{k}_x"] == 0 and r[f"_mean{k}_x"] == own[0]


def _candles(spark, hours, close, trades):
    start = datetime(2024, 1, 1)
    rows = [("00700", start + timedelta(hours=h), close, close, close, close, 1.0, start + timedelta(hours=h, minutes=59), 1.0, trades, 0.0, 0.0) for h in hours]
    return spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double, "
                                       "close_time timestamp_ntz, quote_volume double, trades long, taker_buy_base double, taker_buy_quote double")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_later_save_corrects_an_earlier_one(spark, fmt):
    out = scratch_path(spark, "saves")
    first = save_raw(_candles(spark, range(10), 2.0, 9), out, fmt, "1h")
    save_raw(_candles(spark, range(5, 12), 3.0, 1), out, fmt, "1h")
    root = f"{out}/interval=1h"

    def closes():
        return [r.close for r in load_and_prepare(spark, root, fmt=fmt).orderBy("ts").collect()]

    assert closes() == [2.0] * 5 + [3.0] * 7 and saves(spark, root) == [1, 2]
    assert "_ingest_seq" not in load_and_prepare(spark, root, fmt=fmt).columns
    assert load_and_prepare(spark, root, fmt=fmt).first().symbol == "00700"
    assert [tuple(r)[-2:] for r in first.select("first_open", "symbol", "rows", "file_stem").collect()] == [(10, "00700_1h_20240101_20240101")]
    assert path_exists(spark, f"{root}/_manifests/2")
    assert compact_raw(spark, out, fmt, "1h") == 3 and saves(spark, root) == [3]
    assert closes() == [2.0] * 5 + [3.0] * 7
    save_raw(_candles(spark, [0], 1.0, 0), out, fmt, "1h")
    assert closes() == [1.0] + [2.0] * 4 + [3.0] * 7 and saves(spark, root) == [3, 4]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_files_of_a_save_do_not_grow_with_its_symbols(spark, fmt):
    out = scratch_path(spark, "saves")
    names = [None, "", " a ", "00700", 'q"u,o', "x/y=z", *(f"S{i}" for i in range(300))]
    symbol = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("id") + 1).cast("int"))
    bars = _candles(spark, [0], 2.0, 9).crossJoin(spark.range(len(names))).withColumn("symbol", symbol).drop("id")
    save_raw(bars, out, fmt, "1h")
    root = f"{out}/interval=1h"
    assert spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", True).load(f"{root}/_ingest_seq=1").count() <= 8
    got = load_and_prepare(spark, root, fmt=fmt).select("symbol").collect()
    assert sorted(str(r.symbol) for r in got) == sorted(str(n) for n in names if n != "")  # as with folders of symbols, '' is none


def test_pages_are_compressed_and_hold_the_same_candles(spark):
    root = scratch_path(spark, "pages")
    bars = _candles(spark, range(1500), 2.5, 9)
    write_kline_pages(bars, root, "1h", again=_candles(spark, [3], 0.1, 1))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path").collect()
    assert [f.path.rpartition(".")[2] for f in files] == ["gz"]
    got = read_kline_pages(spark, root, whole_files=False).orderBy("open_time").collect()
    assert [(r.close, r.trades) for r in got] == [(0.1, 1) if h == 3 else (2.5, 9) for h in range(1500)]


def test_features_are_saved_compressed(spark):
    root = scratch_path(spark, "features")
    frame = spark.createDataFrame([(None, datetime(2024, 1, 1), 0.1), ("00700", datetime(2024, 1, 2), None)], "symbol string, ts timestamp_ntz, sma_5 double")
    path = save_features(frame, f"{root}/part.csv", "CSV", compression="gzip")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()
    assert listed and all(f.path.endswith(".csv.gz") for f in listed)
    got = load_time_index(spark, path).orderBy("ts").collect()
    assert [(r.symbol, r.sma_5) for r in got] == [(None, 0.1), ("00700", None)]


def test_summaries_of_recursive_means_are_kept(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(indicators, "persist", lambda d: d)
    monkeypatch.setattr(ewm, "persist", lambda d: kept.append(d.columns) or persist(d), raising=False)
    bars = _candles(spark, range(30), 2.0, 9).withColumnRenamed("open_time", "ts")
    out = add_all_features(bars, interval="1h", horizons=None, trim_warmup=False, columns=["ema_5", "atr_14"])
    assert [r.ema_5 for r in out.where("ema_5 IS NOT NULL").collect()] == pytest.approx([2.0] * 26)
    assert len(kept) == 1 and {"spec", "symbol", "_eb", "n_obs"} <= set(kept[0])


def test_dataset_keeps_its_features_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(dataset, "persist", lambda d: kept.append(d) or persist(d))
    rows = [("A", datetime(2024, 1, 1) + timedelta(hours=h), float(h % 7), h % 2) for h in range(40)]
    frame = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, x double, target_up_1 long")
    out, meta = dataset.get_ml_datasets(spark, None, frames=[frame], verbose=False)
    assert len(kept) == 1 and meta["sizes"] == {"train": 28, "valid": 6, "test": 6}
    train = [r.x for r in out.where("split = 'train'").collect()]
    assert abs(statistics.fmean(train)) < 1e-12 and abs(statistics.pstdev(train) - 1) < 1e-12 and out.count() == 40
