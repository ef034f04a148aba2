"""Gap reports, split, scaler, union, page ingest."""

from collections import Counter
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barforge.config import Layout
from barforge.operators.gaps import check_gaps, find_time_gaps, grid_missing
from barforge.operators.scale import apply_scaler_values, fit_scaler
from barforge.operators.split import random_split_sizes, split_random, split_time, time_split_sizes
from barforge.operators.union import concat_intersection
from barforge.session import scratch_path
from barforge.sources.klines import read_kline_pages

TINY = Layout(block_rows=4, bucket_steps=2, ewm_block=2)


def _times(spark, hhmm, symbol="A"):
    return spark.createDataFrame(
        [(symbol, datetime(2024, 1, 1, int(t[:2]), int(t[3:]))) for t in hhmm], ["symbol", "ts"])


@pytest.mark.parametrize("layout", [Layout(), TINY])
def test_gap_ranges(spark, layout):
    df = _times(spark, ["00:00", "00:05", "00:20", "00:25", "00:40"])
    got = [(r.gap_start.strftime("%H:%M"), r.gap_end.strftime("%H:%M"), r.missing_count)
           for r in find_time_gaps(df, "5m", layout=layout).orderBy("gap_start").collect()]
    assert got == [("00:10", "00:15", 2), ("00:30", "00:35", 2)]
    assert find_time_gaps(df, "5m", max_allow_miss=2, layout=layout).count() == 0
    off = _times(spark, ["00:00", "00:05", "00:12", "00:15"])
    got = [(r.gap_start.strftime("%H:%M"), r.gap_end.strftime("%H:%M"), r.missing_count)
           for r in find_time_gaps(off, "5m", layout=layout).collect()]
    assert got == [("00:10", "00:10", 1)]


def test_gaps_by_candle_and_grid(spark):
    df = _times(spark, ["00:00", "00:05", "00:20", "00:25", "00:40"]).withColumnRenamed("ts", "open_time")
    got = sorted((r.gap_before, r.missing_candles) for r in check_gaps(df, "5m").collect())
    assert got == [("2024-01-01T00:20:00+00:00", 2), ("2024-01-01T00:40:00+00:00", 2)]
    off = _times(spark, ["00:00", "00:05", "00:12", "00:15"]).withColumnRenamed("ts", "open_time")
    got = sorted((r.gap_before, r.missing_candles) for r in check_gaps(off, "5m", layout=TINY).collect())
    assert got == [("2024-01-01T00:12:00+00:00", 0), ("2024-01-01T00:15:00+00:00", 0)]
    miss = grid_missing(_times(spark, ["00:00", "00:05", "00:20", "00:25", "00:40"]), "5m", chunk=2)
    assert sorted(r.ts.strftime("%H:%M") for r in miss.collect()) == ["00:10", "00:15", "00:30", "00:35"]
    with pytest.raises(ValueError):
        check_gaps(df, "1d")


def _gaps_by_hand(bars, step):
    """Runs of missing grid points and the points themselves, by a set of minutes."""
    runs, points = [], []
    for symbol in sorted({s for s, _ in bars}):
        times = {t for s, t in bars if s == symbol}
        first, last, run = min(times), max(times), []
        for t in range(first, last + 2 * step, step):
            if t <= last and t not in times:
                points.append((symbol, t))
                run.append(t)
            elif run:
                runs.append((symbol, run[0], run[-1], len(run)))
                run = []
    return runs, points


@pytest.mark.parametrize("layout", [Layout(), TINY, Layout(bucket_steps=7)])
def test_gaps_against_sets(spark, layout):
    """Holes within words and over whole words and chunks, bars off the grid and twice, times before 1970, one-bar series."""
    import random
    rng, step = random.Random(5), 5
    bars = [(s, off + step * k) for s, off, n, share in (("A", -3_001, 400, 0.8), ("B", 2, 900, 0.03), ("C", 17, 300, 1.0), ("D", 0, 1, 1.0))
            for k in range(n) if rng.random() < share]
    bars += [("A", -3_001 + 5 * 420 + 2), ("C", 18), ("D", 0), ("B", 64 * 5 + 2), ("B", 64 * 5 + 2)]
    df = spark.createDataFrame(bars, ["symbol", "m"]).select("symbol", F.timestamp_micros(F.col("m") * 60_000_000).alias("ts"))
    minute = lambda c: (F.unix_micros(c) / 60_000_000).cast("long").alias(c)
    runs, points = _gaps_by_hand(bars, step)
    got = find_time_gaps(df, "5m", layout=layout).select("symbol", minute("gap_start"), minute("gap_end"), "missing_count")
    assert sorted(map(tuple, got.collect())) == runs
    got = grid_missing(df, "5m", chunk=128, layout=layout).select("symbol", minute("ts"))
    assert sorted(map(tuple, got.collect())) == points
    none = df.where("false")
    assert find_time_gaps(none, "5m").count() == grid_missing(none, "5m").count() == check_gaps(none, "5m", ts="ts").count() == 0


def test_gap_plans_are_dealt_by_chunk(spark):
    """Bars move once, by symbol and chunk; present points become no rows of a grid."""
    df = _times(spark, ["00:00", "00:05", "00:20"])
    runs = find_time_gaps(df, "5m")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in runs
    joins = [line for line in runs.splitlines() if "Join " in line]
    assert joins and all("chunk" in line for line in joins)
    grid = grid_missing(df, "5m")._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in grid and "LeftAnti" not in grid
    joins = [line for line in grid.splitlines() if "Join " in line]
    assert joins and all("chunk" in line or "word" in line for line in joins)


def _grid(spark, n_sym, n):
    pdf = pd.DataFrame([(f"S{s}", pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i), float(i))
                        for s in range(n_sym) for i in range(n)], columns=["symbol", "ts", "x"])
    return spark.createDataFrame(pdf)


def test_time_split(spark):
    df = _grid(spark, 1, 100)
    out = split_time(df, 100).toPandas()
    assert out["split"].value_counts().to_dict() == {"train": 70, "valid": 15, "test": 15}
    two = _grid(spark, 2, 50)
    o2 = split_time(two, 100).toPandas()
    assert len(o2) == 100 and not o2.duplicated(["symbol", "ts"]).any()
    assert o2["split"].value_counts().to_dict() == {"train": 70, "valid": 15, "test": 15}
    assert o2[o2.split == "train"].ts.max() <= o2[o2.split == "valid"].ts.min()
    assert o2[o2.split == "valid"].ts.max() <= o2[o2.split == "test"].ts.min()


def test_random_split(spark):
    df = _grid(spark, 1, 100)
    out = split_random(df, 100, random_state=42).toPandas()
    assert out["split"].value_counts().to_dict() == {"train": 69, "valid": 15, "test": 16}
    again = split_random(df.repartition(5), 100, random_state=42).toPandas()
    m = out.merge(again, on=["symbol", "ts"])
    assert (m.split_x == m.split_y).all()
    seq = split_random(df, 100, shuffle=False).toPandas().sort_values("ts")
    assert seq["split"].tolist() == ["train"] * 69 + ["valid"] * 15 + ["test"] * 16


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0, "train"), (2.0, 5.0, "train"), (3.0, 5.0, "train"), (10.0, 7.0, "test")],
                               ["x", "c", "split"])
    p = fit_scaler(df, ["x", "c"], F.col("split") == "train").first()
    assert abs(p["x__mean"] - 2.0) < 1e-12 and abs(p["x__scale"] - 0.816496580927726) < 1e-12
    assert p["c__scale"] == 1.0
    out = apply_scaler_values(df, fit_scaler(df, ["x", "c"], F.col("split") == "train").first().asDict(), ["x", "c"]).collect()
    assert out[3]["c"] == 2.0


def test_union_common(spark):
    a = spark.createDataFrame([(1, 2, 3)], ["a", "b", "target_x"])
    b = spark.createDataFrame([(4, 5, 6, 7)], ["b", "a", "c", "target_x"])
    out = concat_intersection([a, b])
    assert out.columns == ["a", "b", "target_x"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, 3), (5, 4, 7)]
    assert concat_intersection([b]).columns == ["b", "a", "c", "target_x"]


def _page(rows):
    import json
    return json.dumps([[ms, "1.0", "2.0", "0.5", "1.5", "10", ms + 59999, "15", 3, "4", "6", "0"] for ms in rows])


def test_kline_pages(spark, tmp_path):
    root = tmp_path / "pages"
    d = root / "symbol=btcusdt"
    d.mkdir(parents=True)
    t0 = 1704067200000  # 2024-01-01T00:00:00Z
    (d / "p0001.json").write_text(_page([t0, t0 + 60000]))
    (d / "p0002.json").write_text(_page([t0 + 60000, t0 + 120000, t0 + 180000]))
    (d / "p0003.json").write_text("[]")
    end = datetime(2024, 1, 1, 0, 3)
    out = read_kline_pages(spark, str(root), end=F.lit(end).cast("timestamp")).orderBy("open_time").collect()
    assert [r.symbol for r in out] == ["BTCUSDT"] * 3
    assert len({r.open_time for r in out}) == 3
    assert out[0].trades == 3 and out[0].close == 1.5
    bad = tmp_path / "bad" / "symbol=x"
    bad.mkdir(parents=True)
    (bad / "p.json").write_text('{"code": -1121, "msg": "Invalid symbol."}')
    with pytest.raises(Exception):
        read_kline_pages(spark, str(tmp_path / "bad")).collect()


def _split_by_sorting(rows, cuts):
    """Number of rows per (row, part) when rows are sorted as the split sorts them; equal rows have no order."""
    order = sorted(rows, key=lambda r: (r[1] is None, r[1], r[0] is None, r[0] or ""))
    parts = ["train"] * cuts[0] + ["valid"] * (cuts[1] - cuts[0]) + ["test"] * (len(rows) - cuts[1])
    return Counter((r[0], r[1], part) for r, part in zip(order, parts))


@pytest.mark.parametrize("case", ["one time", "no times", "copies", "two cuts in one row", "no symbols", "spread"])
def test_time_split_of_ties(spark, case):
    """Cuts inside one time, inside the rows without a time and inside copies of one row."""
    t = lambda i: datetime(2024, 1, 1 + i // 24, i % 24)
    rows = {
        "one time": [(f"S{i:03d}", t(5)) for i in range(60)] + [(f"S{i:03d}", t(i % 24)) for i in range(40)],
        "no times": [(f"S{i % 30:03d}", None) for i in range(90)] + [("S000", t(1))] * 3,
        "copies": [("A", t(1))] * 30 + [("A", t(2))] * 50 + [("B", t(2))] * 20,
        "two cuts in one row": [("A", t(2))] * 100 + [("A", t(1))],
        "no symbols": [(None, t(i % 3)) for i in range(40)] + [("Z", t(i % 3)) for i in range(33)],
        "spread": [(f"S{i % 7}", t(i)) for i in range(101)],
    }[case]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz").repartition(5)
    n = len(rows)
    got = Counter(tuple(r) for r in split_time(df, n).select("symbol", "ts", "split").collect())
    a, v, _ = time_split_sizes(n, 0.7, 0.15)
    assert got == _split_by_sorting(rows, (a, a + v))
    random = Counter(r.split for r in split_random(df, n).select("split").collect())
    assert (random["train"], random["valid"], random["test"]) == random_split_sizes(n, 0.7, 0.15)


def test_tied_rows_are_not_ranked(spark):
    """Rows without a time go to parts by their hashes: no window over rows, and the order of input does not matter."""
    df = spark.range(1000).select(F.lit("A").alias("symbol"), F.lit(None).cast("timestamp").alias("ts"), (F.col("id") * 1.5).alias("x"))
    out = split_time(df, 1000)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(r.split for r in out.collect()) == {"train": 700, "valid": 150, "test": 150}
    assert sorted(map(tuple, split_time(df.repartition(7, "x"), 1000).collect())) == sorted(map(tuple, out.collect()))
    empty = df.where("false")
    assert split_time(empty, 0).count() == split_random(empty, 0).count() == 0
    assert Counter(r.split for r in split_time(df, 1000, whole_timestamps=True).collect()) == {"train": 1000}
