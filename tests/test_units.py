"""Hand goldens (FIXTURES.md section 3) for the row-level operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barforge.config import WindowsConfig
from barforge.functions.intervals import infer_step, parse_time, resolve_window
from barforge.operators.clean import prepare_bars
from barforge.operators.split import random_split_sizes, time_split_sizes
from barforge.sources.files import gather_input_files, load_and_prepare
from barforge.sources.klines import read_kline_pages


def test_interval_table():
    cases = {"1m": timedelta(minutes=1), "15m": timedelta(minutes=15), "4h": timedelta(hours=4),
             "1d": timedelta(days=1), "5minute": timedelta(minutes=5), "7h": timedelta(hours=7)}
    for k, v in cases.items():
        assert infer_step(k) == v
    with pytest.warns(UserWarning):
        assert infer_step("x") == timedelta(minutes=5)


def test_parse_time_relative_and_window():
    now = datetime(2024, 1, 10, tzinfo=__import__("datetime").timezone.utc)
    assert parse_time("2d", now) == now - timedelta(days=2)
    assert parse_time("3h", now) == now - timedelta(hours=3)
    s, e = resolve_window(end="2024-01-08", now=now)
    assert e - s == timedelta(days=7)
    with pytest.raises(ValueError):
        resolve_window(days=1, start="2024-01-01", now=now)
    with pytest.raises(ValueError):
        resolve_window(days=1, interval="2h", now=now)


def test_split_sizes():
    assert time_split_sizes(100, 0.7, 0.15) == (70, 15, 15)
    assert random_split_sizes(100, 0.7, 0.15) == (69, 15, 16)
    with pytest.raises(ValueError):
        random_split_sizes(100, 0.8, 0.3)


def _raw(spark, data):
    cols = ["symbol", "open_time", "open", "high", "low", "close", "volume", "close_time"]
    return spark.createDataFrame(data, cols)


def test_envelope_coerce_dedup(spark):
    data = [
        ("A", "2024-01-01 00:00:00", "10", "9", "11", "10.5", "1", "2024-01-01 00:04:59"),
        ("A", "2024-01-01 00:05:00", "10", None, "9", "10", "abc", "2024-01-01 00:09:59"),
        ("A", "2024-01-01 00:10:00", "10", "12", "9", "bad", "1", "2024-01-01 00:14:59"),
        ("A", "not a time", "10", "12", "9", "10", "1", "2024-01-01 00:14:59"),
        ("A", "2024-01-01 00:15:00", "10", "12", "9", "10", "", "2024-01-01 00:19:59"),
        ("A", "2024-01-01 00:15:00", "10", "13", "9", "11", "2", "2024-01-01 00:19:59.500"),
    ]
    out = {r["ts"].strftime("%H:%M"): r for r in prepare_bars(_raw(spark, data)).collect()}
    assert sorted(out) == ["00:00", "00:05", "00:15"]
    assert (out["00:00"]["high"], out["00:00"]["low"]) == (11.0, 10.0)
    assert out["00:05"]["high"] is None and out["00:05"]["low"] == 9.0
    assert out["00:05"]["volume"] is None
    assert out["00:15"]["close"] == 11.0  # later close_time wins


def test_expected_symbol(spark):
    df = _raw(spark, [("A", "2024-01-01 00:00:00", "1", "1", "1", "1", "1", "2024-01-01 00:00:59")])
    with pytest.raises(ValueError):
        prepare_bars(df, expected_symbol="B")
    assert prepare_bars(df, expected_symbol="A").count() == 1


def test_other_time_texts_and_ingest_window(spark, tmp_path):
    from barforge.plans.workflow import ingest
    from barforge.sources.fixtures import hourly_bars
    from barforge.sources.klines import read_kline_pages, write_kline_pages
    utc = __import__("datetime").timezone.utc
    assert parse_time("2024/01/01") == parse_time("2024-01-01T00:00:00Z") == datetime(2024, 1, 1, tzinfo=utc)
    assert parse_time("2024-01-01T02:00:00+02:00") == datetime(2024, 1, 1, tzinfo=utc) and parse_time(None) is None
    with pytest.raises(ValueError):
        parse_time("soon")
    pages = str(tmp_path / "pages")
    bars = hourly_bars(spark, "/root/testdata/sf0.001")
    write_kline_pages(bars, pages, interval="1h")
    lo, mid = (str(x) for x in bars.agg(F.min("open_time"), F.percentile_approx("open_time", 0.5)).first())
    got = ingest(spark, pages, ["view"], interval="1h", start=lo, end=mid, pages_whole_files=False)
    want = bars.filter((F.col("symbol") == "view") & (F.col("open_time") < F.lit(mid).cast("timestamp_ntz"))).count()
    assert 0 < got.count() == want
    broken = tmp_path / "broken" / "symbol=AAA"
    broken.mkdir(parents=True)
    (broken / "p.txt").write_text('[["1","2"')
    with pytest.raises(Exception, match="not a JSON array"):
        read_kline_pages(spark, str(tmp_path / "broken")).collect()
    good = tmp_path / "good" / "symbol=00700"
    good.mkdir(parents=True)
    (good / "p.txt").write_text("[]")
    assert dict(read_kline_pages(spark, str(tmp_path / "good")).dtypes)["symbol"] == "string"


def test_csv_files_of_other_headers_fail(spark, tmp_path):
    from barforge.sources.files import read_any
    (tmp_path / "a.csv").write_text("symbol,open_time,close\nA,2024-01-01,1\n")
    (tmp_path / "b.csv").write_text("open_time,symbol,close\n2024-01-02,A,1\n")
    with pytest.raises(Exception):
        read_any(spark, str(tmp_path), "csv").collect()


def test_trades_with_holes(spark):
    data = [("A", "2024-01-01 00:00:00", "1", "1", "1", "1", "1", "2024-01-01 00:04:59", "5.0"),
            ("A", "2024-01-01 00:05:00", "1", "1", "1", "1", "1", "2024-01-01 00:09:59", None)]
    df = spark.createDataFrame(data, ["symbol", "open_time", "open", "high", "low", "close", "volume", "close_time", "trades"])
    assert sorted(r["trades"] or 0 for r in prepare_bars(df).collect()) == [0, 5]


def test_last_page_of_a_split_file_wins(spark, tmp_path):
    """Pages in one file that several tasks read: the place in the file decides, not the task."""
    t0, minute = 1704067200000, 60_000
    folder = tmp_path / "pages" / "symbol=A"
    folder.mkdir(parents=True)
    line = lambda close, first: "[" + ",".join(
        f'["{t0 + i * minute}","1","9","0.5","{close}","1","{t0 + (i + 1) * minute - 1}","1","1","1","1","0"]' for i in range(first, first + 3)) + "]"
    pages = [(close, first) for close in range(1, 9) for first in (0, 2, 4)]
    (folder / "p.json").write_text("\n".join(line(*p) for p in pages))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        got = read_kline_pages(spark, str(tmp_path / "pages"), whole_files=False).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 7 and {r.close for r in got} == {8.0}


def test_csv_files_with_other_headers(spark, tmp_path):
    head = "symbol,open_time,open,high,low,close,volume,close_time"
    (tmp_path / "a b.csv").write_text(head + "\nA,2024-01-01 00:00:00,1,2,0.5,1.5,7,2024-01-01 00:00:59\n")
    swapped = ",".join(reversed(head.split(",")))
    (tmp_path / "c.csv").write_text(swapped + ",trades\n2024-01-01 00:01:59,8,2.5,1.0,3,2,2024-01-01 00:01:00,A,4\n")
    (tmp_path / "d.csv").write_text(swapped + ",trades\n")
    (tmp_path / "e.csv").write_text("")
    got = load_and_prepare(spark, str(tmp_path), fmt="csv", mixed_headers=True).orderBy("ts").collect()
    assert [(r.close, r.volume, r.trades) for r in got] == [(1.5, 7.0, None), (2.5, 8.0, 4)]
    with pytest.raises(Exception):
        load_and_prepare(spark, str(tmp_path), fmt="csv").collect()


def test_feature_files_are_found(spark, tmp_path):
    for name in ("b.csv", "a.parquet", "notes.txt"):
        (tmp_path / name).write_text("x")
    assert [p.rsplit("/", 1)[1] for p in gather_input_files(spark, str(tmp_path))] == ["a.parquet", "b.csv"]
    assert gather_input_files(spark, ("x", "y")) == ["x", "y"]
    assert gather_input_files(spark, str(tmp_path / "b.csv")) == [str(tmp_path / "b.csv")]
    (tmp_path / "empty").mkdir()
    for bad in ("absent", "empty"):
        with pytest.raises(FileNotFoundError):
            gather_input_files(spark, str(tmp_path / bad))


def test_warmup_rows():
    assert WindowsConfig().warmup_rows() == 72
    assert WindowsConfig(ma=(), vol=(), vol_feat=(), macd_signal=500).warmup_rows() == 26
