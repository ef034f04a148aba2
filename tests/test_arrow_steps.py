"""The numpy steps of the features: one pass over the laid out rows, whatever the batches and blocks."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest

from barforge.config import Layout
from barforge.operators.arrow import AT, add_doubles
from barforge.operators.indicators import add_all_features
from barforge.session import release_cached
from barforge.sources.fixtures import supplier_bars

NUMBERS = ["open", "high", "low", "close", "volume", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote"]


def _bars(spark, lengths, seed=3):
    """Random bars with holes in high, low, volume and trades."""
    rng, rows = random.Random(seed), []
    for symbol, n in lengths.items():
        close = 50.0
        for i in range(n):
            close *= math.exp(rng.gauss(0, 0.01))
            some = [None if rng.random() < 0.05 else rng.uniform(1, 9) for _ in range(3)]
            rows.append((symbol, datetime(2024, 1, 1) + timedelta(hours=i), close, some[0] and close + some[0], some[0] and close - some[0], close,
                         some[1], some[2], rng.uniform(1, 9), None if rng.random() < 0.05 else float(i % 5), 1.0, 2.0))
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double, extra double, "
                                       "quote_volume double, trades double, taker_buy_base double, taker_buy_quote double")


def test_features_do_not_depend_on_batches_and_blocks(spark):
    """State goes on over batches within a block, and over blocks."""
    bars = _bars(spark, {"A": 260, None: 90, "B": 1, "C": 3, "D": 96}).localCheckpoint()

    def features(layout, rows_per_batch):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
        try:
            out = add_all_features(bars, interval="1h", horizons=(1, 5), trim_warmup=False, layout=layout, close_known=True)
            return out.columns, {(r.symbol, r.ts): tuple(r) for r in out.collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            release_cached()

    columns, want = features(Layout(), 10_000)
    assert len(want) == 255 + 85 + 91
    for layout, size in ((Layout(), 7), (Layout(block_rows=96, bucket_steps=50, ewm_block=32), 10)):
        _, got = features(layout, size)
        assert got.keys() == want.keys()
        for key, row in want.items():
            for name, x, y in zip(columns, row, got[key]):
                assert (x is None) == (y is None), (key, name)
                if isinstance(x, float):
                    assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (key, name)
                else:
                    assert x == y, (key, name)


def test_features_take_one_pass_after_their_windows(spark):
    """Recursive and rolling means add no window over the rows; the kept columns of the layout are the one thing read twice."""
    out = add_all_features(_bars(spark, {"A": 100}), interval="1h", close_known=True)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    rows, _, _ = text.partition("InMemoryRelation")
    release_cached()
    assert len(re.findall(r"MapInArrow", rows)) == 1
    assert len(re.findall(r"(?m)^\W*Window ", rows)) <= 2


def test_rows_out_of_order_are_refused(spark):
    rows = spark.createDataFrame([(1, 0.5), (3, 0.5)], f"{AT} int, x double").coalesce(1)

    def same(batches):
        for b, _ in batches:
            yield []
    with pytest.raises(Exception, match="not in the order"):
        add_doubles(rows, [([], same)]).collect()


def test_bars_of_lines(spark, tmp_path):
    """One bar for every supplier and day, opened and closed by its first and last line."""
    day = datetime(1996, 1, 1)
    lines = [(o, 1, s, n, 2.0, 2.0 * p, f, day + timedelta(days=d)) for o, s, n, p, f, d in (
        (3, 7, 1, 5.0, "N", 0), (1, 7, 2, 9.0, "R", 0), (1, 7, 1, 4.0, "R", 0), (2, 7, 1, 1.0, "N", 1), (2, 8, 1, 6.0, "R", 0), (4, None, 1, 6.0, None, 0))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r.symbol, r.open_time.day): (*(r[c] for c in NUMBERS),) for r in supplier_bars(spark, str(tmp_path)).collect()}
    assert got == {("S00007", 1): (4.0, 9.0, 4.0, 5.0, 6.0, 36.0, 3, 2.0, 10.0), ("S00007", 2): (1.0, 1.0, 1.0, 1.0, 2.0, 2.0, 1, 2.0, 2.0),
                   ("S00008", 1): (6.0, 6.0, 6.0, 6.0, 2.0, 12.0, 1, 0.0, 0.0), (None, 1): (6.0, 6.0, 6.0, 6.0, 2.0, 12.0, 1, 0.0, 0.0)}
