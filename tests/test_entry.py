"""Driver contract, plan shape, and a few oracle checks at sf0.001."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from barforge.registry import QUERIES
from datasets import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry_runs(spark):
    df = E.entry(spark)
    pdf = df.toPandas()
    assert len(pdf) > 0
    assert "target_up_15" in pdf.columns and "macd_signal_9" in pdf.columns


def test_registry_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def _norm(df):
    df = df[sorted(df.columns)].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", ["clean_dedup", "all_features", "gap_ranges", "gap_grid_antijoin",
                                  "target_multiclass", "split_time", "scaler_fit", "split_random", "rsi_long_run", "symbolless_features", "ts_parse"])
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = E.queries()[name](spark, SF001).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    for d in (got, exp):
        for c in d.columns:
            if str(d[c].dtype).startswith("datetime"):
                d[c] = pd.to_datetime(d[c]).astype(str)
    assert sorted(got.columns) == sorted(exp.columns)
    a, b = _norm(got), _norm(exp)
    assert len(a) == len(b)
    assert (a.values == b.values).all()


def test_plan_single_exchange_no_python(spark):
    from barforge.operators.clean import prepare_rows
    from barforge.operators.indicators import _window_columns
    from barforge.operators.series import SeriesPlan
    from barforge.config import WindowsConfig
    from barforge.sources.fixtures import supplier_bars
    rows = prepare_rows(supplier_bars(spark, SF001))
    plan = SeriesPlan(rows, back=72, ahead=15)
    d = _window_columns(plan.blocks(), WindowsConfig(), plan.window, (1, 5, 15), "binclass", 0.0)
    text = d._jdf.queryExecution().executedPlan().toString()
    # one exchange by block for every window of the rolling branch
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, _blk#", text)) == 1
    # rows are dealt by bucket once, and once more (two columns) to count them
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, _tb#", text)) <= 2
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text
    assert "SinglePartition" not in text
