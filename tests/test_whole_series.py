"""Series known to fit one block, and shuffles that go with their action."""

import math
import re
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barforge import registry
from barforge.config import Layout
from barforge.operators.clean import dedup_order, keep_valid
from barforge.operators.indicators import add_all_features
from barforge.session import release_cached, shuffles_removed
from barforge.sources.fixtures import supplier_bars, supplier_lines
from test_arrow_steps import NUMBERS, _bars


def _same(columns, want, got):
    assert got.keys() == want.keys()
    for key, row in want.items():
        for name, x, y in zip(columns, row, got[key]):
            assert (x is None) == (y is None), (key, name)
            assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) if isinstance(x, float) else x == y, (key, name)


def _features(bars, **options):
    out = add_all_features(bars, interval="1h", horizons=(1, 5), **options)
    rows = {(r.symbol, r.ts): tuple(r) for r in out.collect()}
    release_cached()
    return out, rows


@pytest.mark.parametrize("trim", [False, True])
def test_series_of_one_block_give_the_same_features(spark, trim):
    bars = _bars(spark, {"A": 260, None: 90, "B": 1, "C": 3, "D": 96})
    copies = bars.unionByName(bars.where("symbol = 'A'").withColumn("volume", F.lit(None).cast("double"))).unionByName(
        bars.where("symbol = 'C'").withColumn("close", F.lit(None).cast("double")).withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 HOURS")))
    options = dict(trim_warmup=trim, dedup_order=dedup_order(bars.columns), keep=keep_valid(), close_known=True)
    was, want = _features(copies, **options)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        out, got = _features(copies, longest=300, **options)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out.columns == was.columns and out.dtypes == was.dtypes and len(want) == (183 + 13 + 19 if trim else 255 + 85 + 91)
    _same(out.columns, want, got)


def test_series_of_one_block_are_dealt_once(spark):
    out = add_all_features(_bars(spark, {"A": 100}), interval="1h", close_known=True, longest=100)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange", text)) == 1 and "InMemory" not in text and "Join" not in text


def test_longer_series_keep_their_blocks(spark):
    bars = _bars(spark, {"A": 260, "D": 96})
    layout = Layout(block_rows=128, bucket_steps=50, ewm_block=32)
    out, want = _features(bars, trim_warmup=False, close_known=True)
    _, got = _features(bars, trim_warmup=False, close_known=True, layout=layout, longest=260)
    _same(out.columns, want, got)


def _lines(spark, path):
    """Suppliers with several lines a day, one without a number, and lines without a date."""
    day, rows = datetime(1996, 1, 1), []
    for i in range(400):
        rows.append((i % 37, i % 5, None if i % 7 == 6 else i % 7, i % 4, 2.0, 2.0 * (i * 7 % 31 + 1), "NRA"[i % 3], None if i % 50 == 9 else day + timedelta(days=i % 6)))
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_returnflag string, l_shipdate timestamp_ntz").repartition(3).write.parquet(f"{path}/lineitem.parquet")
    return rows


def test_bars_of_whole_suppliers(spark, tmp_path):
    rows = _lines(spark, tmp_path)
    lines, most = supplier_lines(spark, str(tmp_path))
    assert (lines, most) == (400, 58)
    want = {}
    for o, p, s, n, q, e, f, t in sorted(rows, key=lambda r: (r[0], r[3], r[1], r[5])):
        want.setdefault((None if s is None else f"S0000{s}", t), []).append((e / q, q, e, f == "N"))
    want = {k: (v[0][0], max(x[0] for x in v), min(x[0] for x in v), v[-1][0], sum(x[1] for x in v), sum(x[2] for x in v), len(v),
                sum(x[1] for x in v if x[3]), sum(x[2] for x in v if x[3])) for k, v in want.items()}
    for dealt in (None, lines):
        bars = supplier_bars(spark, str(tmp_path), dealt)
        assert {(r.symbol, r.open_time): tuple(r[c] for c in NUMBERS) for r in bars.collect()} == want
    assert "min_by" not in supplier_bars(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_features_of_suppliers_deal_their_lines_once(spark, tmp_path):
    _lines(spark, tmp_path)
    out = registry.sb_features(spark, str(tmp_path))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange", text)) == 1 and "InMemoryTableScan" not in text
    release_cached()


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle_")}


def test_shuffles_go_with_their_action(spark, tmp_path):
    before, key = _shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with shuffles_removed(spark):
        frame = spark.range(1000).repartition(4, "id")
        frame.write.parquet(f"{tmp_path}/out")
    assert spark.conf.get(key, None) == was
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert frame.count() == spark.read.parquet(f"{tmp_path}/out").count() == 1000
