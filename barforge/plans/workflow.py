"""End-to-end chain over landed data: ingest pages -> gap report -> raw sink
-> features for all symbols in one job -> feature sink -> ML dataset."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession

from barforge.config import Layout, WindowsConfig
from barforge.operators.gaps import check_gaps, first_gaps
from barforge.plans.dataset import get_ml_datasets
from barforge.plans.features import build_features
from barforge.session import scratch_path
from barforge.sources.files import save_features, save_raw
from barforge.sources.klines import read_kline_pages
from barforge.sources.scan import fetch_window


def ingest(spark: SparkSession, pages_root: str, symbols: list[str] | None = None, interval: str = "1m",
           days: int | None = None, start: str | None = None, end: str | None = None, pages_whole_files: bool = True):
    """Landed candles of ``symbols`` (all, if None) in the window that
    ``days`` or ``start`` and ``end`` give, both as in ``resolve_window``."""
    raw = read_kline_pages(spark, pages_root, whole_files=pages_whole_files)
    return fetch_window(raw, symbols, days, start, end, interval)


def get_raw_dataset(spark: SparkSession, pages_root: str, out_dir: str, interval: str = "1m",
                    start=None, end=None, file_format: str = "csv", layout: Layout | None = None,
                    pages_whole_files: bool = True):
    """Ingest landed pages into the raw sink, then report the first 20 gaps.
    The pages are read once, by the sink; all else reads what it wrote.
    Returns (raw DataFrame, manifest), or None with a warning if there are no candles."""
    raw = read_kline_pages(spark, pages_root, start, end, whole_files=pages_whole_files)
    written = scratch_path(spark, "ingested")
    raw.write.parquet(written)
    raw = spark.read.schema(raw.schema).parquet(written)
    if raw.isEmpty():
        warnings.warn(f"no candles under {pages_root} in the window asked for", stacklevel=2)
        return None
    gaps = first_gaps(check_gaps(raw, interval, layout=layout), 20, ("symbol", "gap_before")).collect()
    if gaps:
        print("candles are missing after these times (outages or late listings):")
        for g in gaps:
            print(f"  {g['symbol']} {g['gap_before']} {g['missing_candles']}")
    man = save_raw(raw, out_dir, file_format, interval)
    return raw, man


def run_chain(spark: SparkSession, pages_root: str, raw_dir: str, features_dir: str,
              interval: str = "1m", file_format: str = "parquet", layout: Layout | None = None,
              pages_whole_files: bool = True):
    """PIPE-1 as one multi-symbol job per stage.  Returns (dataset, meta)."""
    got = get_raw_dataset(spark, pages_root, raw_dir, interval, file_format=file_format, layout=layout,
                          pages_whole_files=pages_whole_files)
    if got is None:
        return None
    raw, _ = got
    feats, fcols, tcols = build_features(raw, WindowsConfig(), (1, 5, 15), "binclass", 0.0,
                                         log_gaps=True, interval=interval, layout=layout, raw=True)
    path = save_features(feats.select(*fcols, *tcols), f"{features_dir.rstrip('/')}/features.parquet", "parquet")
    return get_ml_datasets(spark, features_dir, split_mode="time", scale=True, verbose=True)
