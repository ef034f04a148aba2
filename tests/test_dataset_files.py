"""Wide datasets lie in files while they are cut and scaled; the scaler's moments come from parts."""

import math
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.operators.scale import fit_scaler
from barforge.operators.split import find_cuts
from barforge.plans import dataset


def _wide(spark, holes=False, empty=False):
    rows = [("A", datetime(2024, 1, 1) + timedelta(hours=h), *(None if holes and i < 2 and h % 9 == i else float(h % 7 + i) for i in range(30)), h % 2) for h in range(60)]
    names = [f"x {i}" if i == 3 else f"x{i}" for i in range(30)]
    frame = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, " + ", ".join(f"`{n}` double" for n in names) + ", target_up_1 long")
    return frame.withColumn("none", F.lit(None).cast("double")) if empty else frame


@pytest.mark.filterwarnings("ignore:all-NULL")
@pytest.mark.parametrize("holes, empty", [(False, False), (True, False), (True, True)])
def test_wide_dataset_is_kept_in_files(spark, monkeypatch, holes, empty):
    frame = _wide(spark, holes, empty)
    features = [c for c in frame.columns if c.startswith("x")]
    want, _ = dataset.get_ml_datasets(spark, None, frames=[frame], feature_cols=features, verbose=False)
    want = sorted(map(tuple, want.collect()))
    assert len(want) == (46 if holes else 60)
    monkeypatch.setattr(dataset, "persist", lambda d: pytest.fail("a wide frame was cached"))
    out, meta = dataset.get_ml_datasets(spark, None, frames=[frame], verbose=False)
    assert meta["feature_cols"] == features and sorted(map(tuple, out.collect())) == want


def test_cuts_of_wide_data_read_few_columns(spark):
    data, _, _ = dataset.ml_frame([_wide(spark)])
    text = data.select("ts").where("ts IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    assert len(re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1).split(",")) == 2  # the time and whether the row is complete


def test_scaler_is_fitted_over_parts_and_holes(spark):
    rng = np.random.default_rng(5)
    x = [(float(v), None if i % 3 else float(v) * 10 + 1e6, 0.1, None, i) for i, v in enumerate(rng.normal(1e6, 1e-2, 1000))]
    frame = spark.createDataFrame(x, "a double, b double, c double, d double, e int")
    for parts in (1, 7):
        got = fit_scaler(frame.repartition(parts), list("abcde"), F.col("e") < 900).first()
        a, b, e = ([r[i] for r in x[:900] if r[i] is not None] for i in (0, 1, 4))
        assert got.n == 900 and (got.c__mean, got.c__scale, got.d__mean, got.d__scale) == (0.1, 1.0, None, None)
        for name, v in (("a", a), ("b", b), ("e", e)):
            assert got[f"{name}__mean"] == pytest.approx(math.fsum(v) / len(v), rel=1e-14)
            mean = math.fsum(v) / len(v)
            assert got[f"{name}__scale"] == pytest.approx(math.sqrt(math.fsum((y - mean) ** 2 for y in v) / len(v)), rel=1e-7)
    none = fit_scaler(frame, ["a"], F.col("e") < 0).first()
    assert (none.n, none.a__mean, none.a__scale) == (0, None, None)


def test_both_cuts_count_their_rows_at_once(spark):
    frame = spark.createDataFrame([(i // 7,) for i in range(700)], "k long")
    levels = [F.floor(F.col("k") / 10), F.col("k")]
    cuts = find_cuts(frame, levels, (70, 333))
    assert [(c.before, c.at) for c in cuts] == [(70, (1,)), (329, (4, 47))]
