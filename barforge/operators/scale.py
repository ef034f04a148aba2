"""Standardisation with training statistics only.

Mean and population standard deviation of every feature over the training
rows (one pass, one output row), applied to all rows.  The moments of a partition's
batches are found by numpy and merged like those of ``barforge.operators.moments``: nothing cancels.  A feature whose
variance is within floating-point noise of zero is divided by 1 instead
(the rule of the common ``StandardScaler``: var <= n*eps*var + (n*mean*eps)^2).
The one-row parameter table has a fixed size, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 2.220446049250313e-16  # float64 machine epsilon
#: Rows of a part, and of each column its values that are not NULL, their mean, and the sum of their squared distances from it.
PART = "n long, held array<double>, mean array<double>, squares array<double>"


def _moments(batch: pa.RecordBatch) -> tuple:
    held, mean, squares = (np.zeros(batch.num_columns) for _ in range(3))
    with np.errstate(all="ignore"):
        for i, column in enumerate(batch.columns):
            x = column.drop_null().to_numpy(zero_copy_only=False)
            if len(x):
                first = x[0] if np.isfinite(x[0]) else 0.0
                held[i], mean[i] = len(x), first + (x - first).mean()
                squares[i] = ((x - mean[i]) ** 2).sum()
    return batch.num_rows, held, mean, squares


def _merged(parts: list[tuple], width: int) -> tuple:
    if not parts:
        return 0, *(np.zeros(width) for _ in range(3))
    n, held, mean, squares = sum(p[0] for p in parts), *(np.array([p[i] for p in parts]).reshape(len(parts), width) for i in (1, 2, 3))
    total = held.sum(axis=0)
    with np.errstate(all="ignore"):
        # parts without a value have no mean; equal means stay what they are
        base = mean[np.argmax(held > 0, axis=0), np.arange(width)] if width else np.zeros(0)
        base = np.where(np.isfinite(base), base, 0.0)
        merged = base + np.where(held > 0, (mean - base) * held, 0.0).sum(axis=0) / np.maximum(total, 1.0)
        return n, total, merged, np.where(held > 0, squares + held * (mean - merged) ** 2, 0.0).sum(axis=0)


def _row(part: tuple) -> pa.RecordBatch:
    lists = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in part[1:]]
    return pa.RecordBatch.from_arrays([pa.array([part[0]], pa.int64()), *lists], names=["n", "held", "mean", "squares"])


def fit_scaler(df: DataFrame, features: list[str], train_filter=None) -> DataFrame:
    """One row: ``<f>__mean``, ``<f>__scale`` per feature, and ``n``."""
    src = df.filter(train_filter) if train_filter is not None else df
    width = len(features)

    def of_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _row(_merged([_moments(b) for b in batches if b.num_rows], width))

    def of_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for parts in b.column(0).to_pylist():
                yield _row(_merged([(p["n"], p["held"], p["mean"], p["squares"]) for p in parts], width))

    parts = src.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)]).mapInArrow(of_partition, PART)
    # one row of every partition
    p = parts.agg(F.collect_list(F.struct("n", "held", "mean", "squares")).alias("parts")).mapInArrow(of_all, PART)
    n = F.col("n").cast("double")
    out = [F.col("n")]
    for i, c in enumerate(features):
        some = F.col("held")[i] > 0
        m, v = F.when(some, F.col("mean")[i]), F.when(some, F.col("squares")[i] / F.col("held")[i])
        const = v <= (n * F.lit(EPS) * v + F.pow(n * m * F.lit(EPS), 2))
        out += [m.alias(f"{c}__mean"),
                F.when(v.isNull(), F.lit(None)).when(const, F.lit(1.0)).otherwise(F.sqrt(v)).alias(f"{c}__scale")]
    return p.select(*out)


def apply_scaler_values(df: DataFrame, params: dict, features: list[str]) -> DataFrame:
    """Apply fitted parameters given as driver-side numbers (two per
    feature, so the size is fixed): plain projections, no join."""
    def lit(v):
        return "CAST(NULL AS DOUBLE)" if v is None else repr(float(v))
    cols = []
    for c in df.columns:
        if c in features:
            cols.append(f"(CAST(`{c}` AS DOUBLE) - {lit(params[c + '__mean'])}) / {lit(params[c + '__scale'])} AS `{c}`")
        else:
            cols.append(f"`{c}`")
    return df.selectExpr(*cols)


def scale_if_needed(df: DataFrame, features: list[str], enable: bool = True,
                    train_filter=None) -> tuple[DataFrame, dict | None]:
    """Fit once (one aggregate, one row brought to the driver) and apply the
    numbers as literals."""
    if not enable:
        return df, None
    row = fit_scaler(df, features, train_filter).first()
    params = row.asDict() if row is not None else {}
    return apply_scaler_values(df, params, features), params
