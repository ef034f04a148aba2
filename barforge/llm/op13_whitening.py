"""Operator 13: whitening of embeddings by QDWH spectral divide and conquer.

The covariance of the distinct vectors is summed in tasks, from centred vectors.  Its eigenvectors
are found by divide and conquer: the polar factor U of A - s*I, by the dynamically weighted
Halley iteration in its inverse-free QR form (QDWH), is the matrix sign, so (U + I) / 2 projects onto the
invariant subspace of the eigenvalues above s.  The subspace and its complement are split further
until single components are left.  Their matrix, of a size that the dimension fixes, is
broadcast, and every row is whitened in a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import stored, table

#: A component becomes an integer: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows that are worked on at a time, and eigenvalues under this share of the largest count as none.
ROWS, LEAST_SHARE = 2048, 1e-11
_EPS = np.finfo(float).eps


# ---- spectral divide and conquer -----------------------------------------------
def polar_factor(a: np.ndarray) -> np.ndarray:
    """U of the polar decomposition a = U H of a symmetric matrix, by QDWH.

    The weights follow from a lower bound of the least singular value; every step maps the
    bound towards 1 by the best rational function of its degree, in at most six or seven steps."""
    n = len(a)
    scale = np.linalg.norm(a)  # Frobenius: an upper bound of the largest singular value
    if not scale:
        return np.eye(n)
    x, eye = a / scale, np.eye(n)
    _, r = np.linalg.qr(x)
    diagonal = np.abs(np.diag(r))
    low = min(1.0, max(diagonal.min() / math.sqrt(n) / 4, _EPS / 8))
    for _ in range(60):
        d = (4 * (1 - low * low) / low ** 4) ** (1 / 3) if low < 1 else 0.0
        wa = math.sqrt(1 + d) + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * math.sqrt(1 + d))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate([math.sqrt(wc) * x, eye]))
        new = (wb / wc) * x + (wa - wb / wc) / math.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if abs(1 - low) < 10 * _EPS and moved < (10 * _EPS) ** (1 / 3) * math.sqrt(n):
            break
    return x


def _orthonormal(p: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal basis whose first ``rank`` columns span the range of the projector."""
    q, _ = np.linalg.qr(p @ rng.standard_normal((len(p), rank)))
    q, _ = np.linalg.qr(p @ q)
    rest = np.eye(len(p)) - p
    z, _ = np.linalg.qr(rest @ rng.standard_normal((len(p), len(p) - rank)))
    z, _ = np.linalg.qr(rest @ z)
    both, r = np.linalg.qr(np.concatenate([q, z], axis=1))
    return both * np.where(np.diag(r) < 0, -1, 1)


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of a symmetric matrix, and unit eigenvectors as columns."""
    a = (a + a.T) / 2
    norm, rng = np.linalg.norm(a), np.random.default_rng(13)
    vectors = np.zeros_like(a)
    values = np.zeros(len(a))
    rest = [(a, np.eye(len(a)), 0)]
    while rest:
        block, basis, at = rest.pop()
        n = len(block)
        spread = np.linalg.norm(block - np.diag(np.diag(block)))
        if n == 1 or spread <= 4 * _EPS * norm:  # diagonal: its axes are the components
            vectors[:, at:at + n], values[at:at + n] = basis, np.diag(block)
            continue
        split = _split(block, rng)
        if split is None:  # equal eigenvalues, to rounding: any basis will do
            vectors[:, at:at + n], values[at:at + n] = basis, np.diag(block)
            continue
        q, k = split
        turned = q.T @ block @ q
        for part, first in ((slice(0, k), at), (slice(k, n), at + k)):
            own = turned[part, part]
            rest.append(((own + own.T) / 2, basis @ q[:, part], first))
    vectors = _refined(a, vectors)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _split(block: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal matrix that splits the block's eigenvalues at a shift, and how many are above it."""
    n = len(block)
    diagonal, eye = np.diag(block), np.eye(n)
    middle = np.median(diagonal)
    # The median shares out best, the mean is always between the ends; others where these split nothing.
    bound = np.abs(block - np.diag(diagonal)).sum(1)
    low, high = float((diagonal - bound).min()), float((diagonal + bound).max())
    for shift in (middle, diagonal.mean(), *(low + (high - low) * t for t in (0.5, 0.25, 0.75, 0.125, 0.875))):
        projector = (polar_factor(block - shift * eye) + eye) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        for _ in range(3):
            q = _orthonormal(projector, k, rng)
            if np.linalg.norm(q[:, :k].T @ block @ q[:, k:]) <= 64 * n * _EPS * max(np.linalg.norm(block), abs(shift)):
                return q, k
    return None


def _refined(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Two steps of quadratically convergent refinement: what is left of the angles between the
    columns, and of a's entries between them, is taken out of the columns; then they are made orthonormal again."""
    for _ in range(2):
        gram, turned = x.T @ x, x.T @ a @ x
        residue = np.eye(len(a)) - gram
        values = np.diag(turned) / np.diag(gram)
        gap = values[None, :] - values[:, None]
        off = turned + values[None, :] * residue
        close = np.abs(gap) <= 1e3 * len(a) * _EPS * np.linalg.norm(a)
        step = np.where(close, residue / 2, off / np.where(close, 1, gap))
        np.fill_diagonal(step, np.diag(residue) / 2)
        x = x + x @ step
        for _ in range(3):
            x = x @ (3 * np.eye(len(a)) - x.T @ x) / 2
    return x


# ---- whitening ------------------------------------------------------------------
def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    x = np.floor(SCALE * vectors)
    if len(x) and np.abs(x).max() > 2.0 ** 52:
        raise ValueError("a component is too large for exact whole numbers")
    return x.astype(np.int64) + SHIFT


def _usable(column: str, size: int | None = None) -> Column:
    c = F.col(column)
    fine = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return fine & (F.size(c) == size) if size is not None else fine & (F.size(c) > 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _whole_vectors(size: int):
    """Rows as packed whole numbers, from arrays of doubles."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                x = whole_numbers(_matrix(part.column("v"), size))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "x"])
    return run


def _unpacked(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, size)


def _sums(size: int):
    """Exact sums, a row for each batch: the number of vectors and every dimension's sum."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = _unpacked(b.column("x"), size)
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int64()), "s": pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))})
    return run


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, whole numbers; refuses what 64 bits don't hold."""
    if float(n) * np.abs(x).max(initial=0) >= 2.0 ** 62:
        raise ValueError("too many vectors for exact 64-bit deviations")
    return n * x - sums


def _products(size: int, n: int, sums: np.ndarray, weights: np.ndarray | None = None):
    """A task's sum of products of the centred (or whitened) vectors: a row for each line of the matrix."""
    def run(batches):
        total = None
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                y = centred(_unpacked(b.column("x").slice(lo, ROWS), size), n, sums) / n
                y = y if weights is None else y @ weights
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["line", "v"])
    return run


def _matrix_sum(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' matrices, line by line in Spark; a matrix of the dimension comes to the driver."""
    def add(group: pa.Table) -> pa.Table:
        v = np.array(sorted(group.column("v").to_pylist()))
        return pa.table({"line": pa.array([group.column("line")[0].as_py()], pa.int64()), "v": pa.array([v.sum(0).tolist()], pa.list_(pa.float64()))})

    lines = rows.groupBy("line").applyInArrow(add, "line long, v array<double>").collect()
    out = np.zeros((size, size))
    for r in lines:
        out[r.line] = r.v
    return out


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every usable row of
    ``vectors`` (vec_id and the array ``column``; other columns are not read) and component up to ``components``.

    Null vectors, empty ones and such with null or non-finite entries take no part, nor do those of
    another length than most have (of equally common lengths the greater one counts).  Rows that repeat a vector or an id are
    rows of the result, but a vector enters the fit once.  Components without variance
    (under LEAST_SHARE of the largest) can't be whitened and have no rows; so an empty table, or
    equal vectors only, give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where(_usable("v"))
    common = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], _RESULT)
    size = common.size
    kept = stored(rows.where(F.size("v") == size).mapInArrow(_whole_vectors(size), "vec_id long, x binary"), "whole-vectors")
    fit = stored(kept.select("x").distinct(), "distinct-vectors")

    parts = fit.mapInArrow(_sums(size), "n long, s array<long>")
    by_place = parts.select("n", F.posexplode("s").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    n, sums = by_place[0].n, np.array([r.s for r in by_place], np.int64)
    covariance = _matrix_sum(fit.mapInArrow(_products(size, n, sums), "line long, v array<double>"), size) / n
    values, basis = eigenvectors(covariance)
    held = int((values[:components] > LEAST_SHARE * max(values[0], 0)).sum()) if values[0] > 0 else 0
    if not held:
        return spark.createDataFrame([], _RESULT)
    weights = basis[:, :held] / np.sqrt(values[:held])
    explained = values[:held] / np.trace(covariance)
    check = _matrix_sum(fit.mapInArrow(_products(size, n, sums, weights), "line long, v array<double>"), held) / n
    error = float(np.abs(check - np.eye(held)).max())
    sent = spark.sparkContext.broadcast((n, sums, weights, explained))  # of a size that the dimension fixes

    def run(batches):
        n, sums, weights, explained = sent.value
        k = weights.shape[1]
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                y = centred(_unpacked(part.column("x"), len(sums)), n, sums)
                if (y.astype(float) ** 2).sum(1).max() >= 2.0 ** 62:
                    raise ValueError("a deviation is too large for 64 bits")
                m = len(y)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n, np.int64)), pa.array(np.repeat((y * y).sum(1), k)), pa.array(((y / n) @ weights).ravel()),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(run, _RESULT)


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
