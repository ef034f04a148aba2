"""Operator 4: exact top-k inner products with multi-resolution segment statistics.

A vector is summarised by the means and deviations of its segments, at several
resolutions.  From the segment statistics of two vectors follows a lower bound of
their distance, ``sum(m * (mean - mean')**2 + (dev - dev')**2)``, so, as both norms
are known, an upper bound of their inner product.  Bounds go from coarse to fine over a
block of candidates; those that can't reach a query's k-th best score are
dropped, and survivors are scored exactly, in whole numbers.

Queries and candidates are packed into blocks of a fixed number of rows; every query
block meets every candidate block in a task of its own and keeps k rows for each query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from barforge.llm.common import stored, table

QUERY_ROWS, CANDIDATE_ROWS = 1024, 4096
#: Segments of a vector at each resolution.
LEVELS = (2, 8, 32)
#: Whole scores below this are exact in doubles.
_EXACT = 2.0 ** 52


def segment_stats(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(m) * mean and the deviation (root of the sum of squares around
    the mean) of each of ``segments`` nearly equal segments."""
    cuts = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    sizes = np.diff(cuts)
    sums = np.add.reduceat(vectors, cuts[:-1], axis=1)
    squares = np.add.reduceat(vectors * vectors, cuts[:-1], axis=1)
    return sums / np.sqrt(sizes), np.sqrt(np.maximum(squares - sums * sums / sizes, 0))


def _features(vectors: np.ndarray) -> list[np.ndarray]:
    """Per resolution the vector whose inner product with another's is the bound.

    With d the lower bound of the squared distance, (|q|^2 + |x|^2 - d) / 2 is
    sum(m * mean * mean' + dev * dev')."""
    return [np.concatenate(segment_stats(vectors, n), axis=1) for n in LEVELS if n < vectors.shape[1]]


def top_of_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query id, id, score) of each query's k best rows of the block (ties to
    the smaller id), all exact; the query's own id takes no part."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    exact = vectors.shape[1] * float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) < _EXACT
    fine_q, fine_x = _features(queries), _features(vectors)
    slack = 1e-9 * np.linalg.norm(queries, axis=1) * float(np.linalg.norm(vectors, axis=1).max(initial=0)) + 1e-6
    whole = (vectors, queries) if exact else (vectors.astype(object), queries.astype(object))
    coarse = fine_q[0] @ fine_x[0].T if fine_q else np.full((len(queries), len(ids)), np.inf)
    out = []
    for i, own in enumerate(query_ids):
        bound = coarse[i]
        bound[np.searchsorted(ids, own):np.searchsorted(ids, own, "right")] = -np.inf

        def score(rows):
            return whole[0][rows] @ whole[1][i]

        if len(ids) > k:  # the k most promising rows give the score to reach
            first = np.argpartition(-bound, k - 1)[:k]
            first = first[bound[first] > -np.inf]
            least = float(min(score(first))) if len(first) == k else -np.inf
        else:
            least = -np.inf
        alive = np.flatnonzero((bound >= least - slack[i]) & (bound > -np.inf))
        for q, x in zip(fine_q[1:], fine_x[1:]):
            if len(alive) <= 4 * k:
                break
            alive = alive[x[alive] @ q[i] >= least - slack[i]]
        scores = score(alive)
        best = np.argsort(-scores, kind="stable")[:k]
        out.extend((own, ids[alive[j]], int(scores[j])) for j in best)
    return out


def _blocks(rows: DataFrame, size: int, n: int, name: str) -> DataFrame:
    """Rows packed into blocks of one dimension: ids and vectors as bytes."""
    blocks = max(1, math.ceil(n / size))

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        vectors = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({"dim": group.column("dim")[:1], f"{name}_block": group.column("block")[:1],
                         f"{name}_ids": pa.array([group.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                         f"{name}_vectors": pa.array([np.floor(256 * vectors.astype(np.float64)).tobytes()], pa.binary())})

    return (rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("dim", "block")
            .applyInArrow(pack, f"dim int, {name}_block int, {name}_ids binary, {name}_vectors binary"))


def top_k(rows: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``rows`` (vec_id,
    embedding; other columns are not read) that fits ``is_query``, its ``k`` highest
    inner products of ``floor(256 * x)`` over all other rows, ties to the smaller vec_id.

    Rows with a null id, a null vector, or null or non-finite components take no part; empty vectors
    score 0 with each other; vectors of different dimension don't meet; of rows with one vec_id the
    greatest vector (by component) stands. Fewer than k others give all of them; an empty table no rows.
    """
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & sound)
    valid = stored(valid.groupBy("vec_id").agg(F.max("vector").alias("vector")).withColumn("dim", F.size("vector")), "vectors")
    asked = valid.where(is_query)
    n, m = valid.count(), asked.count()
    candidates = stored(_blocks(valid, CANDIDATE_ROWS, n, "x"), "candidate-blocks")
    queries = stored(_blocks(asked, QUERY_ROWS, m, "q"), "query-blocks")
    meeting = queries.select("dim", "q_block").join(candidates.select("dim", "x_block"), "dim")  # block numbers only
    pairs = (meeting.join(queries, ["dim", "q_block"]).join(candidates, ["dim", "x_block"])
             .repartition(F.col("q_block"), F.col("x_block"), F.col("dim")))

    def search(batches):
        for b in batches:
            for dim, qi, q, xi, x in zip(*(b.column(c).to_pylist() for c in ("dim", "q_ids", "q_vectors", "x_ids", "x_vectors"))):
                qi, xi = np.frombuffer(qi, np.int64), np.frombuffer(xi, np.int64)
                found = top_of_block(np.frombuffer(q).reshape(len(qi), dim), qi, np.frombuffer(x).reshape(len(xi), dim), xi, k)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    found = pairs.select("dim", "q_ids", "q_vectors", "x_ids", "x_vectors").mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 5
"""
