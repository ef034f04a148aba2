"""Operator 2: line de-duplication.

Every text is exploded into normalised lines, which are hashed (128 bits); the
distinct documents of a hash are counted, hashes over the threshold are sent to
the documents that lose them, and the remaining lines are put together by
position.  Only hashes and ids are grouped; each text is shuffled once, to meet its own
list.  The counted hashes are a written table, so the join of a line that a
third of all documents hold has plain exchanges and is split by adaptive execution.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import id_key, stored, table, text_or_empty

_BLANK = b" \t\n\x0b\x0c\r"


def _key(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip(_BLANK).lower()  # of bytes: A-Z only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _explode(min_chars: int):
    def run(batches):
        for b in batches:
            hashes, counts = [], []
            for text in b.column("text"):
                own = {k for line in text.as_buffer().to_pybytes().split(b"\n") if (k := _key(line, min_chars))}
                hashes.extend(own)
                counts.append(len(own))
            take = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").take(pa.array(take)), b.column("text_hash").take(pa.array(take)), pa.array(hashes, pa.binary())],
                names=["doc", "text_hash", "line"])
    return run


def _reassemble(min_chars: int):
    def run(batches):
        for b in batches:
            texts, lines, dropped = [], [], []
            at = b.schema.get_field_index("__text")
            for text, drop in zip(b.column(at), b.column(b.schema.get_field_index("__drop")).to_pylist()):
                parts = text.as_buffer().to_pybytes().split(b"\n")
                lines.append(len(parts))
                if drop:
                    drop = set(drop)
                    parts = [p for p in parts if _key(p, min_chars) not in drop]
                dropped.append(lines[-1] - len(parts))
                texts.append(b"\n".join(parts).decode())
            rest = [i for i, n in enumerate(b.schema.names) if n not in ("__text", "__drop")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in rest), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*(b.schema.names[i] for i in rest), "__text", "__lines", "__dropped"])
    return run


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """``docs`` (doc_id, text and any columns) with the remaining lines as
    ``text`` and new columns n_lines (before dropping) and n_dropped.

    Keys (stripped, A-Z lowered) of at least ``min_chars`` code points that at
    least ``min_docs`` documents hold lose their lines in all but the smallest
    doc_id.  A null or empty text is one empty line; a null doc_id is one
    document after all others; rows that share a doc_id are one document, and
    each keeps or loses its lines like the other.  Caller's columns stay; one named like a new
    column is replaced.
    """
    keyed = (docs.select(id_key("doc_id").alias("doc"), F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
             .mapInArrow(_explode(min_chars), "doc long, text_hash long, line binary"))
    common = stored(keyed.groupBy("line").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("keeper"))
                    .where(F.col("n") >= min_docs).select("line", "keeper"), "common-lines")
    losses = (keyed.join(common, "line").where(F.col("doc") != F.col("keeper"))
              .groupBy(F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.collect_set("line").alias("__drop")))
    names = [f"c{i}" for i in range(len(docs.columns))]  # as the caller's may be any
    own = dict(zip(docs.columns, names))
    text, others = text_or_empty(own["text"]), [c for c in names if c != own["text"]]
    coded = docs.toDF(*names).select(*others, id_key(own["doc_id"]).alias("__doc"), F.xxhash64(text).alias("__hash"), text.alias("__text"))
    met = coded.join(losses, ["__doc", "__hash"], "left").drop("__doc", "__hash")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema if f.name not in ("__text", "__drop"))
    out = met.mapInArrow(_reassemble(min_chars), f"{schema}, __text string, __lines long, __dropped long")
    kept = [F.col("__text" if c == "text" else own[c]).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*kept, F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """A filtering stage: the columns of ``docs``, text and n_chars as they are
    after ``dedup_lines``.  A text that loses all of its lines stays, empty."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (
  SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
