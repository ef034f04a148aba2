"""Operator 9: document fingerprints by b-bit one-permutation MinHash.

The 5-word shingles (A-Z lowered) of a whole text are hashed and binned once, empty bins are
filled by optimal densification, and the low ``BITS`` bits of each bin are packed.
Two fingerprints agree in a bin with probability J + (1 - J) / 2**BITS, so their likeness is
corrected for the agreement by chance.

The query compares each document with its successor.  Documents are dealt into ranges of
doc_id (compressed, the only shuffle of texts); a range also gets a copy of the first
document of the next one, so every row meets its successor in one sorted pass.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import LAST_ID, id_key, shuffle_parts, table, text_or_empty, total_bytes
from barforge.llm.words import GROUP_BYTES, OnePermutation, mix, salt, shingle_sets

BINS, BITS = 512, 4
RANGE_BYTES = 16 << 20
#: Most ranges of doc_id; their limits and first ids (16 bytes each) are all that the driver holds.
MOST_RANGES = 10_000


class Fingerprints:
    """Makes and compares packed fingerprints (inside tasks)."""

    def __init__(self, bins: int = BINS, bits: int = BITS):
        self.sketch, self.bits, self.own = OnePermutation(bins), bits, salt(bins, 7)

    def low_bits(self, texts: pa.Array) -> Iterator[np.ndarray | None]:
        """The low bits of every bin of each text; None without words.  A bin
        scrambles its minimum in its own way, so that copies of one minimum in
        the many empty bins of a short text don't agree by chance together."""
        mask = np.uint64((1 << self.bits) - 1)
        for shingles in shingle_sets(texts):
            yield (mix(self.sketch(shingles) ^ self.own) & mask).astype(np.uint8) if len(shingles) else None

    def pack(self, low: np.ndarray | None) -> str:
        """Base64 of the packed bits; empty for a text without words."""
        if low is None:
            return ""
        bits = np.unpackbits(low[:, None], axis=1)[:, 8 - self.bits:]
        return base64.b64encode(np.packbits(bits).tobytes()).decode()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Jaccard similarity without the agreement by chance, 0 to 1; two texts without words are alike."""
        if a is None or b is None:
            return float(a is b)
        chance = 2.0 ** -self.bits
        return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row of ``docs`` (the general operator;
    nulls, empty and repeated texts as in ``compare_with_next``)."""
    def run(batches):
        tool = Fingerprints()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([tool.pack(x) for x in tool.low_bits(b.column("text"))], pa.string())],
                names=["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string")


def _deal(bounds: list[int], firsts: dict[int, int]):
    """Rows to their range, and a range's first id also to the one before it."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        before = dict(zip(sorted(firsts), sorted(firsts)[-1:] + sorted(firsts)[:-1]))
        limits, first = np.array(bounds, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for at, key in firsts.items():
            first[at] = key
        for b in batches:
            keys = b.column("key").to_numpy()
            at = np.searchsorted(limits, keys, "right")
            also = np.flatnonzero(keys == first[at])
            rows = np.concatenate([np.arange(len(keys)), also])
            to = np.concatenate([at, [before[i] for i in at[also].tolist()]]).astype(np.int32)
            packed = pa.array([press.compress(t.as_buffer()) for t in b.column("text")], pa.binary())
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(np.arange(len(rows)) >= len(keys)), *(b.column(c).take(take) for c in ("key", "doc_id", "text_hash")),
                 packed.take(take)], names=["range", "copy", "key", "doc_id", "text_hash", "packed"])
    return run


def _slices(batches):
    """(range, copy, doc_id, text) of about GROUP_BYTES of text at a time."""
    opener, out, size = zstandard.ZstdDecompressor(), [], 0
    for b in batches:
        for at, copy, doc, packed in zip(*(b.column(c).to_pylist() for c in ("range", "copy", "doc_id", "packed"))):
            text = opener.decompress(packed).decode()
            out.append((at, copy, doc, text))
            size += len(packed) * 3
            if size >= GROUP_BYTES:
                yield out
                out, size = [], 0
    yield out


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_text", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches):
    tool, last = Fingerprints(), []
    for rows in _slices(batches):
        lows = list(tool.low_bits(pa.array([r[3] for r in rows], pa.string())))
        rows = last + [(*r, low) for r, low in zip(rows, lows)]
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
        last = rows[-1:]
        edited = [a[3][:len(a[3]) - len(a[3]) // 2] + b[3][:len(a[3]) // 2] for a, b in pairs]
        lows = list(tool.low_bits(pa.array(edited, pa.string())))
        out = [(a[2], len(a[3]), e, tool.pack(a[4]), tool.pack(low), tool.likeness(a[4], low), tool.likeness(a[4], b[4]))
               for (a, b), e, low in zip(pairs, edited, lows)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text; other columns are not read) with its
    fingerprint, its edited text (its last half replaced by the start of the next
    document), that text's fingerprint, and both likenesses.

    Null and empty texts have the empty fingerprint, texts of under 5 words
    are one shingle.  Rows go by doc_id, null ids last, rows of one id by the hash of their text;
    a lone row follows itself; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(id_key("doc_id").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ranges = min(MOST_RANGES, max(2 * shuffle_parts(spark), math.ceil(total_bytes(docs) / RANGE_BYTES)))
    cuts = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("cuts")).first().cuts
    bounds = sorted(set(cuts or []))
    limits = np.array(bounds, np.int64)

    def place(batches):
        for b in batches:
            at = np.searchsorted(limits, b.column("key").to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), b.column("key")], names=["range", "key"])

    firsts = {r.range: r.key for r in rows.select("key").mapInArrow(place, "range int, key long").groupBy("range")
              .agg(F.min("key").alias("key")).collect()}
    dealt = rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _deal(bounds, firsts), "range int, copy boolean, key long, doc_id long, text_hash long, packed binary")
    ordered = dealt.repartition(shuffle_parts(spark), "range").sortWithinPartitions("range", "copy", "key", "text_hash")
    return ordered.mapInArrow(_compare, "doc_id long, n_chars long, edited_text string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")
