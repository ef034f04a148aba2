"""Operator 8: conflict-constrained best-fit packing.

Documents fill bins (training sequences) of a fixed number of words.  A bin holds at most
one piece of a source and one of a duplicate cluster: it carries a bitmap of each.
Open bins are ordered by residual; the search begins at the successor of the piece's
size and goes on through larger residuals until it finds the tightest compatible bin.

Longer documents are cut into whole bins and a remainder.  Pieces are dealt by hash into
groups of a bounded number, which are packed independently: copies and
sources, however large, spread over all groups.
"""

from __future__ import annotations

import bisect
import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import op6_minhash
from barforge.llm.common import stored, table, text_or_empty
from barforge.llm.words import Hasher, find_words, text_groups

BIN_WORDS = 1024
GROUP_PIECES = 4096


class Bins:
    """Open bins by residual, and at each residual by their source bitmap."""

    def __init__(self, capacity: int):
        self.capacity, self.count = capacity, 0
        self.residuals: list[int] = []
        self.open: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def _add(self, residual: int, sources: int, clusters: int, number: int) -> None:
        if not residual:
            return
        if residual not in self.open:
            bisect.insort(self.residuals, residual)
            self.open[residual] = {}
        self.open[residual].setdefault(sources, []).append((number, clusters))

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) of a piece; ``source`` and ``cluster`` are single bits.
        Among equally tight bins the one that was opened first is taken."""
        for residual in self.residuals[bisect.bisect_left(self.residuals, size):]:
            level = self.open[residual]
            best = None
            for sources, bins in level.items():
                if sources & source:
                    continue
                for i, (number, clusters) in enumerate(bins):
                    if not clusters & cluster and (best is None or number < best[0]):
                        best = (number, clusters, sources, i)
            if best:
                number, clusters, sources, i = best
                level[sources].pop(i)
                if not level[sources]:
                    del level[sources]
                if not level:
                    del self.open[residual]
                    self.residuals.remove(residual)
                self._add(residual - size, sources | source, clusters | cluster, number)
                return number, self.capacity - residual
        self.count += 1
        self._add(self.capacity - size, source, cluster, self.count - 1)
        return self.count - 1, 0


def _bits(values: list) -> list[int]:
    numbers: dict = {}
    return [1 << numbers.setdefault(v, len(numbers)) for v in values]


_RESULT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("from_word", pa.int64()), ("n_words", pa.int64()),
                     ("group_id", pa.int64()), ("bin", pa.int32()), ("bin_offset", pa.int32())])


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        number = group.column("group_id")[0].as_py()
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("doc_id", "size", "source", "cluster", "text_hash"))),
                      key=lambda r: (-(r[1] % capacity), r[0] is None, r[0] or 0, r[4], r[1]))
        bins, out = Bins(capacity), []
        for (doc, size, *_), source, cluster in zip(rows, _bits([r[2] for r in rows]), _bits([r[3] for r in rows])):
            whole, rest = divmod(size, capacity)
            for piece in range(whole):
                out.append((doc, piece, piece * capacity, capacity, number, *bins.place(capacity, source, cluster)))
            if rest or not whole:
                out.append((doc, whole, whole * capacity, rest, number, *(bins.place(rest, source, cluster) if rest else (None, None))))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], _RESULT)
    return run


def _measure(batches):
    """Words of a text, and a hash of its words (A-Z lowered) as its duplicate cluster."""
    hasher = Hasher(61, fold_case=True)
    for b in batches:
        sizes, clusters = [], []
        for lo, hi, data, at in text_groups(b.column("text")):
            starts, ends, first = find_words(data, at)
            hashes = hasher(data, starts, ends)
            for i in range(hi - lo):
                own = hashes[first[i]:first[i + 1]]
                sizes.append(len(own))
                clusters.append(int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True))
        rest = b.select(["doc_id", "source", "text_hash", "given"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sizes, pa.int64()), pa.array(clusters, pa.int64())],
                                         names=[*rest.schema.names, "size", "own_cluster"])


def measured(docs: DataFrame, cluster: Column | None = None) -> DataFrame:
    """doc_id, source, text_hash, size in words, own_cluster, given (``cluster``, a long) and row (a number) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64(text_or_empty()).alias("text_hash"),
                       (F.lit(None) if cluster is None else cluster).cast("long").alias("given"), text_or_empty().alias("text"))
    sized = rows.mapInArrow(_measure, "doc_id long, source string, text_hash long, given long, size long, own_cluster long")
    # Numbered once, in a written table: rows that repeat id and text spread over the groups like others.
    return stored(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")


def pack_sizes(sized: DataFrame, bin_words: int = BIN_WORDS) -> DataFrame:
    """The packing of ``measured`` rows."""
    groups = max(1, math.ceil(sized.count() / GROUP_PIECES))
    dealt = sized.select("doc_id", "size", "source", F.coalesce("given", "own_cluster").alias("cluster"), "text_hash",
                         F.pmod(F.xxhash64("doc_id", "text_hash", "row"), F.lit(groups)).alias("group_id"))
    return dealt.groupBy("group_id").applyInArrow(
        _pack(bin_words), "doc_id long, piece int, from_word long, n_words long, group_id long, bin int, bin_offset int")


def pack(docs: DataFrame, bin_words: int = BIN_WORDS, cluster: Column | None = None) -> DataFrame:
    """doc_id, piece, from_word, n_words, group_id, bin (in its group) and
    bin_offset of every piece of every row of ``docs`` (doc_id, text, source, other columns only for ``cluster``).

    ``cluster`` (a long) names the rows that must not share a bin; by default
    it is a hash of the text's words.  A null source is a source.  Null, empty and blank texts
    have one piece of no words without a bin; repeated rows are pieces of their own, in other
    bins; an empty table gives no rows.
    """
    return pack_sizes(measured(docs, cluster), bin_words)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of word-for-word different texts are one cluster: their component, by row."""
    docs = table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    docs = stored(docs, "numbered")
    near = stored(op6_minhash.row_components(docs.select("doc", "doc_id", text_or_empty().alias("text"))), "near")
    sized = measured(docs, F.col("doc"))  # the texts stay where they are: clusters join the sizes
    near = near.select(F.col("doc").alias("given"), "component")
    return pack_sizes(sized.join(near, "given", "left").withColumn("given", F.col("component")))
