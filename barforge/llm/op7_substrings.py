"""Operator 7: substring de-duplication by super-k-mer partitioning.

A window is 13 consecutive words; its minimiser is the least hash of its 4-word
grams.  Consecutive windows that share a minimiser form a super-k-mer: one packed
string of words that travels to the bucket of its minimiser, where equal windows
meet and sorting them finds each one's smallest document.

Documents are first dealt into chunks of a bounded size by a hash of id and text.
A chunk sends every distinct super-k-mer once, with the smallest document that
holds it, so a passage in a third of all documents costs its bucket one string per
chunk.  A bucket answers a chunk with the smallest documents of the shared windows,
and the chunk (the same shuffle, read again) removes the covered words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import LAST_ID, shuffle_parts, table, text_or_empty, total_bytes
from barforge.llm.words import Hasher, find_words, window_hash

WINDOW, GRAM = 13, 4
#: Bytes of text in a chunk.  Super-k-mers hold about 3 words for each word of
#: text, so with 1.5 times as many buckets a bucket gets twice as much.
CHUNK_BYTES = 4 << 20


class _Chunk:
    """The documents of one chunk in a fixed order, with their super-k-mers."""

    def __init__(self, docs: pa.Table, buckets: int):
        docs = docs.combine_chunks()
        ids = docs.column("doc_id").to_pylist()
        keys = np.array([LAST_ID if i is None else i for i in ids], np.int64)
        order = np.lexsort((docs.column("text_hash").to_numpy(), keys))
        self.ids, self.keys = [ids[i] for i in order], keys[order]
        opener, packed = zstandard.ZstdDecompressor(), docs.column("packed")
        texts = [opener.decompress(packed[i].as_buffer()) for i in order.tolist()]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        self.starts, self.ends, self.first = find_words(self.data, self.at)
        self._super_k_mers(buckets)

    def _super_k_mers(self, buckets: int) -> None:
        n = len(self.starts)
        words = Hasher(5, fold_case=False)(self.data, self.starts, self.ends)
        grams = window_hash(words, GRAM, 6)
        count = max(0, n - WINDOW + 1)
        least = grams[:count].copy()
        for j in range(1, WINDOW - GRAM + 1):
            np.minimum(least, grams[j:j + count], out=least)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))[:count]
        whole = np.arange(count) + WINDOW <= self.first[doc + 1] if count else np.zeros(0, bool)
        begin = whole.copy()
        begin[1:] &= (least[1:] != least[:-1]) | ~whole[:-1] | (doc[1:] != doc[:-1])
        stop = whole.copy()
        stop[:-1] &= begin[1:] | ~whole[1:]
        self.run = np.flatnonzero(begin)
        last = np.flatnonzero(stop)
        self.run_doc = doc[self.run]
        data, names = self.data.tobytes(), {}
        runs = zip(self.starts[self.run].tolist(), self.ends[last + WINDOW - 1].tolist())
        self.name = np.array([names.setdefault(data[a:b], len(names)) for a, b in runs], np.int64)
        self.strings = list(names)
        some = np.zeros(len(names), np.int64)  # one run of each string
        some[self.name] = np.arange(len(self.run))
        self.bucket = (least[self.run[some]] % np.uint64(buckets)).astype(np.int64) if len(some) else np.zeros(0, np.int64)
        self.order = np.argsort(self.bucket, kind="stable")

    def parts(self):
        """(bucket, numbers of its strings)."""
        edges = np.flatnonzero(np.diff(self.bucket[self.order])) + 1
        for part in np.split(self.order, edges) if len(self.order) else ():
            yield int(self.bucket[part[0]]), part


def _pack(arrays: list[np.ndarray], strings: bytes = b"") -> bytes:
    head = np.array([a.nbytes for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=5).compress(head + b"".join(a.tobytes() for a in arrays) + strings)


def _unpack(blob: bytes, kinds: list) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds)).tolist()
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out, raw[at:]


_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("packed", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("packed", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_text", pa.string())])


def _press(batches):
    """Texts compressed for the only shuffle of them."""
    press = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = pa.array([press.compress(t.as_buffer()) for t in b.column("text")], pa.binary())
        yield b.drop_columns(["text"]).append_column("packed", packed)


def _send(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        number, chunk, out = docs.column("chunk")[0].as_py(), _Chunk(docs, buckets), []
        least = np.full(len(chunk.strings), LAST_ID)
        most = np.full(len(chunk.strings), -LAST_ID - 1)
        holder = chunk.keys[chunk.run_doc]
        np.minimum.at(least, chunk.name, holder)
        np.maximum.at(most, chunk.name, holder)
        for bucket, part in chunk.parts():
            strings = [chunk.strings[i] for i in part.tolist()]
            sizes = np.array([len(s) for s in strings], np.int32)
            out.append((bucket, number, _pack([sizes, least[part], most[part] > least[part]], b"".join(strings))))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _SENT)], _SENT) if out else _SENT.empty_table()
    return run


def _meet(group: pa.Table) -> pa.Table:
    """The shared windows of one bucket, by chunk."""
    bucket, chunks = group.column("bucket")[0].as_py(), group.column("chunk").to_pylist()
    got = [_unpack(b.as_py(), [np.int32, np.int64, np.bool_]) for b in group.column("packed")]
    sizes = [a[0] for a, _ in got]
    holder, many = np.concatenate([a[1] for a, _ in got]), np.concatenate([a[2] for a, _ in got])
    data = np.frombuffer(b"".join(s for _, s in got), np.uint8)
    at = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
    source = np.repeat(np.arange(len(chunks)), [len(s) for s in sizes])
    within = np.concatenate([np.arange(len(s)) for s in sizes])
    del got
    starts, ends, first = find_words(data, at)
    count = len(starts) - WINDOW + 1
    high = window_hash(Hasher(21, False)(data, starts, ends), WINDOW, 22)
    low = window_hash(Hasher(31, False)(data, starts, ends), WINDOW, 32)
    string = np.repeat(np.arange(len(holder)), np.diff(first))[:count]
    offset = np.arange(count) - first[string]
    whole = np.flatnonzero(offset + WINDOW <= np.diff(first)[string])
    high, low, string, offset = high[whole], low[whole], string[whole], offset[whole]
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    group_of = np.cumsum(new) - 1
    own = holder[string[order]]
    least = np.minimum.reduceat(own, np.flatnonzero(new))[group_of]
    shared = np.flatnonzero((least < own) | many[string[order]])
    least, string, offset = least[shared], string[order[shared]], offset[order[shared]]
    to = source[string]
    by = np.argsort(to, kind="stable")
    out = [(chunks[to[part[0]]], bucket, _pack([within[string[part]].astype(np.int32), offset[part].astype(np.int32), least[part]]))
           for part in (np.split(by, np.flatnonzero(np.diff(to[by])) + 1) if len(by) else ())]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _ANSWER)], _ANSWER) if out else _ANSWER.empty_table()


def _remove(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _RESULT.empty_table()
        chunk = _Chunk(docs, buckets)
        covered = _covered(chunk, answers)
        words, removed, texts = [], [], []
        data = chunk.data.tobytes()
        for i in range(len(chunk.ids)):
            a, b = int(chunk.first[i]), int(chunk.first[i + 1])
            gone = covered[a:b]
            words.append(b - a)
            removed.append(int(gone.sum()))
            if removed[-1]:
                left = a + np.flatnonzero(~gone)
                kept = [data[s:e] for s, e in zip(chunk.starts[left].tolist(), chunk.ends[left].tolist())]
            else:
                kept = data[chunk.at[i]:chunk.at[i + 1]].split()
            texts.append(b" ".join(kept).decode())
        return pa.table([pa.array(c, f.type) for c, f in zip((chunk.ids, words, removed, texts), _RESULT)], _RESULT)
    return run


def _covered(chunk: _Chunk, answers: pa.Table) -> np.ndarray:
    """Which words of the chunk a window with an earlier holder covers."""
    edge = np.zeros(len(chunk.starts) + 1, np.int64)
    parts = dict(chunk.parts())
    by_name = np.argsort(chunk.name, kind="stable")
    runs_at = np.searchsorted(chunk.name[by_name], np.arange(len(chunk.strings) + 1))
    for bucket, blob in zip(answers.column("bucket").to_pylist(), answers.column("packed").to_pylist()):
        (string, offset, least), _ = _unpack(blob, [np.int32, np.int32, np.int64])
        name = parts[bucket][string]
        times = runs_at[name + 1] - runs_at[name]
        row = np.repeat(np.arange(len(name)), times)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        run = by_name[runs_at[name[row]] + nth]
        later = chunk.keys[chunk.run_doc[run]] > least[row]
        begin = chunk.run[run[later]] + offset[row[later]]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup_substrings(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the remaining words, joined by
    one space) of every row of ``docs`` (doc_id, text; other columns are not read).

    A word goes if a 13-word window over it also starts in a document with a
    smaller doc_id, judged on the input.  Null and empty texts have no words, texts
    of under 13 words no window; a null doc_id counts as one document
    after all others; rows that share a doc_id are one document, so they take nothing from each
    other; an empty table gives no rows.
    """
    spark = docs.sparkSession
    size = total_bytes(docs)
    chunks = max(2 * shuffle_parts(spark), math.ceil(size / chunk_bytes))
    buckets = max(2 * shuffle_parts(spark), math.ceil(1.5 * size / chunk_bytes))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    dealt = dealt.withColumn("text_hash", F.xxhash64("text"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(chunks)))
    dealt = dealt.mapInArrow(_press, "doc_id long, text_hash long, chunk long, packed binary")
    sent = dealt.groupBy("chunk").applyInArrow(_send(buckets), "bucket long, chunk long, packed binary")
    answers = sent.groupBy("bucket").applyInArrow(_meet, "chunk long, bucket long, packed binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _remove(buckets), "doc_id long, n_words long, n_removed long, kept_text string")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS s FROM w),
k AS (SELECT doc_id, s, array_to_string(ws[s:s + 12], ' ') AS win FROM g),
m AS (SELECT win, min(doc_id) AS holder FROM k GROUP BY win HAVING min(doc_id) <> max(doc_id)),
c AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM k JOIN m USING (win) WHERE doc_id > holder),
cl AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY doc_id),
x AS (SELECT w.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
t AS (
  SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) AS kept
  FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.p = c.p WHERE c.p IS NULL GROUP BY x.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN cl USING (doc_id) LEFT JOIN t USING (doc_id)
"""
