"""Operator 12: prefix trie of conversations from sorted sequences.

A conversation is the sequence of its turns' digests.  The sequences are sorted, so the members
of a trie node (all conversations that begin with the same turns) are one interval of rows, and a
node of depth d ends where the longest common prefix (LCP) of neighbours falls under d.  A sparse
table answers the minimum of any run of LCPs; every candidate prefix binary-searches
its right end in it, and its parent's left end, independently of all others: no stack.  Nodes in
order of their first row and depth are the trie in preorder, so a subtree is a run of it
and its sums are differences of running sums.

Sorted rows are cut into ranges of a bounded size by (sequence, conversation), so copies and shared
beginnings, however many, spread over ranges.  A range works out its own nodes; those that go on
beyond it (no deeper than the LCP over the border) are partial, and are added up afterwards:
a few rows for each border.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.llm.common import shuffle_parts, stored, table

#: Bytes of a turn's digest, of sequences in a range, and of ids in one piece of a list.
DIGEST, RANGE_BYTES, PIECE_BYTES = 16, 1 << 23, 4096
#: A conversation that other conversations of its block may begin with: every BLOCK-th, and at most HEAD turns of it.
BLOCK, HEAD = 100, 5
NONE_SHA256 = hashlib.sha256(b"").hexdigest()


# ---- sequences ----------------------------------------------------------------
def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (digest in hex, n_chars; in order) of every conversation.

    Turns are ordered by ``turn``, null first, and among equal ones by digest; a null role or text
    is empty.  Rows without a conv_id belong to no conversation.  Other columns are not read.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("n_chars")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return turns.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["n_chars"].alias("n_chars"))).alias("turns"))


def with_shared_heads(seqs: DataFrame, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """Every conversation c begins with the first h turns of the first conversation of its
    block (all if fewer, none if there is none), h = crc32(c) mod (head + 1), in place of its own first h."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(head + 1)
    heads = seqs.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, head).alias("first"))
    own = seqs.select("conv_id", "turns", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(heads, "base", "left")
    first = F.when(F.col("first").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("first", F.lit(1), F.col("h")))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


# ---- one range ------------------------------------------------------------------
class RangeMinimum:
    """Sparse table: the minimum of any run of ``values`` from two overlapping runs of a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of ``values[lo:hi]``, no run empty."""
        level = np.frexp(hi - lo)[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for k in np.unique(level):
            at, own = np.flatnonzero(level == k), self.levels[k]
            out[at] = np.minimum(own[lo[at]], own[hi[at] - (1 << int(k))])
        return out


def right_ends(lcp: RangeMinimum, n: int, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last row that shares ``depth`` turns with ``row``; lcp holds, for each row but the first, the LCP with the one before."""
    lo, hi = row.copy(), np.full(len(row), n - 1)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_] + 1) // 2
        good = lcp(row[open_], mid) >= depth[open_]
        lo[open_] = np.where(good, mid, lo[open_])
        hi[open_] = np.where(good, hi[open_], mid - 1)
    return lo


def left_ends(lcp: RangeMinimum, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row that shares ``depth`` turns with ``row``."""
    lo, hi = np.zeros(len(row), row.dtype), row.copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        good = lcp(mid, row[open_]) >= depth[open_]
        hi[open_] = np.where(good, mid, hi[open_])
        lo[open_] = np.where(good, lo[open_], mid + 1)
    return lo


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    lo, hi = 0, n // DIGEST  # the first lo turns agree, the first hi don't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo * DIGEST:mid * DIGEST] == b[lo * DIGEST:mid * DIGEST] else (lo, mid)
    return lo


_ROWS = pa.schema([("kind", pa.string()), ("id", pa.binary()), ("parent", pa.binary()), ("top", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                   ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                   ("n_chars", pa.int64()), ("ends", pa.string()), ("range", pa.int64()), ("piece", pa.int64())])
_SCHEMA = "kind string, id binary, parent binary, top binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, " \
          "saved_tokens long, n_chars long, ends string, range long, piece long"


def _id(key: bytes, depth: int) -> bytes:
    return hashlib.blake2b(key[:depth * DIGEST], digest_size=16).digest()


def _range_nodes(borders: dict[int, tuple[int, int]]):
    """Nodes of one range.  Rows of ``kind`` node are whole; partial ones (``part``) have sums over this
    range's whole nodes only; ids of conversations that end in a partial node are pieces (``ends``).  A child of a partial node names its parent by id."""
    def run(group: pa.Table) -> pa.Table:
        number = group.column("range")[0].as_py()
        ids = group.column("conv_id").to_numpy()
        keys = group.column("key").to_pylist()
        order = sorted(range(len(keys)), key=lambda i: (keys[i], ids[i]))
        ids, keys = ids[order], [keys[i] for i in order]
        chars = group.column("chars").combine_chunks().take(pa.array(order))
        first_char, chars = np.cumsum([0, *(len(k) // DIGEST for k in keys)]), chars.flatten().to_numpy()
        n, lens = len(keys), np.array([len(k) // DIGEST for k in keys], np.int64)
        before, after = borders[number]
        near = np.array([0, *(common_turns(a, b) for a, b in zip(keys, keys[1:]))], np.int64)
        lcp, least_id = RangeMinimum(near[1:]), RangeMinimum(ids)

        # A row's candidates are the prefixes that the row before does not begin with; in order they are the preorder.
        own = lens - near
        offset = np.concatenate([[0], np.cumsum(own)])
        row = np.repeat(np.arange(n), own)
        depth = np.arange(len(row)) - offset[row] + near[row] + 1
        last = right_ends(lcp, n, row, depth)
        members = last - row + 1
        conv = least_id(row, last + 1) if len(row) else row
        partial = ((row == 0) & (depth <= before)) | ((last == n - 1) & (depth <= after))

        # The parent of a row's first candidate began in an earlier row, others' is the candidate before them.
        parent = np.arange(len(row)) - 1
        top = np.flatnonzero(depth == near[row] + 1)
        up = np.flatnonzero(near[row[top]] > 0)
        from_row = left_ends(lcp, row[top[up]], near[row[top[up]]])
        parent[top] = -1
        parent[top[up]] = offset[from_row] + near[row[top[up]]] - near[from_row] - 1
        whole = ~partial
        has_parent = parent >= 0
        children = np.bincount(parent[has_parent & whole], minlength=len(row))
        leaf = whole & (children == 0)
        saved = np.where(whole, (members - 1) * chars[first_char[row] + depth - 1], 0) if len(row) else row
        stop = offset[last + 1]

        def below(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[stop] - sums[:-1] if len(row) else row

        leaves, saved = below(leaf.astype(np.int64)), below(saved)
        deeper = np.flatnonzero(partial & has_parent)  # a partial node's sums are without those of the partial ones under it
        for sums_of in (leaves, saved):
            np.subtract.at(sums_of, parent[deeper], sums_of[deeper].copy())

        # Rows with equal sequences: the conversations that end in the node of that sequence.
        starts = np.flatnonzero(np.concatenate([[True], (near[1:] < lens[1:]) | (lens[1:] != lens[:-1])]))
        ends_of = {int(offset[a] + own[a] - 1) if lens[a] else -1: (int(a), int(b)) for a, b in zip(starts, [*starts[1:], n])}
        out: list[dict] = []

        def emit(kind: str, level_id: bytes, **values) -> None:
            out.append({"kind": kind, "range": number, "id": level_id, **values})

        def pieces(level_id: bytes, a: int, b: int) -> None:
            size, held, piece = 0, [], 0
            for i in range(a, b):
                held.append(str(ids[i]))
                size += len(held[-1]) + 1
                if size >= PIECE_BYTES or i + 1 == b:
                    emit("ends", level_id, ends=",".join(held), piece=piece)
                    size, held, piece = 0, [], piece + 1

        tops = np.flatnonzero(whole & ~has_parent)  # what is under partial nodes is added to the root by them
        emit("part", _id(b"", 0), depth=0, conv_id=int(ids.min()), n_convs=n, n_children=len(tops), n_leaves=int(leaves[tops].sum()), saved_tokens=int(saved[tops].sum()), n_chars=0)
        if -1 in ends_of:
            pieces(_id(b"", 0), *ends_of.pop(-1))
        sums = {"depth": depth, "conv_id": conv, "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saved}
        for v in np.flatnonzero(partial):
            key, d = keys[row[v]], int(depth[v])
            emit("part", _id(key, d), parent=_id(key, d - 1), top=_id(key, 1), n_chars=int(chars[first_char[row[v]] + d - 1]), **{c: int(x[v]) for c, x in sums.items()})
            if int(v) in ends_of:
                pieces(_id(key, d), *ends_of.pop(int(v)))

        # Whole nodes: their parent is whole too, or is named by its id.
        at = np.flatnonzero(whole)
        place = np.cumsum(whole) - 1
        ends = np.full(len(at), NONE_SHA256, object)
        for v, (x, y) in ends_of.items():
            ends[place[v]] = hashlib.sha256(",".join(map(str, ids[x:y].tolist())).encode()).hexdigest()
        within = has_parent[at] & whole[parent[at]] if len(at) else np.zeros(0, bool)
        above = np.full(len(at), None, object)
        for i in np.flatnonzero(~within):
            above[i] = _id(keys[row[at[i]]], int(depth[at[i]]) - 1)
        nodes = {c: pa.array(x[at]) for c, x in sums.items()} | {
            "kind": pa.array(["node"] * len(at), pa.string()), "parent": pa.array(above, pa.binary()), "ends": pa.array(ends, pa.string()),
            "parent_conv_id": pa.array(np.where(within, conv[parent[at]], 0) if len(at) else [], pa.int64(), mask=~within), "range": pa.array(np.full(len(at), number))}
        nodes = pa.table([nodes.get(f.name, pa.nulls(len(at), f.type)).cast(f.type) for f in _ROWS], _ROWS)
        return pa.concat_tables([nodes, pa.Table.from_pylist(out, _ROWS)])
    return run


# ---- nodes that several ranges share ---------------------------------------------
def _added_up(group: pa.Table) -> pa.Table:
    """The partial nodes under one first turn, added up over the ranges and then from the deepest
    to the first: a few rows for each border, whatever the number of conversations."""
    nodes: dict[bytes, dict] = {}
    for r in group.select([f.name for f in _ROWS]).to_pylist():
        v = nodes.setdefault(r["id"], r | {"n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0})
        v["conv_id"] = min(v["conv_id"], r["conv_id"])
        for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            v[name] += r[name]
    for v in sorted(nodes.values(), key=lambda v: -v["depth"]):
        v["n_leaves"] += not v["n_children"]
        v["saved_tokens"] += (v["n_convs"] - 1) * v["n_chars"]
        if up := nodes.get(v["parent"]):
            up["n_children"] += 1
            up["n_leaves"] += v["n_leaves"]
            up["saved_tokens"] += v["saved_tokens"]
    for v in nodes.values():
        v |= {"kind": "shared", "parent_conv_id": nodes[v["parent"]]["conv_id"] if v["depth"] > 1 else None}
    return pa.Table.from_pylist(list(nodes.values()), _ROWS)


def _digests(batches):
    """SHA-256 of the pieces of each id, which come in order and together; only the hash's state is kept."""
    held, state = None, None

    def row(key, h):
        return pa.RecordBatch.from_pydict({"id": pa.array([key], pa.binary()), "sha": pa.array([h.hexdigest()], pa.string())})

    for b in batches:
        for key, piece in zip(b.column("id").to_pylist(), b.column("ends").to_pylist()):
            if key != held:
                if state:
                    yield row(held, state)
                held, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
    if state:
        yield row(held, state)


def _borders(batches):
    for b in batches:
        shared = [common_turns(x, y) if x is not None else 0 for x, y in zip(b.column("up").to_pylist(), b.column("lo").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("range"), pa.array(shared, pa.int64())], names=["range", "shared"])


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``seqs`` (conv_id, turns: an array of digest in hex and n_chars).

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; null for the root),
    n_convs, n_children, n_leaves and saved_tokens (over the subtree, its top included), and ends_sha256 (of the ids
    of the members that end there, ascending).  No conversation, no node; one without turns is a member of the root.
    A conversation's digests are one row, 16 bytes a turn; texts are not carried.
    """
    spark = seqs.sparkSession
    rows = seqs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"), F.transform("turns", lambda t: t["n_chars"]).alias("chars"))
    rows = stored(rows, "sequences")
    size = rows.agg(F.sum(F.octet_length("key") + 8 * F.size("chars") + 32)).first()[0]
    if not size:
        return spark.createDataFrame([], _RESULT)
    ranges = max(shuffle_parts(spark), math.ceil(size / RANGE_BYTES))
    ranged = stored(rows.repartitionByRange(ranges, "key", "conv_id").withColumn("range", F.spark_partition_id().cast("long")), "ranges")
    ends = ranged.groupBy("range").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    # A row for each range; two numbers of each go to the driver.
    ends = ends.select("range", "lo", F.lag("hi").over(Window.orderBy("range")).alias("up"))
    shared = sorted(tuple(r) for r in ends.mapInArrow(_borders, "range long, shared long").collect())
    borders = {r: (s, after) for (r, s), after in zip(shared, [*(s for _, s in shared[1:]), 0])}

    found = stored(ranged.groupBy("range").applyInArrow(_range_nodes(borders), _SCHEMA), "range-nodes")
    parts = found.where("kind = 'part'")
    shared_nodes = stored(parts.where("depth > 0").groupBy("top").applyInArrow(_added_up, _SCHEMA), "shared-nodes")
    sums = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    first = shared_nodes.where("depth = 1").agg(F.count(F.lit(1)).alias("n"), *sums).first()
    root = parts.where("depth = 0").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *sums).first()
    top = (root.conv_id, 0, None, root.n_convs, root.n_children + first.n, root.n_leaves + (first.n_leaves or 0) or 1,
           root.saved_tokens + (first.saved_tokens or 0), _id(b"", 0))
    root_row = spark.createDataFrame([top], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, id binary")

    pieces = found.where("kind = 'ends'").select("id", "range", "piece", "ends").repartition("id").sortWithinPartitions("id", "range", "piece")
    digests = stored(pieces.mapInArrow(_digests, "id binary, sha string"), "digests")
    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    several = shared_nodes.select(*numbers[:2], F.when(F.col("depth") == 1, F.lit(root.conv_id)).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), *numbers[3:], "id")
    several = several.unionByName(root_row).join(digests, "id", "left").select(*numbers, F.coalesce("sha", F.lit(NONE_SHA256)).alias("ends_sha256"))
    nodes = found.where("kind = 'node'")
    inner = nodes.where("parent IS NULL OR depth = 1").select(
        *numbers[:2], F.when(F.col("depth") == 1, F.lit(root.conv_id)).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), *numbers[3:], F.col("ends").alias("ends_sha256"))
    under = nodes.where("parent IS NOT NULL AND depth > 1").drop("parent_conv_id").join(
        shared_nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").select(*numbers, F.col("ends").alias("ends_sha256"))
    return inner.unionByName(under).unionByName(several)


_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(with_shared_heads(stored(sequences(table(spark, sf_dir, "conversations")), "turns")))


ORACLE = """
WITH RECURSIVE t AS (
  SELECT conv_id, list(struct_pack(k := md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), n := length(coalesce(text, '')))
                       ORDER BY turn NULLS FIRST, role, text) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (
  SELECT conv_id, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT)),
    lambda c, y: list_reduce(list_prepend(xor(c, y), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 6 AS h
  FROM t),
r AS (
  SELECT b.conv_id, list_concat(coalesce(a.ts[1:h], []), b.ts[h + 1:]) AS ts FROM b LEFT JOIN t a ON a.conv_id = b.conv_id - b.conv_id % 100),
m AS MATERIALIZED (
  SELECT conv_id, d, md5(array_to_string(list_transform(ts[1:d], lambda x: x.k), ',')) AS id, CASE WHEN d > 0 THEN ts[d].n ELSE 0 END AS n, len(ts) = d AS ends,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(ts[1:d - 1], lambda x: x.k), ',')) END AS up
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
v AS MATERIALIZED (
  SELECT id, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY id, d),
c AS MATERIALIZED (SELECT up AS id, d - 1 AS d, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
w AS MATERIALIZED (SELECT v.id, v.d, up, own, (c.n IS NULL)::INT AS leaf FROM v LEFT JOIN c ON c.id = v.id AND c.d = v.d),
a AS (
  SELECT id, d, own, leaf, up, d AS at FROM w
  UNION ALL SELECT a.up, a.d - 1, a.own, a.leaf, w.up, a.at FROM a JOIN w ON w.id = a.up AND w.d = a.d - 1 WHERE a.own > 0 OR a.leaf > 0),
s AS (SELECT id, d, sum(own) AS saved, sum(leaf) AS leaves FROM a GROUP BY id, d)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0) AS n_children, s.leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN s ON s.id = v.id AND s.d = v.d LEFT JOIN c ON c.id = v.id AND c.d = v.d LEFT JOIN v p ON p.id = v.up AND p.d = v.d - 1
"""
