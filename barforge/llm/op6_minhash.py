"""Operator 6: near-duplicate documents by MinHash.

Each text's 5-word shingle set is sketched by one-permutation hashing with optimal
densification (128 bins) and texts with equal sets become one class.  Bands of 4
bins put the classes into buckets.  In a bucket the smallest class is the centre of
a star: only (centre, member) edges are candidates, so pairs grow with members.

Sketches and texts are not shuffled to find out which of them are needed: a bitmap of bounded size is held against
them where they lie.  It may let more pass, never less, and exact joins follow on what has passed.

Candidates whose wide sketches agree well enough are confirmed on full shingle sets, a star at a
time, and links are joined into components.  Where a star's members are then still in several
components, those outside the largest one are held against all members of other components, on
full sets, a block of askers against a block of members in a task, which returns no
pairs but a forest of the links found: stars bound the candidates, the second pass loses no link,
and no pair that isn't a link leaves a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import stored, table, text_or_empty
from barforge.llm.words import OnePermutation, mix, salt, shingle_sets

BINS, ROWS = 128, 4
#: Bins of the sketch (four bits each) that decides which candidates are confirmed.
WIDE_BINS = 1024
#: 100 * intersection >= PERCENT * union links two documents.
PERCENT = 75
#: Points under the similarity asked for at which an estimate still leads to a
#: confirmation on full sets, for a smaller set of under so many shingles: in a small set a
#: collision of shingles in a bin moves more of the estimate.  At 75 the estimate's standard deviation is
#: 1.0 to 1.3 points, so these are six of them at least.
MARGINS = ((16, 25), (200, 12), (None, 8))
#: About as many members of a star are confirmed together, with one copy of its centre.
STAR_ROWS = 256
#: About as many askers, and as many members, of a star meet in a task of the second pass, and so many shingles of either.
BLOCK_ROWS, BLOCK_SHINGLES = 4096, 1 << 20
#: Bits of a bitmap for each id in it, and the most it may have (16 MB): beyond that it only lets more pass.
MARK_BITS, MOST_MARKS = 64, 1 << 27
#: Bits in a value of Spark's bitmap_construct_agg.
PAGE_BITS = 1 << 15
#: Bits of a bucket that are left out where buckets are only counted: 40 are enough to tell most apart.
KEY_SHIFT = 24


def wide_sketch(tool: OnePermutation, shingles: np.ndarray, own: np.ndarray) -> bytes:
    """Four bits for every bin's least hash, 1 to 15; 0 for an empty bin."""
    held, least = tool.minima(shingles)
    low = np.zeros(tool.bins, np.uint8)
    low[held] = (mix(least ^ own[held]) >> np.uint64(8)) % np.uint64(15) + np.uint64(1)
    return (low[::2] << 4 | low[1::2]).tobytes()


def marked(ids: DataFrame):
    """A broadcast bitmap of the written ids (id, a hash), by their last bits."""
    size = max(PAGE_BITS, min(MOST_MARKS, 1 << (MARK_BITS * ids.count()).bit_length()))
    at = F.col("id").bitwiseAND(F.lit(size - 1))
    pages = (ids.select(F.floor(at / PAGE_BITS).alias("page"), at.bitwiseAND(F.lit(PAGE_BITS - 1)).alias("bit"))
             .repartition("page").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros((size // PAGE_BITS, PAGE_BITS // 8), np.uint8)
    for page, bits in pages:
        out[page] = np.frombuffer(bits, np.uint8)
    return ids.sparkSession.sparkContext.broadcast(out.ravel())


def passes(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether the ids have their bit in the bitmap: all that were put in, and few others."""
    at = ids & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7) & 1).astype(bool)


def _sketch(batches):
    sketch = OnePermutation(BINS)
    for b in batches:
        sizes, keys, bins = [], [], []
        for shingles in shingle_sets(b.column("text")):
            some = len(shingles) > 0
            sizes.append(len(shingles))
            keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if some else None)
            bins.append(sketch(shingles).astype(np.uint16).tobytes() if some else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc"), b.column("doc_id"), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (keys, bins))],
            names=["doc", "doc_id", "n_shingles", "class", "sketch"])


def _involved(marks):
    """The texts whose id passes, with their wide sketches."""
    def run(batches):
        tool, own = OnePermutation(WIDE_BINS, probes=False), salt(WIDE_BINS, 17)
        for b in batches:
            b = b.filter(pa.array(passes(marks.value, b.column("id").to_numpy())))
            sizes, wide = [], []
            for shingles in shingle_sets(b.column("text")):
                sizes.append(len(shingles))
                wide.append(wide_sketch(tool, shingles, own) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(sizes, pa.int64()), pa.array(wide, pa.binary()), b.column("text")],
                                             names=["doc", "n_shingles", "wide", "text"])
    return run


def _unpacked(column: pa.Array) -> np.ndarray:
    """The bins of wide sketches, a row each."""
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDE_BINS // 2)
    return np.concatenate([packed >> 4, packed & 15], axis=1)


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the bins that one of two sketches fills, the share in which they agree; a row for each pair."""
    return ((x == y) & (x > 0)).sum(1) / np.maximum(((x | y) > 0).sum(1), 1)


def _least_agreement(percent: int, sizes: np.ndarray) -> np.ndarray:
    """Share of equal bins from which pairs, whose smaller sets have these sizes, are worth a confirmation."""
    margin = np.select([sizes < below for below, _ in MARGINS[:-1]], [m for _, m in MARGINS[:-1]], MARGINS[-1][1])
    return np.maximum(0, percent - margin) / 100


def _band_words(batches, firsts):
    """Of the rows whose id passes: their numbers and, by row, a 64-bit word for each band's four bins."""
    bands = BINS // ROWS
    own = salt(bands, 13)
    for b in batches:
        b = b.filter(pa.array(passes(firsts.value, b.column("id").to_numpy())))
        words = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint64).reshape(-1, bands)
        yield b.column("doc").to_numpy(), mix(words ^ own)


def _band_keys(firsts):
    """One row for each band: its word without the last bits."""
    def run(batches):
        for _, words in _band_words(batches, firsts):
            yield pa.RecordBatch.from_arrays([pa.array((words >> np.uint64(KEY_SHIFT)).view(np.int64).ravel())], names=["id"])
    return run


def _bands(firsts, busy):
    """One row for each band whose key passes."""
    def run(batches):
        for docs, words in _band_words(batches, firsts):
            at, band = np.nonzero(passes(busy.value, (words >> np.uint64(KEY_SHIFT)).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)[at, band]), pa.array(docs[at])], names=["bucket", "node"])
    return run


def _agree(percent: int):
    def run(batches):
        for b in batches:
            if b.num_rows:
                least = _least_agreement(percent, np.minimum(b.column("n_a").to_numpy(), b.column("n_b").to_numpy()))
                same = agreement(_unpacked(b.column("wide_a")), _unpacked(b.column("wide_b")))
                yield b.select(["a", "b"]).take(pa.array(np.flatnonzero(same >= least)))
    return run


def _confirm_stars(percent: int):
    """Rows of a star's part come together, its centre first: only the centre's set is held."""
    def run(batches):
        star, centre = None, None
        for b in batches:
            found = []
            for key, doc, shingles in zip(zip(b.column("a").to_pylist(), b.column("part").to_pylist()), b.column("doc").to_pylist(), shingle_sets(b.column("text"))):
                if key != star:
                    star, centre = key, shingles
                    continue
                both = len(np.intersect1d(centre, shingles, assume_unique=True))
                if 100 * both >= percent * (len(centre) + len(shingles) - both):
                    found.append((key[0], doc))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def _star_links(close: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The written pairs (a, a star's centre; b) that are links on full sets.  A text goes once to every
    star that it is a candidate of, the centre's once to every STAR_ROWS members."""
    parts = close.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR_ROWS).cast("int").alias("parts"))
    members = close.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.lit(1).alias("turn"), F.col("b").alias("doc"))
    centres = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("turn"), F.col("a").alias("doc"))
    rows = centres.unionByName(members).join(texts, "doc").select("a", "part", "turn", "doc", "text")
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "turn").mapInArrow(_confirm_stars(percent), "a long, b long")


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and their number and the sum of their hashes."""
    seen = Observation()
    out = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("h")), "edges")
    return out, (seen.get["n"], seen.get["h"])


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links a-b; root is the least node of
    the component.  Alternates large-star and small-star steps until nothing changes."""
    edges = edges.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    now, state = _written(edges)
    while state[0]:
        both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).union(now.select("high", "low"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        small = large.groupBy("high").agg(F.min("low").alias("m"))
        pulled = large.join(small, "high").where("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high"))
        now, after = _written(pulled.union(small.select(F.col("m").alias("low"), "high")).distinct())
        if after == state:
            break
        state = after
    return now.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _open_stars(stars: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members (centre, node, root, odd, blocks, ask_blocks) of the stars in which two
    members besides the centre, which has met all, are in different components;
    odd are those outside the star's largest component.  A star is all buckets with one centre."""
    members = stars.select("centre", "node").distinct().join(sizes, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = members.groupBy("centre", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"), F.max((F.col("node") != F.col("centre")).cast("int")).alias("other"))
    of_star = by_root.groupBy("centre").agg(F.sum("other").alias("others"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "root", "s")).alias("largest"))

    def blocks(rows, shingles, name):
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int").alias(name)

    many = stored(of_star.where("others > 1").select(
        "centre", F.col("largest.root").alias("largest"), blocks(F.col("n"), F.col("s"), "blocks"),
        blocks(F.col("n") - F.col("largest.n"), F.col("s") - F.col("largest.s"), "ask_blocks")), "open-stars")
    return members.join(many, "centre").select("centre", "node", "root", (F.col("root") != F.col("largest")).alias("odd"), "blocks", "ask_blocks")


def links_between(sets: list[np.ndarray], node: np.ndarray, root: np.ndarray, asks: np.ndarray, odd: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of the links between members that ask and members of other components, on full sets:
    with it the components are what all links make them."""
    held = np.flatnonzero(~asks)
    held = held[np.argsort([len(sets[i]) for i in held], kind="stable")]
    sizes = np.array([len(sets[i]) for i in held])
    universe, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in held)]), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    own, out = root[held].copy(), []
    mark = np.zeros(len(universe) + 1, bool)
    named = {int(r): int(r) for r in root}

    def top(r: int) -> int:
        while named[r] != r:
            named[r] = r = named[named[r]]
        return r

    for i in np.flatnonzero(asks):
        n, mine = len(sets[i]), top(int(root[i]))
        lo, hi = np.searchsorted(sizes * 100, percent * n), np.searchsorted(sizes * percent, 100 * n, "right")  # no link outside these sizes
        if lo >= hi or (own[lo:hi] == mine).all():
            continue
        at = np.searchsorted(universe, sets[i])
        at = at[universe[np.minimum(at, len(universe) - 1)] == sets[i]]
        mark[at] = True
        both = np.add.reduceat(mark[place[first[lo]:first[hi]]], first[lo:hi] - first[lo], dtype=np.int64)
        mark[at] = False
        good = (100 * both >= percent * (n + sizes[lo:hi] - both)) & (~odd[held[lo:hi]] | (node[held[lo:hi]] != node[i]))
        for j in lo + np.flatnonzero(good):
            theirs = top(int(own[j]))
            mine = top(mine)
            if theirs != mine:
                out.append((int(node[i]), int(node[held[j]])))
                named[theirs] = mine
        if out and len(out) % 64 == 0:
            own = np.array([top(int(r)) for r in own])
    return out


def _search_star(percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sets = [s for chunk in group.column("text").chunks for s in shingle_sets(chunk)]
        node, root, odd, asks = (group.column(c).to_numpy() for c in ("node", "root", "odd", "asks"))
        found = links_between(sets, node, root, asks, odd, percent)
        return pa.table({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate("ab")})
    return run


def _further_links(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links that join the components of the open stars: every odd member asks, from one block of
    askers, in each block of members; every member is held in one, once for each block of askers."""
    def own(blocks: str, seed: int):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(blocks)).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    held = members.select("centre", "node", "root", "odd", own("blocks", 1).alias("block"), every("ask_blocks").alias("ask_block"), F.lit(False).alias("asks"))
    asking = members.where("odd").select("centre", "node", "root", "odd", every("blocks").alias("block"), own("ask_blocks", 2).alias("ask_block"), F.lit(True).alias("asks"))
    rows = held.union(asking).join(texts.select(F.col("doc").alias("node"), "text"), "node")
    return rows.groupBy("centre", "ask_block", "block").applyInArrow(_search_star(percent), "a long, b long")


def _linked(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of the written texts (doc, a row number; doc_id; text): the sketches of every row, and
    (class, root, first) of every class of equal sets that has words.  root names the component;
    first (no_id, doc_id, doc) is its row with the smallest doc_id, null ids last."""
    rows = stored(texts.mapInArrow(_sketch, "doc long, doc_id long, n_shingles long, class binary, sketch binary"), "sketches")
    nodes = rows.where("n_shingles > 0").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc")).alias("first"), F.first("n_shingles").alias("n_shingles"))
    nodes = stored(nodes.withColumn("node", F.col("first.doc")), "classes")
    texts = texts.select("doc", "text")

    # most buckets hold one node: they are counted without it, and only the others' members are dealt by bucket
    firsts = marked(nodes.select(F.xxhash64("node").alias("id")))
    sketches = rows.where("n_shingles > 0").select("doc", F.xxhash64("doc").alias("id"), "sketch")
    busy = stored(sketches.mapInArrow(_band_keys(firsts), "id long").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "busy-buckets")
    in_bands = sketches.mapInArrow(_bands(firsts, marked(busy)), "bucket long, node long")
    in_bands = stored(in_bands.join(nodes.select("node"), "node", "left_semi").select("bucket", "node"), "bands")
    centres = stored(in_bands.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("bucket", "centre"), "star-centres")
    stars = stored(in_bands.join(centres, "bucket").select("centre", "node").distinct(), "stars")
    members = marked(stars.select("node").distinct().select(F.xxhash64("node").alias("id")))
    texts = stored(texts.select("doc", F.xxhash64("doc").alias("id"), "text")
                   .mapInArrow(_involved(members), "doc long, n_shingles long, wide binary, text string"), "involved-texts")
    wide, texts = texts.select("doc", "wide", "n_shingles"), texts.select("doc", "text")
    pairs = (stars.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
             .join(wide.toDF("a", "wide_a", "n_a"), "a").join(wide.toDF("b", "wide_b", "n_b"), "b").select("a", "b", "wide_a", "wide_b", "n_a", "n_b")
             .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    close = stored(pairs.mapInArrow(_agree(percent), "a long, b long"), "star-pairs")
    roots = connected(_star_links(close, texts, percent))

    more = stored(_further_links(_open_stars(stars, roots, nodes.select("node", "n_shingles")), texts, percent), "further-links")
    if not more.isEmpty():
        roots = connected(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more))

    placed = stored(nodes.select("class", "node", "first").join(roots, "node", "left")
                    .select("class", F.coalesce("root", "node").alias("root"), "first"), "components")
    firsts = stored(placed.groupBy("root").agg(F.min("first").alias("first")), "component-firsts")
    return rows, stored(placed.select("class", "root").join(firsts, "root").select("class", "root", "first"), "class-components")


def row_components(texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc and component (a row's number) of the written texts (doc, a row number; doc_id; text) that have words."""
    rows, of_class = _linked(texts, percent)
    return rows.select("doc", "class").join(of_class.select("class", F.col("root").alias("component")), "class").select("doc", "component")


def _one_component_per_id(out: DataFrame) -> DataFrame:
    """``out`` (doc_id, root, component_id and others) with the components that
    share a doc_id joined: rows of one doc_id are one document."""
    shared = out.where("root IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("root").alias("a"), F.max("root").alias("b"))
    ids = stored(shared.where("a <> b").select("doc_id", "a"), "shared-ids")
    if ids.isEmpty():
        return out
    joined = connected(out.where("root IS NOT NULL").join(ids, "doc_id").select("a", F.col("root").alias("b")).distinct())
    joined = stored(joined.union(joined.select("root", "root").distinct()).toDF("root", "top"), "joined-components")
    of_root = stored(out.select("root", "component_id").distinct().join(joined, "root"), "joined-ids")
    least = of_root.groupBy("top").agg(F.min("component_id").alias("least"))
    least = stored(of_root.join(least, "top").select("root", "least"), "least-ids")
    return out.join(least, "root", "left").withColumn("component_id", F.coalesce("least", "component_id")).drop("least")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept
    (doc_id = component_id) of every row of ``docs`` (doc_id, text; other columns are not read).

    Words are A-Z lowered; a text of under five words is one shingle; null, empty and
    blank texts have none, are linked with nothing and kept.  Rows that share a doc_id are one
    document (their component is common).  Rows with a null id are documents of their own, after all
    others; a component of such rows alone has a null component_id.  An empty table gives no rows.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows, of_class = _linked(stored(texts, "texts"), percent)
    found = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    out = rows.select("doc_id", "n_shingles", "class").join(of_class, "class", "left").select("doc_id", "n_shingles", "root", found.alias("component_id"))
    out = _one_component_per_id(stored(out, "found")).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """A filtering stage: of every group of texts that are near duplicates one row stays, that with the
    smallest doc_id (null ids last; of repeated rows any one), with all columns of ``docs``."""
    name = "row"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    held = stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    rows, of_class = _linked(held.select(F.col(name).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), PERCENT)
    gone = rows.select("doc", "class").join(of_class.select("class", "first"), "class").where("doc <> first.doc").select(F.col("doc").alias(name))
    return held.join(gone, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[p:p + 4], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r(doc_id, c) AS (
  SELECT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id,
       w.doc_id = coalesce(m.c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
