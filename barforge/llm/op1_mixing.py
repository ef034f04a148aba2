"""Operator 1: mixing sources to target weights.

A source's words are one stream, packed into blocks of ``BLOCK_WORDS``.  The mix is a
list of slots: a source's quota of words fixes how many it fills, and its slots fall to the
output shards by a multinomial draw, so a shard's counts are multinomial given the quotas.
Slot k of a source is in epoch ``k // blocks`` and takes the block that the epoch's own
pseudorandom permutation (swap-or-not, computed, never stored) puts at
``k % blocks``; slots and blocks are joined by that index.  The last slot takes only the
words its source still owes, so quotas are met to the word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from barforge.llm.common import shuffle_parts, stored, table, text_or_empty
from barforge.llm.words import buffers, find_words, mix, salt, text_groups

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 1 << 14
SEED = 2024
#: Different documents of one source whose place in its stream one task works out.
_RUN_ROWS = 2_000
_ROUNDS = 24


def permute(at: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n), applied to ``at``: in each
    round x and its partner ``shift - x`` change places or not by a hash of the
    pair.  Rounds undo themselves, so the inverse takes them backwards."""
    x, n = at.astype(np.uint64), np.uint64(n)
    keys = salt(2 * _ROUNDS, key)
    for r in range(_ROUNDS)[::-1] if inverse else range(_ROUNDS):
        partner = (keys[2 * r] % n + n - x) % n
        swap = (mix(np.maximum(x, partner) ^ keys[2 * r + 1]) & np.uint64(1)).astype(bool)
        x = np.where(swap, partner, x)
    return x.astype(np.int64)


def _key(source: int, epoch: int) -> int:
    return int(salt(1, SEED * 1_000_003 + source * 1009 + epoch)[0] >> np.uint64(2))


def source_targets(rows: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, number, source_size, target: all words are shared by weight,
    a source gets ``most_epochs`` times its size at most, and the excess goes to the others by weight.

    In the order of size over weight the capped sources come first, so running
    sums over the table of sources (one row each) give the level at which the others
    would stand; it rises while sources are rightly capped and falls after, so the greatest holds.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sizes = sizes.withColumn("number", number)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("most", most_epochs * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "number")
    upto, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(upto), F.lit(0.0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    level = (F.sum("source_size").over(whole) - before) / rest
    found = sizes.withColumn("level", level)
    found = found.withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("most"), F.col("weight") * F.col("level"))
    return found.select("source", "number", "source_size", target.alias("target"))


def _draw(block_words: int, most_epochs: int, shards: int):
    """A source's quota as runs of slots, one for each shard that draws any."""
    def run(batches):
        for b in batches:
            for number, size, target in zip(*(b.column(c).to_pylist() for c in ("number", "source_size", "target"))):
                quota = min(round(target), most_epochs * size)
                if not quota:
                    continue
                blocks = -(-size // block_words)
                epochs, rest = divmod(quota, size)
                slots, last = epochs * blocks, 0
                if rest:  # whole slots of the last epoch, and the words of one more
                    lacks = blocks * block_words - size  # of the stream's last block
                    place = int(permute(np.array([blocks - 1]), blocks, _key(number, epochs), inverse=True)[0])
                    beyond = rest >= (place + 1) * block_words - lacks
                    more = (rest + lacks * beyond) // block_words
                    last = rest - more * block_words + lacks * beyond
                    slots += more + (last > 0)
                counts = np.random.default_rng([SEED, number]).multinomial(slots, np.full(shards, 1 / shards))
                first = np.cumsum(counts) - counts
                drawn = np.flatnonzero(counts)
                n = len(drawn)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * n, pa.int64()) for v in (number, size, blocks, slots, last)]
                    + [pa.array(drawn), pa.array(first[drawn]), pa.array(counts[drawn])],
                    names=["number", "size", "blocks", "slots", "last", "shard", "first", "count"])
    return run


def _map_slots(block_words: int):
    """Slots to blocks: number, block, epoch, shard, slot and words to take (the first of the block)."""
    def run(batches):
        for b in batches:
            for number, size, blocks, slots, last, shard, first, count in zip(*(b.column(c).to_pylist() for c in (
                    "number", "size", "blocks", "slots", "last", "shard", "first", "count"))):
                k = np.arange(first, first + count)
                epoch, place = k // blocks, k % blocks
                block = np.empty(count, np.int64)
                for e in np.unique(epoch).tolist():
                    own = epoch == e
                    block[own] = permute(place[own], blocks, _key(number, e))
                words = np.minimum(block_words, size - block * block_words)
                if last:
                    words[k == slots - 1] = last
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, number)), pa.array(block), pa.array(epoch), pa.array(np.full(count, shard)), pa.array(k), pa.array(words)],
                    names=["number", "block", "epoch", "shard", "slot", "words"])
    return run


def _place(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row's begin in the stream of its source: sums of bounded runs of
    documents, then a running sum inside each run, so no source is in one task.

    The order is that of a hash of the document (``key``), so it doesn't depend on how the rows lie in
    files.  Rows that repeat a document follow each other: they are counted before they are placed, and
    which copy a row is follows from counts for each file partition and its place in that one's rows.
    """
    named = rows.where("size > 0").join(plan.select("source", "number"), rows["source"].eqNullSafe(plan["source"])).select(
        "row", "number", "size", "key", F.shiftright("row", 33).alias("file_part"))
    runs = max(1, math.ceil(rows.count() / _RUN_ROWS))
    documents = named.groupBy("number", "key", "size").agg(F.count(F.lit(1)).alias("copies")).withColumn("run", F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(runs)))
    documents = stored(documents, "mixed-documents")
    sums = documents.groupBy("number", "run").agg(F.sum(F.col("size") * F.col("copies")).alias("run_size"))
    before = F.sum("run_size").over(Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("number", "run", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum(F.col("size") * F.col("copies")).over(Window.partitionBy("number", "run").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1))
    placed = (documents.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, ["number", "run"])
              .select("number", "key", "size", "copies", (F.col("start") + F.col("inside")).alias("first")))
    found = stored(named.join(placed, ["number", "key", "size"]), "placed-documents")
    repeated = found.where("copies > 1")
    counts = repeated.groupBy("number", "key", "size", "file_part").agg(F.count(F.lit(1)).alias("here"))
    earlier = F.sum("here").over(Window.partitionBy("number", "key", "size").orderBy("file_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("number", "key", "size", "file_part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    copy = F.row_number().over(Window.partitionBy("number", "key", "size", "file_part").orderBy("row")) - 1 + F.col("earlier")
    repeated = repeated.join(counts, ["number", "key", "size", "file_part"]).select("row", "number", "size", (F.col("first") + F.col("size") * copy).alias("begin"))
    return found.where("copies = 1").select("row", "number", "size", F.col("first").alias("begin")).unionByName(repeated)


def mixed_pieces(rows: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS,
                 block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mix of ``rows`` (row, a number from monotonically_increasing_id; source; size; key, a hash of the
    document): what each slot takes of each row (row, shard, slot, epoch, from_word, words), and ``source_targets``."""
    plan = stored(source_targets(rows, weights, most_epochs), "source-targets")
    total = plan.agg(F.sum("target")).first()[0] or 0
    shards = max(1, math.ceil(total / block_words / SHARD_SLOTS))
    runs = plan.select("number", "source_size", "target").mapInArrow(
        _draw(block_words, most_epochs, shards), "number long, size long, blocks long, slots long, last long, shard long, first long, count long")
    # A number of tasks that grows with the slots: the plan itself is so small that Spark would make them in one.
    slots = runs.repartition(shards, "number", "shard").mapInArrow(
        _map_slots(block_words), "number long, block long, epoch long, shard long, slot long, words long")
    first, last = F.floor(F.col("begin") / block_words), F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    pieces = _place(rows, plan).select("row", "number", "begin", "size", F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.col("begin"), F.col("block") * block_words)
    hi = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("row", "number", "block", (lo - F.col("begin")).alias("from_word"), (hi - lo).alias("held"),
                           (lo - F.col("block") * block_words).alias("skip"))
    words = F.least(F.col("held"), F.col("words") - F.col("skip"))
    # Slots come of a few rows of the plan, by which Spark would take them for small.
    taken = slots.hint("merge").join(pieces.hint("merge"), ["number", "block"]).select("row", "shard", "slot", "epoch", "from_word", words.alias("words"))
    return taken.where("words > 0"), plan


def count_words(batches):
    """Appends ``size``, the words of ``__text``."""
    for b in batches:
        column = b.column(b.schema.get_field_index("__text"))
        sizes = [np.diff(find_words(data, at)[2]) for _, _, data, at in text_groups(column)]
        yield b.drop_columns(["__text"]).append_column("size", pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64()))


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, and of the mix's output n_slots (slots that hold words of
    the row), n_shards and first_shard (null where nothing is taken), of every row of ``docs``
    (doc_id, text, source; other columns are not read).

    Null, empty and blank texts have size 0 and are not taken; a null source is a source of its
    own, after all others; repeated rows each hold their words; an empty table gives no rows.
    """
    rows = _sized(docs)
    taken, plan = mixed_pieces(rows, **options)
    taken = taken.groupBy("row").agg(F.sum("words").alias("taken"), F.count_distinct("slot").alias("n_slots"), F.count_distinct("shard").alias("n_shards"),
                                     F.min("shard").alias("first_shard"))
    out = rows.join(taken, "row", "left").join(plan.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
    return out.select("doc_id", "size", "source_size", "target", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("taken", "n_slots", "n_shards")], "first_shard")


def _sized(docs: DataFrame) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("doc_id", text_or_empty()).alias("key"), text_or_empty().alias("__text")).mapInArrow(
        count_words, "doc_id long, source string, key long, size long")
    return stored(narrow.withColumn("row", F.monotonically_increasing_id()), "sizes")


def mixed_shards(docs: DataFrame, **options) -> DataFrame:
    """The mix as its output shards: shard, source, slot (in order, inside a shard and source), doc_id, epoch, from_word
    and n_words of every span of a document; a shard's sources have the slots of its multinomial draw."""
    rows = _sized(docs)
    taken, _ = mixed_pieces(rows, **options)
    return taken.join(rows.select("row", "doc_id", "source"), "row").select("shard", "source", "slot", "doc_id", "epoch", "from_word", F.col("words").alias("n_words"))


def _cut(text_at: int, spans_at: int, schema: list[str]):
    """One row for each epoch of a text: the words taken, the whole text if all are."""
    def run(batches):
        for b in batches:
            texts, spans = b.column(text_at), b.column(spans_at).to_pylist()
            row, out = [], []
            data, at = buffers(texts)
            for i, own in enumerate(spans):
                raw = data[at[i]:at[i + 1]]
                starts, ends, _ = find_words(raw, np.array([0, len(raw)]))
                epochs: dict[int, list] = {}
                for s in own:
                    epochs.setdefault(s["epoch"], []).append((s["from_word"], s["words"]))
                for e in sorted(epochs):
                    row.append(i)
                    out.append(_joined(raw.tobytes(), starts, ends, sorted(epochs[e])))
            rest = b.select([n for n in b.schema.names if n != b.schema.names[spans_at]]).take(pa.array(row, pa.int64()))
            arrays = [pa.array(out, pa.string()) if j == text_at else c for j, c in enumerate(rest.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema)
    return run


def _joined(raw: bytes, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> str:
    if sum(n for _, n in spans) == len(starts):
        return raw.decode()
    parts, open_from, upto = [], None, None
    for a, n in spans:  # neighbouring blocks make one span
        if a != upto:
            if upto:
                parts.append(raw[starts[open_from]:ends[upto - 1]])
            open_from = a
        upto = a + n
    parts.append(raw[starts[open_from]:ends[upto - 1]])
    return b"\n".join(parts).decode()


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the columns of ``docs``, a row for each document
    and epoch with the words taken of it as text (spans that don't touch are
    joined by a newline) and their length as n_chars.  Documents of
    which nothing is taken have no row."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, source = names[docs.columns.index("text")], names[docs.columns.index("source")]
    own = F.col(names[docs.columns.index("doc_id")]) if "doc_id" in docs.columns else F.lit(0)
    coded = docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()).withColumn("key", F.xxhash64(own, text_or_empty(text)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in coded.schema)
    base = stored(coded.withColumn("__text", text_or_empty(text)).mapInArrow(count_words, f"{schema}, size long"), "numbered-documents")
    taken, _ = mixed_pieces(base.select("row", F.col(source).alias("source"), "size", "key"), **options)
    spans = taken.groupBy("row").agg(F.collect_list(F.struct("epoch", "from_word", "words")).alias("spans"))
    met = base.join(spans, "row").select(*names, "spans")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema if f.name != "spans")
    out = met.mapInArrow(_cut(names.index(text), len(names), names), schema).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
