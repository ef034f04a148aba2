"""Train / validation / test assignment with exact sizes and no ranking of
rows.

A cut is a position in the total order ``(key, ties..., all other columns)``.
It is found by refinement: rows are counted per wide bucket of the key, then
per finer bucket inside the one that holds the cut, down to a key value,
then per value of each tie, then per hash of the row, until the cut falls
between two buckets; both cuts share each pass.  Rows are assigned by
comparing their buckets with those of the cuts, which are literals: a
projection.  Only equal rows have no order; they are counted, and so many
copies go to each part.  The key is a long: epoch microseconds for the time
split, 60 bits of an MD5 for the random one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.columns import epoch_micros

#: Bucket widths of the refinement, in microseconds: a day, a minute, one value.
TIME_WIDTHS = (86_400_000_000, 60_000_000, 1)
#: And of 60-bit hashes.
HASH_WIDTHS = (1 << 40, 1 << 20, 1)
LAST = 2**63 - 1
#: Copies of a row that one task makes at a time.
COPIES = 1 << 16


def time_split_sizes(n: int, train_size: float, valid_size: float) -> tuple[int, int, int]:
    """Positions ``int(n*train)`` and ``int(n*(train+valid))`` (no check that
    the fractions sum below one)."""
    a = int(n * train_size)
    b = int(n * (train_size + valid_size))
    b = max(min(b, n), a)
    return a, b - a, n - b


def random_split_sizes(n: int, train_size: float, valid_size: float) -> tuple[int, int, int]:
    """Sizes of the two-step random split: the test part takes its share of
    all rows, then the validation part its share of those left, both rounded
    up; the rest trains."""
    shares = (1.0 - train_size - valid_size, valid_size / (train_size + valid_size))
    if shares[0] <= 0:
        raise ValueError(f"train and validation shares of {train_size} and {valid_size} leave no test part")
    left, taken = n, []
    for share in shares:
        taken.append(math.ceil(share * left))
        left -= taken[-1]
    return left, taken[1], taken[0]


@dataclass
class Cut:
    """A cut between rows: ``at`` holds its bucket at each level looked at so
    far, ``before`` the rows ahead of that bucket, ``past`` that it lies behind all rows."""
    position: int
    before: int = 0
    at: tuple = ()
    past: bool = False

    @property
    def found(self) -> bool:
        return self.past or self.before == self.position

    def inside(self, levels: list[Column]) -> Column:
        """Is the row in the cut's bucket?"""
        return reduce(Column.__and__, (c.eqNullSafe(F.lit(v)) for c, v in zip(levels, self.at)), F.lit(True))

    def ahead(self, levels: list[Column]) -> Column:
        """Is the row in a bucket before the cut's?  (No value comes last.)"""
        if self.past:
            return F.lit(True)
        early = F.lit(False)
        for c, v in reversed(list(zip(levels, self.at))):
            less = c.isNotNull() if v is None else F.coalesce(c < F.lit(v), F.lit(False))
            early = less | (c.eqNullSafe(F.lit(v)) & early)
        return early


def _narrower(column: Column, widths: tuple[int, ...]) -> list[Column]:
    return [F.floor(column / F.lit(w)) if w > 1 else column for w in widths]


def find_cuts(df: DataFrame, levels: list[Column], positions: tuple[int, ...]) -> list[Cut]:
    """The cuts at ``positions``, refined level by level: a pass counts, for
    every cut that is still inside a bucket, the rows per bucket of the next
    level.  One row per cut comes back from each pass."""
    cuts = [Cut(p) for p in positions]
    for depth, level in enumerate(levels):
        open_cuts = [i for i, c in enumerate(cuts) if not c.found or not c.at]
        if not open_cuts:
            break
        # rows are counted by the cuts they lie inside of; few counts, not the rows, are then dealt to these
        sides = [cuts[i].inside(levels).alias(f"c{i}") for i in open_cuts]
        rows = df.select(*sides, level.alias("b")).where(reduce(Column.__or__, (F.col(f"c{i}") for i in open_cuts)))
        counts = rows.groupBy(*[f"c{i}" for i in open_cuts], "b").agg(F.count(F.lit(1)).alias("n"))
        of = F.explode(F.filter(F.array(*[F.when(F.col(f"c{i}"), F.lit(i)) for i in open_cuts]), lambda i: i.isNotNull()))
        counts = counts.select(of.alias("i"), "b", "n").groupBy("i", "b").agg(F.sum("n").alias("n"))
        order = Window.partitionBy("i").orderBy(F.col("b").asc_nulls_last())
        need = F.element_at(F.array(*[F.lit(c.position - c.before).cast("long") for c in cuts]), F.col("i") + 1)
        upto = counts.withColumn("upto", F.sum("n").over(order))
        hits = {r.i: r for r in upto.where((F.col("upto") > need) & (F.col("upto") - F.col("n") <= need)).collect()}
        for i in open_cuts:
            if i in hits:
                cuts[i] = Cut(cuts[i].position, cuts[i].before + hits[i].upto - hits[i].n, (*cuts[i].at, hits[i].b))
            else:
                cuts[i].past = True
    return cuts


def _numbered_copies(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` (the copies of few rows) anew, numbered from 0 in ``_pos``
    within their ``_cut``: copies are counted, and made again in many tasks."""
    counts = rows.groupBy("_cut", *names).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_cut").orderBy(*[F.col(c) for c in names]))
    runs = counts.withColumn("_start", upto - F.col("_n"))
    runs = runs.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))).repartition("_start", "_run")
    first, last = F.col("_start") + F.col("_run") * COPIES, F.col("_start") + F.col("_n") - 1
    return runs.withColumn("_pos", F.explode(F.sequence(first, F.least(first + (COPIES - 1), last)))).select(*names, "_cut", "_pos")


def assign_by_rank(df: DataFrame, key: Column, ties: list[Column], cuts: tuple[int, int], widths: tuple[int, ...],
                   labels=("train", "valid", "test"), whole: bool = False) -> DataFrame:
    """Add ``split``: positions ``< cuts[0]`` get labels[0], ``< cuts[1]``
    labels[1], the rest labels[2], in the total order ``(key, *ties, hash of
    the row)``, ties without a value last.  With ``whole`` the rows of one key stay together: a key
    that holds a cut goes to the part in which it begins."""
    names = df.columns
    d = df.withColumn("_k", key)
    levels = _narrower(F.col("_k"), widths)
    if not whole:
        levels += [*ties, *_narrower(F.xxhash64(*[F.col(f"`{c}`") for c in names]), HASH_WIDTHS)]
    found = find_cuts(d, levels, cuts)

    def label(early) -> Column:
        out = F.lit(labels[2])
        for cut, name in reversed(list(zip(found, labels))):
            out = F.when(early(cut), F.lit(name)).otherwise(out)
        return out

    if whole:
        # a key that begins before the cut goes before it whole
        return d.withColumn("split", label(lambda c: c.ahead(levels) | (F.lit(not c.found) & c.inside(levels)))).drop("_k")
    split = [c for c in found if not c.found]
    plain = label(lambda c: c.ahead(levels))
    if not split:
        return d.withColumn("split", plain).drop("_k")
    # equal rows on both sides of a cut: the first of them that the cut still needs go before it
    holder = F.coalesce(*[F.when(c.inside(levels), F.lit(i)) for i, c in enumerate(split)], F.lit(-1))
    d = d.withColumn("_cut", holder).withColumn("split", plain)
    rest = d.where("_cut < 0").drop("_k", "_cut")
    copies = _numbered_copies(d.where("_cut >= 0").select(*names, "_k", "_cut"), [*names, "_k"])
    chosen = label(lambda c: c.ahead(levels) | (c.inside(levels) & (F.col("_pos") < F.lit(c.position - c.before))) if c in split else c.ahead(levels))
    return rest.unionByName(copies.withColumn("split", chosen).select(*names, "split"))


def _time_key(ts: str) -> Column:
    """Rows without a time come last."""
    return F.coalesce(epoch_micros(ts), F.lit(LAST))


def split_time(df: DataFrame, n: int, train_size: float = 0.7, valid_size: float = 0.15,
               ts: str = "ts", symbol: str = "symbol", whole_timestamps: bool = False) -> DataFrame:
    """Chronological split in the total order ``(ts, symbol)``, NULLs last;
    with ``whole_timestamps`` no time is in two parts."""
    a, v, _ = time_split_sizes(n, train_size, valid_size)
    ties = [F.col(symbol)] if symbol in df.columns else []
    return assign_by_rank(df, _time_key(ts), ties, (a, a + v), TIME_WIDTHS, whole=whole_timestamps)


def hash_key(ts: str | None, symbol: str | None, seed: int) -> Column:
    """60 bits of the MD5 of the text ``symbol|epoch micros|seed``."""
    parts = [F.coalesce(F.col(symbol).cast("string"), F.lit("")) if symbol else F.lit(""),
             F.coalesce(epoch_micros(ts).cast("string"), F.lit("")) if ts else F.lit(""), F.lit(str(int(seed)))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def split_random(df: DataFrame, n: int, train_size: float = 0.7, valid_size: float = 0.15,
                 random_state: int = 42, shuffle: bool = True, ts: str = "ts",
                 symbol: str = "symbol") -> DataFrame:
    """Random split with the two-step sizes; the shuffled order is that of
    ``hash_key``: test first, then validation, then train.  ``shuffle=False`` keeps the
    order of time: train, then validation, then test."""
    tr, va, te = random_split_sizes(n, train_size, valid_size)
    sym = [F.col(symbol)] if symbol in df.columns else []
    if shuffle:
        key = hash_key(ts if ts in df.columns else None, symbol if symbol in df.columns else None, random_state)
        ties = [epoch_micros(ts), *sym] if ts in df.columns else sym
        return assign_by_rank(df, key, ties, (te, te + va), HASH_WIDTHS, labels=("test", "valid", "train"))
    return assign_by_rank(df, _time_key(ts), sym, (tr, tr + va), TIME_WIDTHS)
