import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import awkward, documents, prose, words
from pyspark.sql import functions as F

from barforge.llm import op1_mixing, op8_packing


def order(rows):
    return sorted(rows, key=repr)


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: float((1, 2, 3)[i % 3]) for i, s in enumerate(names)}
    total, held, out = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in held)
        free = sum(w[s] for s in names if s not in held)
        out = {s: 3.0 * sizes[s] if s in held else rest * w[s] / free for s in names}
        over = {s for s in names if s not in held and out[s] > 3 * sizes[s]}
        if not over:
            return out
        held |= over


def mixed(rng, sizes):
    rows, n = [], 0
    for source, size in sizes.items():
        while size > 0:
            k = min(size, rng.randrange(1, 700))
            rows.append((n, prose(rng, k), source))
            size, n = size - k, n + 1
    return rows


@pytest.mark.parametrize("sizes", [{"a": 40_000, "b": 700, "c": 130, None: 900, "d": 1, "é": 5000}, {"x": 10}, {"a": 128, "b": 256, "c": 129}])
def test_mix_meets_targets(spark, sizes):
    rows = mixed(random.Random(1), sizes) + [(9000, None, "a"), (9001, "", "empty"), (9001, " ", "empty")]
    docs = documents(spark, rows)
    got = op1_mixing.mix_sizes(docs).collect()
    want = brute_targets({**sizes, "empty": 0, **({"a": 0} if "a" not in sizes else {})})
    assert order((r.doc_id, r.size) for r in got) == order((r[0], len(words(r[1]))) for r in rows)
    by = defaultdict(int)
    for (d, _, s), r in zip(sorted(rows, key=lambda r: (r[0], r[2] or "")), sorted(got, key=lambda r: r.doc_id)):
        by[s] += r.taken
        assert abs(r.target - want[s]) < 1e-6 and r.taken <= 3 * r.size
    assert all(abs(by[s] - t) <= 0.5 for s, t in want.items())
    assert order(got) == order(op1_mixing.mix_sizes(docs).collect())


def test_mix_without_rows(spark):
    assert op1_mixing.mix_sizes(documents(spark, [(1, "x")]).limit(0)).count() == 0
    docs = documents(spark, [(1, None), (2, "")])
    assert [(r.size, r.target, r.taken) for r in op1_mixing.mix_sizes(docs).collect()] == [(0, 0.0, 0)] * 2


def test_permutations():
    for n in (1, 2, 3, 10, 257):
        p = op1_mixing.permute(np.arange(n), n, 5)
        assert sorted(p) == list(range(n))
        assert (op1_mixing.permute(p, n, 5, inverse=True) == np.arange(n)).all()
    assert (op1_mixing.permute(np.arange(257), 257, 5) != op1_mixing.permute(np.arange(257), 257, 6)).any()


def test_slots_of_shards_and_epochs(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(i, "ab"[i % 2], rng.randrange(0, 500), i * 7919) for i in range(200)], "row long, source string, size long, key long")
    taken, plan = op1_mixing.mixed_pieces(rows, block_words=64)
    size = {r.source: r.source_size for r in plan.collect()}
    per_epoch = taken.groupBy("row", "epoch", "from_word").agg(F.count("*").alias("n"))
    assert per_epoch.where("n > 1").isEmpty()  # an epoch takes a block once
    assert taken.agg(F.sum("words")).first()[0] == pytest.approx(sum(size.values()), abs=1)


def test_mix_does_not_depend_on_the_files(spark, monkeypatch):
    monkeypatch.setattr(op1_mixing, "_RUN_ROWS", 7)
    rows = mixed(random.Random(7), {"a": 9000, "b": 2000, None: 500}) + [(7000, "same words here", "a")] * 40 + [(None, "no id at all", "b")] * 30
    docs, want = documents(spark, rows), None
    for n, by in ((1, "doc_id"), (7, "text"), (3, "source"), (5, "doc_id")):
        got = order(tuple(r) for r in op1_mixing.mix_sizes(docs.repartition(n, by)).collect())
        want = want or got
        assert got == want
    assert sum(r[4] for r in want if r[0] == 7000) > 0


def test_shards_hold_the_mix(spark, monkeypatch):
    monkeypatch.setattr(op1_mixing, "SHARD_SLOTS", 20)
    docs = documents(spark, mixed(random.Random(5), {"a": 9000, "b": 4000, "c": 600}))
    spans, sizes = op1_mixing.mixed_shards(docs).collect(), {r.doc_id: r for r in op1_mixing.mix_sizes(docs).collect()}
    own = defaultdict(list)
    for r in spans:
        own[r.doc_id].append(r)
    assert len({r.shard for r in spans}) > 3
    for d, r in sizes.items():
        assert r.taken == sum(x.n_words for x in own[d]) and r.n_slots == len({x.slot for x in own[d]}) and r.n_shards == len({x.shard for x in own[d]})
        assert r.first_shard == min((x.shard for x in own[d]), default=None)
    slots = {(r.source, r.slot): r.shard for r in spans}
    assert all(slots[r.source, r.slot] == r.shard for r in spans)


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [r + ("s",) if len(r) == 2 else r for r in awkward(random.Random(3))] + mixed(random.Random(4), {"t": 3000, None: 40})
    docs = documents(spark, rows)
    out = op1_mixing.mix_documents(docs)
    assert out.dtypes == docs.dtypes
    own = defaultdict(list)
    for r in rows:
        own[r[0], r[2]].append(words(r[1]))
    got = out.collect()
    total = sum(len(words(r.text)) for r in got)
    assert abs(total - sum(len(words(r[1])) for r in rows)) <= 2
    for r in got:
        assert words(r.text) and r.n_chars == len(r.text)
        assert any(_spans_of(words(r.text), w) for w in own[r.doc_id, r.source])
    assert op1_mixing.mix_documents(docs.limit(0)).count() == 0


def _spans_of(part, whole):
    it = iter(whole)
    return all(x in it for x in part)


def brute_best_fit(pieces, capacity):
    """Plain best-fit: every open bin is looked at."""
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= size and source not in b["s"] and cluster not in b["c"]]
        if fits:
            _, i = min(fits)
        else:
            bins.append({"left": capacity, "s": set(), "c": set()})
            i = len(bins) - 1
        out.append((i, capacity - bins[i]["left"]))
        bins[i]["left"] -= size
        bins[i]["s"].add(source)
        bins[i]["c"].add(cluster)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_against_brute_force(seed):
    rng = random.Random(seed)
    pieces = [(rng.randrange(1, 101), rng.randrange(rng.choice([2, 8])), rng.choice([0, rng.randrange(50)])) for _ in range(400)]
    bins = op8_packing.Bins(100)
    assert [bins.place(n, 1 << s, 1 << c) for n, s, c in pieces] == brute_best_fit(pieces, 100)


def test_packing_holds_every_word_once(spark):
    rows = [r + (f"s{i % 3}" if i % 4 else None,) for i, r in enumerate(awkward(random.Random(5)))]
    got = op8_packing.pack(documents(spark, rows), bin_words=200).collect()
    held, sources, ends = defaultdict(list), {r[0]: r[2] for r in rows}, defaultdict(int)
    for r in got:
        if r.bin is None:
            assert r.n_words == 0
            continue
        held[r.group_id, r.bin].append(r)
        ends[r.doc_id] += r.n_words
    want = defaultdict(int)
    for d, t, _ in rows:
        want[d] += len(words(t))
    assert {d: n for d, n in want.items() if n} == dict(ends)
    for own in held.values():
        own.sort(key=lambda r: r.bin_offset)
        assert sum(r.n_words for r in own) <= 200
        assert all(a.bin_offset + a.n_words == b.bin_offset for a, b in zip(own, own[1:])) and own[0].bin_offset == 0
        names = [sources[r.doc_id] for r in own if r.doc_id != 9]
        assert len(set(names)) == len(names)
        assert sum(r.doc_id in (2, 5, 9) for r in own) <= 1  # copies
    empty = documents(spark, rows).limit(0)
    assert op8_packing.pack(empty).count() == 0


def test_registered_packing_parts_near_copies(spark, tmp_path):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base[:7 * i] + [f"edit{i}"] + base[7 * i + 1:]), f"s{i}") for i in range(6)]
    rows += [(None, " ".join([*base, "end"]), "s9"), (7, None, "s8"), (8, "own words " + " ".join(f"x{rng.randrange(999)}" for _ in range(20)), "s7")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op8_packing.op8_packing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.n_words for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    near = [(r.group_id, r.bin) for r in got if r.doc_id not in (7, 8)]
    assert len(set(near)) == len(near) == 7
    assert {(r.group_id, r.bin) for r in got if r.doc_id == 8} <= set(near)


def test_packing_by_given_clusters(spark):
    docs = documents(spark, [(i, "w " * 10, f"s{i}") for i in range(6)])
    got = op8_packing.pack(docs, bin_words=100, cluster=F.col("doc_id") % 2).collect()
    assert len({r.bin for r in got}) == 3


def test_repeated_rows_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(op8_packing, "GROUP_PIECES", 50)
    got = op8_packing.pack(documents(spark, [(None, None)] * 300 + [(5, "a b c")] * 300)).collect()
    for same in ([r for r in got if r.doc_id is None], [r for r in got if r.doc_id == 5]):
        sizes = [sum(r.group_id == g for r in same) for g in range(12)]
        assert len(same) == sum(sizes) == 300 and max(sizes) <= 60
    assert len({(r.group_id, r.bin) for r in got if r.doc_id == 5}) == 300
