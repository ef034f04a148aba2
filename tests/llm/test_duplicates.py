import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents, prose, shingles, words
from pyspark.sql import functions as F

from barforge.llm import op6_minhash, op7_substrings, op9_fingerprints
from barforge.llm.words import Hasher, OnePermutation, find_words, text_groups

LAST = 2**63 - 1


def order(rows):
    return sorted(rows, key=repr)


def test_words_of_whole_texts():
    texts = [r[1] for r in awkward(random.Random(2))]
    column = pa.array(texts, pa.string())
    got = []
    for lo, hi, data, at in text_groups(column):
        starts, ends, first = find_words(data, at)
        raw = data.tobytes()
        got += [[raw[a:b].decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])] for i in range(hi - lo)]
    assert got == [words(t) for t in texts]


def test_hash_depends_on_the_bytes_alone():
    data = np.frombuffer(b"abc xabc ABC abd", np.uint8)
    h = Hasher(1, fold_case=True)(data, np.array([0, 5, 9, 13]), np.array([3, 8, 12, 16]))
    assert h[0] == h[1] == h[2] != h[3]


def brute_components(rows):
    sets = [(LAST if d is None else d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                r, s = sorted((root(a), root(b)))
                up[s] = r
    out = []
    for (d, t), (k, x) in zip(rows, sets):
        c = root(k)
        c = None if c == LAST else c
        out.append((d, len(x), c if x else d, (c if x else d) == d))
    return out


def chain(rng, n):
    """Each text is near the next one only."""
    w = words(prose(rng, 160, 5000))
    out = []
    for _ in range(n):
        out.append(" ".join(w))
        at = rng.randrange(0, 140)
        w = w[:at] + [f"n{rng.randrange(10**6)}" for _ in range(8)] + w[at + 8:]
    return out


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    rows = awkward(rng) + [(1000 + rng.randrange(10**6), t) for _ in range(6) for t in chain(rng, 14)]
    base = words(prose(rng, 90, 3000))
    for i in range(60):  # a large group of near copies that need not be near each other
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((5000 + i, " ".join(w)))
    got = [tuple(r) for r in op6_minhash.near_duplicates(documents(spark, rows)).collect()]
    assert order(got) == order(brute_components(rows))


def test_second_pass_loses_no_link(spark, monkeypatch):
    """In one bucket the star's centre is near nobody, the others are near each other."""
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 2), (7, 7)], "a long, b long")
    got = {(r.node, r.root) for r in op6_minhash.connected(edges).collect()}
    assert got == {(5, 2), (4, 2), (3, 2), (9, 8)}
    rng = random.Random(7)
    texts = [prose(rng, 100, 4000)] + chain(rng, 9)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc long, text string")
    sizes = spark.createDataFrame([(i, len(shingles(t))) for i, t in enumerate(texts)], "node long, n_shingles long")
    stars = spark.createDataFrame([(1, 0, i) for i in range(10)] + [(2, 0, i) for i in range(5)], "bucket long, centre long, node long")
    want = {(i, j) for i in range(10) for j in range(i) if 100 * len(shingles(texts[i]) & shingles(texts[j])) >= 75 * len(shingles(texts[i]) | shingles(texts[j]))}
    assert len(want) >= 8
    for block in (3, 4096):
        monkeypatch.setattr(op6_minhash, "BLOCK_ROWS", block)
        for links in ([], [(3, 2), (4, 2)]):
            roots = spark.createDataFrame(links, "node long, root long")
            open_ = op6_minhash._open_stars(stars, roots, sizes)
            assert open_.count() == 10
            got = [tuple(r) for r in op6_minhash._further_links(open_, frame, 75).collect()]
            assert {(max(r), min(r)) for r in got} <= want
            assert joined(10, got + links) == joined(10, list(want) + links)
    closed = spark.createDataFrame([(i, 1) for i in range(2, 10)], "node long, root long")
    assert op6_minhash._open_stars(stars, closed, sizes).count() == 0


def joined(n, links):
    """The least node of each node's component."""
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_links_in_a_block_are_a_forest_of_all_links():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randrange(2, 40)
        base = [rng.getrandbits(60) for _ in range(40)]
        sets = [np.unique(np.array(rng.sample(base, rng.randrange(24, 40)) + [rng.getrandbits(60) for _ in range(rng.randrange(3))], np.uint64)) for _ in range(n)]
        all_links = [(i, j) for i in range(n) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
        root = np.array(joined(n, [x for x in all_links if rng.random() < 0.2]))
        largest = np.bincount(root).argmax()
        odd = root != largest
        if not odd.any():
            continue
        asking, both = np.flatnonzero(odd), np.arange(n)
        node = np.concatenate([asking, both])
        asks = np.concatenate([np.ones(len(asking), bool), np.zeros(n, bool)])
        found = op6_minhash.links_between([sets[i] for i in node], node, root[node], asks, odd[node], 75)
        known = [(i, int(r)) for i, r in enumerate(root)]
        assert {tuple(sorted(x)) for x in found} <= {tuple(sorted(x)) for x in all_links}
        assert joined(n, found + known) == joined(n, all_links + known)
        assert len(found) == len(set(joined(n, known))) - len(set(joined(n, found + known)))


def test_texts_of_one_template_make_no_pairs(spark):
    """Every two of them are 72 % alike: none is a link, all meet, and what leaves the tasks is nothing."""
    rng = random.Random(13)
    base = prose(rng, 260, 10**6)
    texts = [base + " " + prose(rng, 50, 10**6) for _ in range(60)]
    assert all(0.70 < len(shingles(texts[0]) & shingles(t)) / len(shingles(texts[0]) | shingles(t)) < 0.75 for t in texts[1:])
    got = op6_minhash.near_duplicates(documents(spark, list(enumerate(texts)))).collect()
    assert all(r.kept for r in got) and len(got) == 60
    stars = spark.createDataFrame([(b, 0, i) for b in range(8) for i in range(60)], "bucket long, centre long, node long")
    sizes = spark.createDataFrame([(i, len(shingles(t))) for i, t in enumerate(texts)], "node long, n_shingles long")
    open_ = op6_minhash._open_stars(stars, spark.createDataFrame([], "node long, root long"), sizes)
    assert open_.count() == 60  # once, whatever the number of buckets
    assert op6_minhash._further_links(open_, spark.createDataFrame(list(enumerate(texts)), "doc long, text string"), 75).count() == 0


def test_near_duplicates_without_rows_and_stage(spark):
    docs = documents(spark, awkward(random.Random(4)))
    assert op6_minhash.near_duplicates(docs.limit(0)).count() == 0
    kept = op6_minhash.keep_one_of_each(docs)
    assert kept.dtypes == docs.dtypes
    assert {r.doc_id for r in kept.collect()} >= {-3, 2, 7, 8, 11, 15}


def test_second_pass_bounds_both_sides(spark, monkeypatch):
    """Every member its own component: no task holds all that ask, and every pair meets once."""
    n = 300
    monkeypatch.setattr(op6_minhash, "BLOCK_ROWS", 20)

    def search(_):
        def run(group):
            asks, node = group.column("asks").to_numpy(), group.column("node").to_numpy()
            a, b = np.meshgrid(node[asks], node[~asks], indexing="ij")
            return pa.table({"a": np.append(a.ravel(), -1), "b": np.append(b.ravel(), len(node))})
        return run

    monkeypatch.setattr(op6_minhash, "_search_star", search)
    stars = spark.createDataFrame([(1, 0, i) for i in range(n)], "bucket long, centre long, node long")
    sizes = spark.createDataFrame([(i, 1) for i in range(n)], "node long, n_shingles long")
    texts = spark.createDataFrame([(i, "") for i in range(n)], "doc long, text string")
    open_ = op6_minhash._open_stars(stars, spark.createDataFrame([], "node long, root long"), sizes)
    got = [tuple(r) for r in op6_minhash._further_links(open_, texts, 75).collect()]
    sizes, pairs = [b for a, b in got if a < 0], [r for r in got if r[0] >= 0]
    assert max(sizes) <= 80 and len(sizes) > 200
    odd = {a for a, _ in pairs}
    assert len(odd) == n - 1 and len(pairs) == len(set(pairs)) == (n - 1) * n


def test_wide_sketch_loses_no_link_of_small_sets():
    """Pairs of exactly 75 % whose estimates miss by most still lead to a confirmation, at every size."""
    tool, own, rng = OnePermutation(op6_minhash.WIDE_BINS, probes=False), op6_minhash.salt(op6_minhash.WIDE_BINS, 17), np.random.default_rng(5)
    for union, trials in ((8, 4000), (20, 2000), (200, 1000), (2000, 300)):
        sketches, least = ([], []), []
        for _ in range(trials):
            x = rng.permutation(np.unique(rng.integers(0, 2**64, union, dtype=np.uint64)))
            k, d = union // 4, rng.integers(0, union // 4 + 1)
            a, b = np.sort(x[d:]), np.sort(np.concatenate([x[:d], x[k:]]))
            for out, s in zip(sketches, (a, b)):
                out.append(op6_minhash.wide_sketch(tool, s, own))
            least.append(min(len(a), len(b)))
        same = op6_minhash.agreement(*(op6_minhash._unpacked(pa.array(s)) for s in sketches))
        assert (same >= op6_minhash._least_agreement(75, np.array(least))).all()
        assert same.std() < 0.02 and abs(same.mean() - 0.75) < 0.03


def test_rows_without_id_and_repeated_rows(spark):
    rng = random.Random(11)
    x, y, z = (prose(rng, 60, 5000) for _ in range(3))
    rows = [(5, x), (7, y), (None, x + " more"), (None, y + " more"), (None, z), (None, z), (None, z + " more"), (9, "a b c d e f"), (9, "a b c d e f"),
            (None, None), (None, None), (30, prose(rng, 40, 5000))]
    got = order((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op6_minhash.near_duplicates(documents(spark, rows)).collect())
    component = [5, 7, 5, 7, None, None, None, 9, 9, None, None, 30]
    assert got == order((d, len(shingles(t)), c, d == c) for (d, t), c in zip(rows, component))
    kept = [(r.doc_id, r.text) for r in op6_minhash.keep_one_of_each(documents(spark, rows).withColumn("row", F.lit("x"))).collect()]
    groups = [{rows[0]}, {rows[1]}, {rows[4], rows[6]}, {rows[7]}, {rows[9]}, {rows[9]}, {rows[11]}]
    assert len(kept) == len(groups) and all(any(k in g for k in kept) for g in groups) and kept.count((None, None)) == 2


def test_rows_of_one_id_in_several_classes(spark):
    """Their component is common, but the stage drops no text that is like no other one."""
    rng = random.Random(12)
    x, y = prose(rng, 60, 5000), prose(rng, 60, 5000)
    rows = [(2, x), (9, x + " more"), (9, y), (30, y + " more"), (40, prose(rng, 50, 5000))]
    got = [tuple(r) for r in op6_minhash.near_duplicates(documents(spark, rows)).collect()]
    assert order(got) == order(brute_components(rows)) and sum(r[2] == 2 for r in got) == 4
    assert order((r.doc_id, r.text) for r in op6_minhash.keep_one_of_each(documents(spark, rows)).collect()) == order([rows[0], rows[2], rows[4]])


def brute_windows(rows):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - 12):
            k = tuple(w[i:i + 13])
            first[k] = min(first.get(k, LAST), LAST if d is None else d)
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < (LAST if d is None else d):
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 22])
def test_substring_dedup_against_brute_force(spark, chunk_bytes):
    rng = random.Random(5)
    rows = awkward(rng)
    passage = prose(rng, 70)
    rows += [(300 + i, prose(rng, rng.randrange(0, 40)) + " " + passage + "\n" + prose(rng, 20)) for i in range(30)]
    if chunk_bytes == 300:  # a chunk for nearly every text
        rows = [r for r in rows if r[0] != 15]
    got = [tuple(r) for r in op7_substrings.dedup_substrings(documents(spark, rows), chunk_bytes).collect()]
    assert order(got) == order(brute_windows(rows))


def test_substring_dedup_without_rows(spark):
    assert op7_substrings.dedup_substrings(documents(spark, [(1, "x")]).limit(0)).count() == 0


def test_probe_sequences_of_empty_bins():
    """Few and many occupied bins name the same donors."""
    tool = OnePermutation(64)
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 23, 24, 30, 60):
        held = np.sort(rng.choice(64, n, replace=False))
        full = np.zeros(64, bool)
        full[held] = True
        empty = np.flatnonzero(~full)
        assert [next(j for j in tool.probe[i] if full[j]) for i in empty] == tool._donors(empty, held, full).tolist()


def test_sketch_agrees_as_often_as_sets_overlap():
    rng = np.random.default_rng(2)
    tool, agree = OnePermutation(128), []
    for _ in range(200):
        x = np.unique(rng.integers(0, 2**64, 45, dtype=np.uint64))
        agree.append((tool(x[:36]) == tool(x[9:])).mean())  # Jaccard 27 / 45
    assert abs(np.mean(agree) - 0.6) < 0.02


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_brute_force(spark):
    rows = awkward(random.Random(6))
    got = [tuple(r) for r in op9_fingerprints.compare_with_next(documents(spark, rows)).collect()]
    by = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want, near = [], {}
    for (d, t), (_, n) in zip(by, by[1:] + by[:1]):
        t, n = t or "", n or ""
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        want.append((d, len(t), edited))
        near.setdefault(d, []).append((jaccard(shingles(t), shingles(edited)), jaccard(shingles(t), shingles(n))))
    assert order(r[:3] for r in got) == order(want)
    for r in got:
        assert 0 <= r[5] <= 1 and 0 <= r[6] <= 1
        assert any(abs(r[5] - x) < 0.16 and abs(r[6] - y) < 0.16 for x, y in near[r[0]])
    prints = {r[0]: r[3] for r in got}
    assert prints[2] == prints[5] != prints[15] and prints[7] == prints[8] == prints[11] == ""


def test_fingerprints_of_one_and_no_row(spark):
    docs = documents(spark, [(4, "a b c d e f g")])
    (r,) = op9_fingerprints.compare_with_next(docs).collect()
    assert r.edited_text == "a b c da b c " and r.near_next == 1.0
    assert op9_fingerprints.compare_with_next(docs.limit(0)).count() == 0
    assert op9_fingerprints.fingerprint(docs).first().fingerprint == r.fingerprint


def test_bitmap_lets_all_its_ids_pass(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ids, others = rng.integers(-2**63, 2**63, 3000), rng.integers(-2**63, 2**63, 20_000)
    frame = spark.createDataFrame([(int(i),) for i in ids], "id long")
    bits = op6_minhash.marked(frame).value
    assert op6_minhash.passes(bits, ids).all() and op6_minhash.passes(bits, others).mean() < 0.03
    assert not op6_minhash.passes(op6_minhash.marked(frame.limit(0)).value, ids).any()
    monkeypatch.setattr(op6_minhash, "MOST_MARKS", op6_minhash.PAGE_BITS)
    bits = op6_minhash.marked(frame).value
    assert len(bits) == op6_minhash.PAGE_BITS // 8 and op6_minhash.passes(bits, ids).all()


@pytest.mark.parametrize("all_pass", [False, True])
def test_texts_and_sketches_are_not_shuffled_to_be_chosen(spark, monkeypatch, all_pass):
    """The texts of star members are found where they lie, classes without sketches; what passes too much changes nothing."""
    plans, whole = {}, op6_minhash.stored

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return whole(df, name)

    monkeypatch.setattr(op6_minhash, "stored", noted)
    if all_pass:
        monkeypatch.setattr(op6_minhash, "marked", lambda ids: spark.sparkContext.broadcast(np.full(4096, 255, np.uint8)))
    rng = random.Random(23)
    rows = awkward(rng) + [(1000 + i, t) for i, t in enumerate(chain(rng, 8))]
    rows += [(2000 + i, t) for i, (_, t) in enumerate(rows[:4])]
    got = [tuple(r) for r in op6_minhash.near_duplicates(documents(spark, rows)).collect()]
    assert order(got) == order(brute_components(rows))
    assert "Exchange" not in plans["involved-texts"]
    assert "sketch:binary" not in plans["classes"]
