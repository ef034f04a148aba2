"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from barforge.llm import op12_trie
from barforge.llm.op12_trie import RangeMinimum, left_ends, right_ends

TURNS = "conv_id long, turn long, role string, text string, key string, id int, top int, depth int"


def conversations(spark, rows):
    """rows: (conv_id, turn, role, text); other columns have names that the operator uses inside."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], TURNS)


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h[c]] + own[c][h[c]:] for c in own}


def brute_trie(rebuilt):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def awkward_conversations(rng):
    say = ["hi", "", None, "how are you", "été \U0001f600", "b\x00c", "ok", "x" * 5000]
    rows = []
    for c in [*range(0, 60), *range(100, 130), 250, *range(-110, -90), 2**62]:
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "user", None, "assistant"]), rng.choice(say)))
    for c in range(300, 380):  # one very common conversation, and one that goes on
        rows += [(c, t, "user", f"common {t}") for t in range(6 + (c % 10 == 0))]
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(401, t, "user", f"long {t}") for t in range(300)]
    rows += [(500, 1, "user", "same"), (500, 1, "user", "same"), (501, 1, "user", "same"), (501, 1, "us", "ersame"), (None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(600 + i, 0, "user", "only one turn") for i in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("range_bytes", [1 << 23, 700])
def test_against_a_dictionary_of_prefixes(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(op12_trie, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(op12_trie, "PIECE_BYTES", 40)
    rows = awkward_conversations(random.Random(2))
    seqs = op12_trie.with_shared_heads(op12_trie.sequences(conversations(spark, rows)))
    rebuilt = brute_rebuilt(rows)
    assert {len(t) for t in rebuilt.values()} > {0, 1, 300}
    got = [tuple(r) for r in op12_trie.trie(seqs).collect()]
    assert sorted(got, key=repr) == brute_trie(rebuilt)


def test_few_and_no_conversations(spark):
    for rows in ([(7, 1, "u", "a")], [(7, 1, "u", "a"), (7, 2, "u", "b"), (8, 1, "u", "a")], [(100, None, None, None)]):
        got = [tuple(r) for r in op12_trie.trie(op12_trie.with_shared_heads(op12_trie.sequences(conversations(spark, rows)))).collect()]
        assert sorted(got, key=repr) == brute_trie(brute_rebuilt(rows))
    for rows in ([(None, 1, "u", "a")],):
        frame = conversations(spark, rows)
        for none in (frame, frame.limit(0)):
            out = op12_trie.trie(op12_trie.sequences(none))
            assert out.count() == 0 and out.columns[0] == "conv_id" and out.columns[-1] == "ends_sha256"


def test_extents_against_scans():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 33, 100):
        near = rng.integers(0, 5, n)
        table = RangeMinimum(near[1:])
        row, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        right, left = right_ends(table, n, row, depth), left_ends(table, row, depth)
        for i, d, r, x in zip(row, depth, right, left):
            assert all(near[i + 1:r + 1] >= d) and (r == n - 1 or near[r + 1] < d)
            assert all(near[x + 1:i + 1] >= d) and (x == 0 or near[x] < d)
