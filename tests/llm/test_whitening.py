"""Whitening against plain numpy: exact whole numbers, and numpy's own eigenvectors up to their sign."""

import math
import random

import numpy as np
import pytest

from barforge.llm import op13_whitening
from barforge.llm.op13_whitening import eigenvectors, polar_factor, whiten


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<float>, label int, x string, v double")


def brute(rows, components=16):
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    size = max(set(lengths), key=lambda k: (lengths.count(k), k))
    good = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in good if len(v) == size]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(x[j] for x in fit) for j in range(size)]
    y = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for i, x in good:
        z = [n * a - s for a, s in zip(x, sums)]
        for k in range(min(components, size)):
            if e[k] > 1e-11 * e[0]:
                out.setdefault((i, k + 1), []).append((n, sum(a * a for a in z), float(np.array(z) / n @ q[:, k] / math.sqrt(e[k])), e[k] / np.trace(cov)))
    return out


def held_to(got, want):
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, r.whitened, r.explained))
        assert r.identity_error <= 1e-4
    assert by.keys() == want.keys() and all(len(by[k]) == len(want[k]) for k in by)
    signs = {}
    for key in sorted(by, key=repr):
        for (n, dev, white, part), (n2, dev2, white2, part2) in zip(sorted(by[key], key=lambda r: r[1]), sorted(want[key], key=lambda r: r[1])):
            assert (n, dev) == (n2, dev2) and abs(part - part2) <= 1e-9 * part2
            if abs(white2) > 1e-3:
                sign = signs.setdefault(key[1], 1 if white * white2 > 0 else -1)
                assert abs(white - sign * white2) < 1e-7 * max(1, abs(white2))


def test_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(op13_whitening, "ROWS", 64)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((500, 24)) @ (rng.standard_normal((24, 24)) / 4)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(7, rows[7][1])]  # copies, a repeated row
    rows += [(2000, None), (2001, []), (2002, [1.0, None] + [0.0] * 22), (2003, [float("nan")] * 24), (2004, [float("-inf")] + [0.0] * 23),
             (None, rows[3][1]), (2005, [1.0, 2.0]), (9, rows[11][1])]
    random.Random(1).shuffle(rows)
    held_to(whiten(vectors(spark, rows)).collect(), brute(rows))


def test_few_dimensions_and_no_variance(spark):
    rows = [(1, [0.5, 1.0]), (2, [1.5, 1.0]), (3, [2.0, 1.0])]
    got = whiten(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1} and len(got) == 3 and all(abs(r.explained - 1) < 1e-12 for r in got)
    held_to(got, brute(rows))
    for none in ([(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, None)], [(1, [])]):
        assert whiten(vectors(spark, none)).count() == 0
    assert whiten(vectors(spark, rows).limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(Exception):
        whiten(vectors(spark, [(1, [1e30]), (2, [2e30])])).count()


@pytest.mark.parametrize("kind", ["wishart", "clusters", "graded", "rank", "equal", "diagonal"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(len(kind))
    for n in (1, 2, 5, 33, 64):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        d = {"wishart": np.sort(rng.random(n)) + 0.01, "clusters": np.repeat([1.0, 2.0, 3.0], n)[:n], "graded": 10.0 ** -np.arange(n), "rank": np.r_[np.arange(1.0, 1 + n // 2), np.zeros(n - n // 2)],
             "equal": np.ones(n), "diagonal": np.arange(1.0, n + 1)}[kind]
        a = np.diag(d) if kind == "diagonal" else q @ np.diag(d) @ q.T
        values, x = eigenvectors(a)
        assert np.allclose(values, np.sort(d)[::-1], atol=1e-13 * n * d.max())
        assert np.abs(x.T @ x - np.eye(n)).max() <= 1e-13 * n and np.abs(a @ x - x * values).max() <= 1e-13 * n * d.max()


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(4)
    for n in (1, 4, 40):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        d = rng.choice([-1, 1], n) * 10.0 ** -rng.uniform(0, 8, n)
        assert np.abs(polar_factor(q @ np.diag(d) @ q.T) - q @ np.diag(np.sign(d)) @ q.T).max() < 1e-7
