"""Sliding counts, sums and sums of squared deviations, shared by all widths.

A window of 4k rows is four windows of k rows that end here and k, 2k and 3k rows before;
so windows of 1, 4, 16, ... rows follow from each other by lags (numpy, a batch of sorted rows at a time), and
a window of any width is a few of them (50 = 3 * 16 + 2 * 1).  All widths of an input share these
levels, and a row costs a number of steps that grows with the logarithm of the widest window.

A window is (n, m, q): its non-NULL values, their mean, and the sum of their squared distances from
it.  Windows merge by ``m = m1 + sum((mi - m1) * ni) / n`` and ``q = sum(qi) + sum(ni * (mi - m)^2)``:
nothing cancels, equal values give their own mean and q = 0 exactly, and no running total
grows along the series.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barforge.operators.arrow import AT, Step, add_doubles, numbers

#: Windows of a level that make up one of the next.  Every level is a pass over the rows, so few levels are better than few lags.
RADIX = 4


def pieces(width: int) -> list[tuple[int, int]]:
    """(level, rows between its end and the window's) of the windows that make up ``width``, the widest first."""
    out, offset, level = [], 0, 0
    while RADIX ** (level + 1) <= width:
        level += 1
    for at in range(level, -1, -1):
        for _ in range((width - offset) // RADIX ** at):
            out.append((at, offset))
            offset += RADIX ** at
    return out


def merged(windows: list[tuple]) -> tuple:
    """The window that neighbouring windows (n, m, q or None) make together."""
    n = sum(w[0] for w in windows)
    first = windows[0][1]
    m = first
    for w in windows[1:]:
        m = m + (w[1] - first) * w[0] / np.maximum(n, 1.0)
    if windows[0][2] is None:
        return n, m, None
    q = sum(w[2] for w in windows)
    if len(windows) > 1:
        for w in windows:
            q = q + w[0] * (w[1] - m) * (w[1] - m)
    return n, m, q


def _lagged(window: tuple, k: int, at: np.ndarray) -> tuple:
    """The windows that end ``k`` rows before, empty before a block's first row."""
    if not k:
        return window
    out = []
    for part in window:
        if part is not None:
            shifted = np.zeros_like(part)
            shifted[k:] = part[:-k]
            shifted[at <= k] = 0.0
            part = shifted
        out.append(part)
    return tuple(out)


def _sliding(x: np.ndarray, held: np.ndarray, at: np.ndarray, widths: list[int], spread: bool) -> dict[int, tuple]:
    """(n, m, q) of the last k rows, for every width k."""
    levels = [(held.astype(np.float64), x, np.zeros(len(x)) if spread else None)]
    for level in range(pieces(max(widths))[0][0]):
        levels.append(merged([_lagged(levels[level], RADIX ** level * i, at) for i in range(RADIX)]))
    return {k: merged([_lagged(levels[level], offset, at) for level, offset in pieces(k)]) for k in widths}


def _moments(widths: dict[str, list[int]], spread: set[str]):
    """Step of ``add_doubles``: the rows that the windows of the next batch reach back to are kept."""
    back = max(k for ks in widths.values() for k in ks) - 1

    def run(batches):
        tail = None
        for b, at in batches:
            n, given = b.num_rows, {c: numbers(b.column(c)) for c in widths}
            if tail is not None:
                at = np.concatenate([tail[0], at])
                given = {c: tuple(np.concatenate(pair) for pair in zip(tail[1][c], own)) for c, own in given.items()}
            means, deviations = [], []
            with np.errstate(all="ignore"):
                for c, ks in widths.items():
                    found = _sliding(*given[c], at, ks, c in spread)
                    for k in ks:
                        count, mean, squares = (part[-n:] if part is not None else None for part in found[k])
                        means.append((mean, count == k))
                        if squares is not None:
                            deviations.append((np.sqrt(squares / k), count == k))
            from_row = max(0, len(at) - back)
            tail = at[from_row:], {c: (x[from_row:], held[from_row:]) for c, (x, held) in given.items()}
            yield means + deviations
    return run


def moments_step(widths: dict[str, Iterable[int]], spread: Iterable[str] = ()) -> Step:
    """The columns of ``add_sliding_moments`` as a step over numbered rows."""
    widths, spread = {c: sorted(set(ks)) for c, ks in widths.items() if ks}, set(spread)
    names = [f"_mean{k}_{c}" for c, ks in widths.items() for k in ks] + [f"_std{k}_{c}" for c, ks in widths.items() if c in spread for k in ks]
    return names, _moments(widths, spread)


def add_sliding_moments(d: DataFrame, w: WindowSpec, widths: dict[str, Iterable[int]], spread: Iterable[str] = ()) -> DataFrame:
    """``d`` with ``_mean{k}_{column}``, and for the columns in ``spread`` ``_std{k}_{column}`` (population), over the
    last k rows of ``w`` for every k in ``widths[column]``: NULL unless all k rows hold a value."""
    if not any(widths.values()):
        return d
    return add_doubles(d.withColumn(AT, F.row_number().over(w)), [moments_step(widths, spread)], drop=(AT,))
