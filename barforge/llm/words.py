"""Words of whole texts, their hashes, shingles and one-permutation MinHash,
vectorised over the bytes of an Arrow string column (runs inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text whose words are worked on at a time (more for one longer text).
GROUP_BYTES = 1 << 21
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def salt(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit integers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(seed))


class Hasher:
    """64-bit hash of byte ranges: a polynomial over randomised byte values,
    from prefix sums, then scrambled."""

    def __init__(self, seed: int, fold_case: bool, skip: bytes = b""):
        values = salt(256, seed)
        if fold_case:
            values = values[_FOLD]
        if skip:
            values[list(skip)] = 0
        self.values, self.seed = values, np.uint64(seed)
        self.base = int(salt(1, seed + 1)[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._pow = self._inv = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._pow) < n:
            size = 1 << n.bit_length()
            steps = np.full(size, self.base, np.uint64)
            back = np.full(size, self.inverse, np.uint64)
            steps[0] = back[0] = 1
            self._pow, self._inv = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        return self._pow, self._inv

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            lo = int(starts[at])
            to = max(at + 1, int(np.searchsorted(starts, lo + (1 << 18))))
            hi = int(ends[at:to].max())
            power, inverse = self._powers(hi - lo)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(self.values[data[lo:hi]] * power[:hi - lo], out=sums[1:])
            a, b = starts[at:to] - lo, ends[at:to] - lo
            out[at:to] = (sums[b] - sums[a]) * inverse[a]
            at = to
        return mix(out + self.seed)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def text_groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of rows of about GROUP_BYTES."""
    data, at = buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + GROUP_BYTES, "right")) - 1))
        yield lo, hi, data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def find_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, by text,
    the number of the first one."""
    n = len(data)
    inside = ~_SPACE[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def window_hash(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = salt(width, seed) | np.uint64(1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += words[j:j + n] * factor[j]
    return mix(out)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The sorted distinct 5-word shingles of one text's word hashes; fewer
    words are one shingle, no words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hash(words, min(SHINGLE, len(words)), 77))


_folded = Hasher(11, fold_case=True)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    for lo, hi, data, at in text_groups(column):
        starts, ends, first = find_words(data, at)
        hashes = _folded(data, starts, ends)
        for i in range(hi - lo):
            yield shingle_set(hashes[first[i]:first[i + 1]])


class OnePermutation:
    """One-permutation MinHash with optimal densification.

    A set's hashes are binned once by their top bits and each bin keeps its
    least hash.  An empty bin copies the first occupied bin on its own fixed
    pseudorandom probe sequence, which visits every bin once; so two sets agree
    in a bin with the probability of their Jaccard similarity.
    """

    def __init__(self, bins: int, probes: bool = True):
        """``probes``: whether empty bins are to be filled; else there are only ``minima``."""
        self.bins, self.shift = bins, np.uint64(64 - (bins.bit_length() - 1))
        if bins & (bins - 1):
            raise ValueError("bins must be a power of two")
        if not probes:
            return
        keys = salt(bins * bins, 101).reshape(bins, bins)
        self.probe = np.argsort(keys, axis=1).astype(np.int32)
        self.turn = np.empty_like(self.probe)
        np.put_along_axis(self.turn, self.probe, np.arange(bins, dtype=np.int32)[None, :].repeat(bins, 0), 1)

    def minima(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The occupied bins of a non-empty sorted set, and their least hashes."""
        bins = (shingles >> self.shift).astype(np.int64)
        new = np.empty(len(bins), bool)
        new[0] = True
        np.not_equal(bins[1:], bins[:-1], out=new[1:])
        return bins[new], shingles[new]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """``bins`` 64-bit minima of a non-empty sorted set."""
        held, least = self.minima(shingles)
        out = np.zeros(self.bins, np.uint64)
        out[held] = least
        if len(held) < self.bins:
            full = np.zeros(self.bins, bool)
            full[held] = True
            empty = np.flatnonzero(~full)
            out[empty] = out[self._donors(empty, held, full)]
        return out

    def _donors(self, empty: np.ndarray, held: np.ndarray, full: np.ndarray) -> np.ndarray:
        if len(held) == 1:
            return np.full(len(empty), held[0])
        if len(held) < 24:  # the same donor, found from the few occupied bins
            return held[self.turn[np.ix_(empty, held)].argmin(1)]
        hit = full[self.probe[empty, :24]]
        turn = hit.argmax(1)
        rest = np.flatnonzero(~hit[np.arange(len(empty)), turn])
        if len(rest):
            turn[rest] = full[self.probe[empty[rest]]].argmax(1)
        return self.probe[empty, turn]
