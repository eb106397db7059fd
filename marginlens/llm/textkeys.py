"""64-bit keys of words and word shingles, vectorised over Arrow batches.

Words are ``[^\\x20\\x09-\\x0D]+``; keys are equal for equal words in every
process.  Texts are worked through in stretches of bounded size, cut between
words, so memory follows the longest word, not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text whose word keys are computed at once.
STRETCH = 1 << 18

BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that a task holds little at once."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def _tables():
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return fold, space


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (SplitMix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), BASE, np.uint64)]))


def _stretch_keys(data: np.ndarray, space: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of each word; ``first`` marks positions where a text begins."""
    inside = ~space
    begins = inside.copy()
    begins[1:] &= space[:-1] | first[1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return at, np.empty(0, np.uint64)
    starts = np.flatnonzero(begins)
    word = np.cumsum(begins[at]) - 1
    place = at - starts[word]
    values = (data[at].astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    keys = np.add.reduceat(values, np.searchsorted(at, starts))
    lengths = np.bincount(word).astype(np.uint64)
    return starts, mixed(keys + lengths * STEP)


def word_keys(column: pa.Array, lower: bool = True) -> Iterator[np.ndarray]:
    """The keys of each text's words in order, text by text (NULL: none)."""
    fold, is_space = _tables()
    column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + STRETCH, "right")) - 1)
        j = min(j, n)
        lo, hi = int(bounds[i]), int(bounds[j])
        if hi - lo <= STRETCH:
            part = data[lo:hi]
            space = is_space[part]
            first = np.zeros(hi - lo + 1, bool)
            first[bounds[i:j] - lo] = True
            starts, keys = _stretch_keys(fold[part] if lower else part, space, first[:-1])
            cuts = np.searchsorted(starts, bounds[i:j + 1] - lo)
            for k in range(j - i):
                yield keys[cuts[k]:cuts[k + 1]]
        else:  # one long text
            found = []
            while lo < hi:
                end = min(lo + STRETCH, hi)
                gap = np.flatnonzero(is_space[data[lo:end]]) if end < hi else []
                if end < hi and not len(gap):  # a word longer than a stretch
                    rest = np.flatnonzero(is_space[data[end:hi]])
                    end = end + int(rest[0]) if len(rest) else hi
                elif end < hi:
                    end = lo + int(gap[-1]) + 1
                part = data[lo:end]
                first = np.zeros(end - lo, bool)
                found.append(_stretch_keys(fold[part] if lower else part, is_space[part], first)[1])
                lo = end
            yield np.concatenate(found)
        i = j


def shingle_keys(words: np.ndarray, size: int) -> np.ndarray:
    """Keys of a text's word shingles; with fewer words, of the whole sequence."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    size = min(n, size)
    keys = words[: n - size + 1].copy()
    for k in range(1, size):
        keys = keys * STEP + words[k:n - size + 1 + k]
    return mixed(keys + np.uint64(size))
