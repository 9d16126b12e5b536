"""Windows of W symbols that occur more than once: cutting texts into segments by minimizers.

The minimizer of a window is its k-gram with the smallest hash (the leftmost of
equals). It depends on the window's content only, so equal windows have equal
minimizers at equal places. A maximal run of windows with one minimizer is a
segment; windows of different segments can be equal only if the segments' minimizers
are. Every window belongs to exactly one segment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import U64, prefix, span_hash

_PLACE = 28


@dataclass
class Segments:
    """Per segment: minimizer hash, content hash, first symbol, windows in it, place of the minimizer."""

    key: np.ndarray
    digest: np.ndarray
    start: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.key)


def sliding_min(values: np.ndarray, m: int) -> np.ndarray:
    """Minimum of each m consecutive values."""
    out, span = values, 1
    while 2 * span <= m:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(values) - m + 1], out[m - span:]) if span < m else out


def window_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """All positions where a window of one document starts; ``bounds`` are document offsets."""
    sizes = np.maximum(np.diff(bounds) - width + 1, 0)
    return np.repeat(bounds[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def segments(symbols: np.ndarray, bounds: np.ndarray, width: int, k: int) -> tuple[Segments, np.ndarray]:
    """Segments of concatenated documents, and the prefix sums for further hashes of spans."""
    sums = prefix(symbols)
    starts = window_starts(bounds, width)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Segments(np.zeros(0, U64), np.zeros(0, U64), none, none), sums
    at = np.arange(len(symbols) - k + 1)
    gram = span_hash(sums, at, at + k)
    ranked = (gram & ~U64((1 << _PLACE) - 1)) | at.astype(U64)
    place = (sliding_min(ranked, width - k + 1)[starts] & U64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    return Segments(gram[place[first]], span_hash(sums, begin, begin + count + width - 1), begin, count), sums
