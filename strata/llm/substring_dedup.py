"""Operator 4: removal of repeated word windows through a compressed FM-index per shard.

Each word of a window of ``width`` words whose word sequence also starts in a
document with a smaller doc_id is removed; windows are judged on the input. Texts
are cut into segments by content (repeats.py); a shard is the segments that a task
receives. Their words are indexed (wavelet tree over the BWT), and the segments
are streamed through the index from right to left: backward search keeps the
suffix-array interval of the matched words, and at ``width`` words the interval is
first widened to that of one word less, so each step gives the matching
statistic capped at ``width``. An interval at the threshold reports the smallest doc_id among its rows.

Null text has no words. A null doc_id comes after every other, and rows that repeat
a doc_id do not remove each other's words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE_WORD, prefix, span_hash, text_bytes, words, without
from .decontaminate import covered
from .fm_index import FMIndex
from .repeats import Repeats, run

WIDTH = 50


class Shard:
    """FM-index of several word sequences with the document of each suffix-array row."""

    def __init__(self, sequences: list[np.ndarray], docs: np.ndarray, width: int):
        flat = np.concatenate(sequences)
        sizes = np.array([len(s) for s in sequences], np.int64)
        self.vocabulary, codes = np.unique(flat, return_inverse=True)
        ends = np.cumsum(sizes)
        seq = np.insert(codes.ravel() + 2, ends, 1)  # 0 is the end mark, 1 ends a sequence
        self.index, self.width = FMIndex(seq, len(self.vocabulary) + 2), width
        owner = np.append(np.repeat(np.arange(len(sizes)), sizes + 1), 0)
        rows = self.index.order
        limit = np.append(np.repeat(ends + np.arange(len(sizes)), sizes + 1), 0)
        sums = prefix(np.append(seq, 0).astype(np.uint64))
        room = limit[rows] - rows

        def classes(length: int) -> tuple[np.ndarray, np.ndarray]:
            """First row of each row's class of suffixes that agree on ``length`` words, and the class starts."""
            end = np.minimum(rows + length, len(seq))
            marks = np.where(room >= length, span_hash(sums, rows, end), 0)
            new = np.ones(len(rows), bool)
            new[1:] = (marks[1:] != marks[:-1]) | (room[1:] < length) | (room[:-1] < length)
            return np.cumsum(new) - 1, np.flatnonzero(new)

        self.wide, wide_starts = classes(width - 1)
        self.wide_low, self.wide_high = wide_starts, np.append(wide_starts[1:], len(rows))
        self.full, starts = classes(width)
        self.least = np.minimum.reduceat(np.asarray(docs, np.int64)[owner[rows]], starts)

    def stream(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """For each window of each sequence, the smallest document that has it (all sequences advance together)."""
        sizes = np.array([len(s) for s in sequences], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        codes = np.searchsorted(self.vocabulary, np.concatenate(sequences)) + 2
        out = [np.zeros(max(0, n - self.width + 1), np.int64) for n in sizes]
        found = np.zeros(len(codes), np.int64)
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.index.n, np.int64)
        for back in range(1, int(sizes.max()) + 1):
            live = np.flatnonzero(sizes >= back)
            if back > self.width:
                shorter = self.wide[low[live]]
                low[live], high[live] = self.wide_low[shorter], self.wide_high[shorter]
            at = offsets[live + 1] - back
            low[live], high[live] = self.index.step(codes[at], low[live], high[live])
            if back >= self.width:
                found[at] = self.least[self.full[low[live]]]
        for k in range(len(sizes)):
            out[k] = found[offsets[k]:offsets[k] + len(out[k])]
        return out


class WordRepeats(Repeats):
    by_doc = True

    def __init__(self, width: int = WIDTH, kept: str | None = None, text: str = "text"):
        self.width, self.k, self.kept, self.text = width, min(8, max(1, width // 2)), kept, text

    def symbols(self, raw, offsets):
        hashes, _, _, bounds = words(raw, offsets, SPACE_WORD, lower=False)
        return hashes, bounds

    def resolve(self, sent, content):
        return Shard(content, sent["doc"], self.width).stream(content)

    def finish(self, batch, starts, counts, bounds):
        raw, offsets = text_bytes(batch.column(self.text))
        n = int(bounds[-1])
        gone = covered(n, starts, starts + counts + self.width - 1)
        before = np.concatenate([[0], np.cumsum(gone)])
        left = []
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            found = raw[a:b].tobytes().translate(_ONE_SPACE).split()
            mine = gone[bounds[i]:bounds[i + 1]]
            left.append(b" ".join(found if not mine.any() else [w for w, g in zip(found, mine.tolist(), strict=True) if not g]))
        added = {
            "n_words": pa.array(np.diff(bounds)), "n_removed": pa.array(before[bounds[1:]] - before[bounds[:-1]]),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string()),
        }
        if self.kept:
            added[self.kept] = pa.array([t.decode("utf-8") for t in left], pa.string())
        names = [c for c in batch.schema.names if c not in added]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *added.values()], [*names, *added])


_ONE_SPACE = bytes(0x20 if not w else b for b, w in enumerate(SPACE_WORD.tolist()))


def dedup(docs: DataFrame, width: int = WIDTH, text: str = "text", doc: str = "doc_id", kept: str | None = None, **options) -> DataFrame:
    """Add n_words, n_removed, kept_sha256; ``kept`` names a column for the words that are left, joined by one space."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if kept:
        added.append(T.StructField(kept, T.StringType()))
    docs = without(docs, [f.name for f in added], [text, doc])
    return run(docs.withColumn(text, F.col(text).cast("string")), WordRepeats(width, kept, text), added, text, doc, **options)
