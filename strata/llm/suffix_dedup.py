"""Operator 3: removal of repeated byte strings through suffix arrays made by deep-shallow sorting.

Each byte of a string of ``width`` bytes that also starts anywhere else, in the same
document or another, is removed; matches never cross documents, and strings are
judged on the input. Texts are cut into segments by content (repeats.py), so a task
sorts the suffixes of only those segments that may share a string.

Sorting is deep-shallow: a multikey quicksort on eight-byte characters, with
three-way partitions of all open groups at once, orders suffixes to a shallow depth;
groups that still agree there have long common prefixes and are ordered by a blind
trie each. Neighbours whose longest common prefix reaches ``width`` are equal strings.

Null text counts as empty and is kept as it is. Texts under ``width`` bytes lose
nothing. Repeated rows are further copies, so they lose all that they share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SYMBOLS, prefix, span_hash, text_bytes, without
from .decontaminate import covered
from .repeats import Repeats, run

WIDTH = 200
SHALLOW = 64


def words_at(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number; ``raw`` ends in eight spare bytes."""
    out = np.zeros(len(at), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | raw[at + j]
    return out


def shallow_sort(raw: np.ndarray, at: np.ndarray, depth: int, buckets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by their first ``depth`` bytes (a multiple of eight), and where a new prefix begins.

    ``buckets`` marks the firsts of groups that are sorted each on its own. Every open group picks a pivot character and is split into smaller, equal and larger ones;
    the equal part goes on with its next character. Groups advance together.
    """
    order = at.copy()
    n = len(order)
    done = np.zeros(n, bool)       # position belongs to a group that is settled
    head = np.zeros(n, bool)       # a group begins here
    level = np.zeros(n, np.int64)  # bytes on which the group agrees
    if n:
        head[0] = True
        if buckets is not None:
            head |= buckets
    rng = np.random.default_rng(5)
    while True:
        starts = np.flatnonzero(head)
        sizes = np.diff(np.append(starts, n))
        settled = (sizes == 1) | (level[starts] >= depth)
        done = np.repeat(settled, sizes)
        open_groups = np.flatnonzero(~settled)
        if not len(open_groups):
            return order, head
        where = np.flatnonzero(~done)
        size = sizes[open_groups]
        first = np.cumsum(size) - size
        group = np.repeat(np.arange(len(size)), size)
        char = words_at(raw, order[where] + level[where])
        pivot = char[first + (rng.random(len(size)) * size).astype(np.int64)][group]
        less, equal = char < pivot, char == pivot
        n_less, n_equal = np.add.reduceat(less, first), np.add.reduceat(equal, first)
        seen_less, seen_equal = np.cumsum(less) - less, np.cumsum(equal) - equal
        nth_less, nth_equal = seen_less - seen_less[first][group], seen_equal - seen_equal[first][group]
        nth_more = np.arange(len(where)) - first[group] - nth_less - nth_equal
        target = first[group] + np.where(less, nth_less, np.where(equal, n_less[group] + nth_equal, (n_less + n_equal)[group] + nth_more))
        moved = np.empty_like(where)
        moved[target] = order[where]
        deeper = np.empty(len(where), bool)
        deeper[target] = equal
        order[where] = moved
        level[where] += 8 * deeper
        for offset in (n_less, n_less + n_equal):
            inner = first + offset
            ok = offset < size
            head[where[inner[ok]]] = True


class BlindTrie:
    """Orders strings of one length: inner nodes keep only a depth and branching bytes, leaves a string and all that equal it."""

    def __init__(self, text: bytes, member: int):
        self.root: object = [text, member]

    def insert(self, text: bytes, member: int) -> None:
        # blind search: follow branching bytes alone to some leaf
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(text[depth]) or next(iter(children.values()))
        other = node[0]
        if text == other:
            node.append(member)
            return
        at = next(i for i in range(0, len(text), 16) if text[i:i + 16] != other[i:i + 16])
        while text[at] == other[at]:
            at += 1
        # the new branch goes where the searched path first passes that depth
        parent, node, leaf = None, self.root, [text, member]
        while isinstance(node, tuple) and node[0] < at:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node, tuple) and node[0] == at:
            node[1][text[at]] = leaf
            return
        branch = (at, {other[at]: node, text[at]: leaf})
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch

    def ordered(self) -> list[list[int]]:
        """Members in the order of their strings, those of equal strings together."""
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                out.append(node[1:])
        return out


def deep_order(raw: bytes, members: list[int], depth: int, width: int) -> list[list[int]]:
    """A group that agrees on ``depth`` bytes, ordered by its first ``width`` bytes; equal strings stand together."""
    trie = BlindTrie(raw[members[0] + depth:members[0] + width], members[0])
    for m in members[1:]:
        trie.insert(raw[m + depth:m + width], m)
    return trie.ordered()


def sort_windows(raw: np.ndarray, at: np.ndarray, width: int, shallow: int = SHALLOW, buckets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Window positions in the order of their ``width`` bytes, and which ones differ from their predecessor
    (a longest common prefix below ``width``). ``buckets`` marks where a group begins that is sorted on its own."""
    data = np.concatenate([raw, np.zeros(8, np.uint8)])
    shallow = min(shallow, width - width % 8)
    order, head = shallow_sort(data, at, shallow, buckets)
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, len(order)))
    text, out, new = raw.tobytes(), order.copy(), np.ones(len(order), bool)
    for s, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        k = s
        for same in deep_order(text, order[s:s + size].tolist(), shallow, width):
            out[k:k + len(same)] = same
            new[k + 1:k + len(same)] = False
            k += len(same)
    return out, new


class SuffixRepeats(Repeats):
    by_doc = False

    def __init__(self, width: int = WIDTH, kept: str | None = None, text: str = "text"):
        self.width, self.k, self.kept, self.text = width, min(24, max(1, width // 2)), kept, text

    def symbols(self, raw, offsets):
        return SYMBOLS[raw], offsets

    def content(self, symbols, raw, a, b):
        return raw[a:b].tobytes()

    def from_content(self, data):
        return np.frombuffer(data, np.uint8)

    def resolve(self, sent, content):
        raw = np.concatenate(content)
        sizes = np.array([len(c) for c in content], np.int64)
        counts = sizes - self.width + 1
        first = np.cumsum(sizes) - sizes
        segment = np.repeat(np.arange(len(sizes)), counts)
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        # equal windows have equal minimizers at equal places, so windows are sorted within (minimizer, distance to it)
        sums = prefix(SYMBOLS[raw])
        grams = np.flatnonzero(span_hash(sums, np.arange(len(raw) - self.k + 1), np.arange(self.k, len(raw) + 1))
                               == np.repeat(sent["key"], sizes)[:len(raw) - self.k + 1])
        place = grams[np.searchsorted(grams, first)]  # the minimizer is the first of its kind in a segment
        minimizer = np.cumsum(np.append(True, sent["key"][1:] != sent["key"][:-1]))
        bucket = minimizer[segment] * self.width + place[segment] - at
        order = np.argsort(bucket, kind="stable")
        begins = np.append(True, bucket[order][1:] != bucket[order][:-1])
        shared = ~(begins & np.append(begins[1:], True))  # alone in its bucket, a window has nothing to be sorted with
        order, begins = order[shared], begins[shared]
        value = sent["n"].astype(np.int64)[segment]
        if len(order):
            which = np.zeros(len(raw), np.int64)
            which[at] = np.arange(len(at))
            in_order, new = sort_windows(raw, at[order], self.width, buckets=begins)
            windows = which[in_order]
            group = np.flatnonzero(new)
            total = np.add.reduceat(value[windows], group)
            value[windows] = np.repeat(total, np.diff(np.append(group, len(windows))))
        value = np.minimum(value, 2)  # whether a window repeats is all that is asked
        return np.split(value, np.cumsum(counts)[:-1])

    def finish(self, batch, starts, counts, bounds):
        raw, offsets = text_bytes(batch.column(self.text))
        gone = covered(len(raw), starts, starts + counts + self.width - 1)
        before = np.concatenate([[0], np.cumsum(gone)])
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        inner = offsets[:-1][offsets[:-1] < len(raw)]
        edge[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(edge)])
        left = [raw[a:b] if before[a] == before[b] else raw[a:b][~gone[a:b]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        added = {
            "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(before[offsets[1:]] - before[offsets[:-1]]),
            "n_spans": pa.array(spans[offsets[1:]] - spans[offsets[:-1]]), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string()),
        }
        if self.kept:
            nulls = batch.column(self.text).is_null().to_pylist()
            added[self.kept] = pa.array([None if n else t.tobytes().decode("utf-8", "ignore") for t, n in zip(left, nulls, strict=True)], pa.string())
        names = [n for n in batch.schema.names if n not in added]
        return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *added.values()], [*names, *added])


def dedup(docs: DataFrame, width: int = WIDTH, text: str = "text", doc: str = "doc_id", kept: str | None = None, **options) -> DataFrame:
    """Add n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; ``kept`` names a column for the text that is
    left (bytes of characters that were cut through are dropped)."""
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
             T.StructField("kept_sha256", T.StringType())]
    if kept:
        added.append(T.StructField(kept, T.StringType()))
    docs = without(docs, [f.name for f in added], [text, doc])
    return run(docs.withColumn(text, F.col(text).cast("string")), SuffixRepeats(width, kept, text), added, text, doc, **options)
