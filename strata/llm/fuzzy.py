"""Operator 6: context-triggered piecewise hashing.

A rolling hash over ``ROLL`` bytes cuts a text wherever its low bits are zero, so
an edit moves only the cuts near it. One character per chunk makes the signature.
A fingerprint is ``block:signature:signature at twice the block``; the block size
is a power of two chosen from the length, and every chunk counts (no length
limit). Two fingerprints are compared where their block sizes meet: likeness is
1 - d / (length of both), d being the insert-and-delete edit distance of the
signatures, and 0 where no ``RUN`` characters in a row agree or no block size is shared.

Null counts as the empty text, whose fingerprint has empty signatures. Equal
texts have equal fingerprints whatever stands beside them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, mix, prefix, span_hash, stage, tidy

ROLL = 7
SMALLEST = 8
CHUNKS = 64
RUN = 4
HEAD = 16
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_SYMBOLS = mix(np.arange(1, 257, dtype=U64))
_ROLLING = (_SYMBOLS & U64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)


def _rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the ROLL bytes that end at each position (undefined for the first ROLL - 1)."""
    c, c2, c4 = (np.uint32(pow(0x2C1B3C6D, k, 1 << 32)) for k in (1, 2, 4))
    one = _ROLLING[raw]
    two, three, four = one.copy(), one.copy(), one.copy()
    two[1:] += c * one[:-1]
    three[:] = two
    three[2:] += c2 * one[:-2]
    four[:] = two
    four[2:] += c2 * two[:-2]
    seven = four
    seven[4:] += c4 * three[:-4]
    seven ^= seven >> np.uint32(15)
    seven *= np.uint32(0x297A2D39)
    return seven >> np.uint32(9)


def block_sizes(lengths: np.ndarray) -> np.ndarray:
    """The power of two that gives about CHUNKS / 2 to CHUNKS chunks, SMALLEST at least."""
    need = np.maximum(lengths, 1) / CHUNKS
    return np.maximum(SMALLEST, 2 ** np.ceil(np.log2(need)).clip(0, 40).astype(np.int64))


def fingerprints(texts: list[bytes]) -> list[str]:
    """Fingerprints of several texts, worked on together."""
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = block_sizes(lengths)
    if not len(raw):
        return [f"{s}::" for s in sizes]
    sums, rolled = prefix(_SYMBOLS[raw]), _rolling(raw)
    rolled[(offsets[:-1, None] + np.arange(ROLL - 1)).ravel().clip(max=len(raw) - 1)] = 1  # no full window yet
    mask = np.repeat((sizes - 1).astype(np.uint32), lengths)
    out = []
    for level in (0, 1):
        cuts = np.flatnonzero((rolled & mask) == 0) + 1
        ends = np.unique(np.concatenate([cuts, offsets[1:][lengths > 0]]))
        starts = np.concatenate([[0], ends[:-1]])
        chars = ALPHABET[(span_hash(sums, starts, ends) & U64(63)).astype(np.int64)].tobytes().decode()
        at = np.searchsorted(ends, offsets, side="right")
        out.append([chars[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
        mask = mask * np.uint32(2) + np.uint32(1)
    return [f"{s}:{a}:{b}" for s, a, b in zip(sizes, *out, strict=True)]


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word of positions at a time."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def signature_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    run = min(RUN, len(a), len(b))
    grams = {a[i:i + run] for i in range(len(a) - run + 1)}
    if not any(b[i:i + run] in grams for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))  # d = len(a) + len(b) - 2 * common


def likeness(x: str, y: str) -> float:
    """0 to 1; signatures are compared at the block sizes that both fingerprints have."""
    if x == y:
        return 1.0
    bx, x1, x2 = x.split(":")
    by, y1, y2 = y.split(":")
    bx, by = int(bx), int(by)
    if bx == by:
        return max(signature_likeness(x1, y1), signature_likeness(x2, y2))
    if bx == 2 * by:
        return signature_likeness(x1, y2)
    if by == 2 * bx:
        return signature_likeness(x2, y1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones (or all) of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _results(ids: list, texts: list[str], last_follows: str | None) -> list[tuple]:
    """Result tuples of consecutive documents; without ``last_follows`` the last one only lends its text."""
    follow = texts[1:] + ([last_follows] if last_follows is not None else [])
    changed = [edited(t, f).encode() for t, f in zip(texts, follow, strict=False)]
    whole = texts + ([last_follows] if last_follows is not None else [])
    marks = fingerprints([t.encode() for t in whole] + changed)
    own, new = marks[:len(whole)], marks[len(whole):]
    return [(i, len(t), hashlib.sha256(c).hexdigest(), own[k], new[k], likeness(own[k], new[k]), likeness(own[k], own[k + 1]))
            for k, (i, t, c) in enumerate(zip(ids, texts, changed, strict=False))]


_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(results: list[tuple], role: str | None = None, part: int | None = None, text: str | None = None) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in results], kind) for k, (_, kind) in enumerate(_FIELDS)]
    n = len(results)
    return pa.RecordBatch.from_arrays([*columns, pa.array([role] * n, pa.string()), pa.array([part] * n, pa.int64()), pa.array([text] * n, pa.string())],
                                      [*[f for f, _ in _FIELDS], "role", "part", "text"])


def compare_in_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprint every document, its edited text and the next document in descending doc_id order.

    The order is doc_id descending (null last, ties by the text's first HEAD characters, then its
    hash); the last document is followed by the first. Documents are range-partitioned once, by all
    of that and the row, so no doc_id or text, however frequent, fills one task. Within a partition each text meets the one
    after it; the ends of partitions, two rows each, are joined with each other afterwards.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id").desc_nulls_last()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, True
        blank = lambda i: (i, None, None, None, None, None, None)
        for batch in batches:
            ids, texts, at = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), 0
            if first and ids:
                yield _rows([blank(ids[0])], "first", part, texts[0])
                first = False
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (size < 1 << 17 or end == at):
                    size += len(texts[end])
                    end += 1
                some_ids, some = ids[at:end], texts[at:end]
                if held:
                    some_ids, some = [held[0], *some_ids], [held[1], *some]
                yield _rows(_results(some_ids, some, None))
                held, at = (some_ids[-1], some[-1]), end
        if held:
            yield _rows([blank(held[0])], "last", part, held[1])

    ties = {"_head": F.substring("text", 1, HEAD), "_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
    done = stage(slim.withColumns(ties).repartitionByRange(partitions, order, "_head", "_hash", "_row")
                 .sortWithinPartitions(order, "_head", "_hash", "text").select("doc_id", "text")
                 .mapInArrow(tidy(run), f"{RESULT}, role string, part long, text string"), "fingerprints")
    parts = done.where("role = 'first'").select("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    ends = (done.where("role = 'last'").select("doc_id", "text", "part").join(after, "part")
            .join(done.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [r for d in batch.to_pylist() for r in _results([d["doc_id"]], [d["text"]], d["following"])]
            yield _rows(out).select([f for f, _ in _FIELDS])

    return done.where("role is null").select(*[f for f, _ in _FIELDS]).unionByName(ends.select("doc_id", "text", "following").mapInArrow(tidy(close), RESULT))
