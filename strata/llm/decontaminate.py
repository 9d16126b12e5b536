"""Operator 8: benchmark decontamination through an FM-index of each training shard.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A
test phrase is every window of ``n`` consecutive words of a benchmark item, or the
whole item if it has fewer. A shard is a slice of documents: the runs of words
that the benchmark has at all (other words end a run, runs shorter than the
shortest phrase cannot match) are indexed, phrases are searched backwards
through the wavelet-tree ranks, occurrences are located by sampled suffix
positions, and their spans are merged per document.

The benchmark is a query set held against all rows in blocks: it is staged in
the shared folder as files of at most about ``block_words`` words, and a task reads one
block at a time, so memory holds one shard and one block whatever the sizes.

Null and empty texts have no words and no hits; items without words match
nothing; a null item_id is the empty string, and repeated item_ids count once.
Documents are judged row by row, so repeated rows agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORD, U64, all_words, stage_path, text_bytes, tidy, without
from .fm_index import FMIndex
from .pretokens import slices

N = 13
SHARD_BYTES = 8 << 20


class Phrases:
    """The phrases of one block of items, over a dense vocabulary."""

    def __init__(self, item_ids: list[str], item_words: list[np.ndarray], n: int):
        all_words = np.concatenate([np.zeros(0, U64), *item_words])
        self.vocabulary, codes = np.unique(all_words, return_inverse=True)
        ends = np.cumsum([len(w) for w in item_words])
        rows, lengths, owners = [], [], []
        for k, (end, own) in enumerate(zip(ends, item_words, strict=True)):
            size = min(n, len(own))
            if size:
                item = codes[end - len(own):end] + 2  # 0 is the end mark, 1 ends a run
                rows.append(np.pad(np.lib.stride_tricks.sliding_window_view(item, size), ((0, 0), (n - size, 0))))
                lengths += [size] * len(rows[-1])
                owners += [k] * len(rows[-1])
        keyed = np.concatenate([np.concatenate(rows), np.array(lengths)[:, None]], axis=1) if rows else np.zeros((0, n + 1), np.int64)
        distinct, inverse = np.unique(keyed, axis=0, return_inverse=True)
        self.patterns, self.lengths = distinct[:, :-1], distinct[:, -1]
        pairs = np.unique(np.stack([inverse.ravel(), np.array(owners, np.int64)], axis=1), axis=0) if rows else np.zeros((0, 2), np.int64)
        self.first_owner = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        self.owners, self.item_ids = pairs[:, 1], item_ids
        self.shortest = int(self.lengths.min()) if len(distinct) else 0


def find(hashes: np.ndarray, bounds: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of phrases in a shard: word start, word end (in the shard's words) and phrase number."""
    none = np.zeros(0, np.int64)
    if not phrases.shortest or not len(hashes):
        return none, none, none
    at = np.searchsorted(phrases.vocabulary, hashes)
    known = phrases.vocabulary[np.minimum(at, len(phrases.vocabulary) - 1)] == hashes
    edge = np.zeros(len(hashes) + 1, bool)
    edge[bounds] = edge[0] = edge[-1] = True
    edge[1:-1] |= known[1:] != known[:-1]
    starts = np.flatnonzero(edge[:-1])
    ends = np.append(starts[1:], len(hashes))
    kept = known[starts] & (ends - starts >= phrases.shortest)
    sizes = (ends - starts)[kept]
    if not len(sizes):
        return none, none, none
    # one separator after each run
    where = np.repeat(starts[kept] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    breaks = np.cumsum(sizes)
    seq = np.insert(at[where] + 2, breaks, 1)
    place = np.insert(where, breaks, -1)
    index = FMIndex(seq, len(phrases.vocabulary) + 2)
    low, high = index.search(phrases.patterns, phrases.lengths)
    counts = high - low
    number = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    begin = place[index.locate(rows)]
    return begin, begin + phrases.lengths[number], number


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` positions lie in any [start, end)."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def shard_hits(hashes: np.ndarray, bounds: np.ndarray, blocks: Iterator[Phrases]) -> tuple[np.ndarray, list[set[str]]]:
    """Per word of a shard: is it hit; per document: the ids of the items found."""
    hit, items = np.zeros(len(hashes), bool), [set() for _ in range(len(bounds) - 1)]
    for phrases in blocks:
        start, end, number = find(hashes, bounds, phrases)
        if not len(start):
            continue
        hit |= covered(len(hashes), start, end)
        docs = np.searchsorted(bounds, start, side="right") - 1
        pairs = np.unique(docs * len(phrases.lengths) + number)
        for doc, phrase in zip((pairs // len(phrases.lengths)).tolist(), (pairs % len(phrases.lengths)).tolist(), strict=True):
            owners = phrases.owners[phrases.first_owner[phrase]:phrases.first_owner[phrase + 1]]
            items[doc].update(phrases.item_ids[o] for o in owners)
    return hit, items


def stage_benchmark(benchmark: DataFrame, block_words: int = 250_000, item: str = "item_id", text: str = "text") -> list[str]:
    """Write the items' word hashes to the shared folder; returns the block files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, _, _, bounds = all_words(*text_bytes(batch.column("text")), ALNUM_WORD, lower=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                ["item", "words"])

    spark = benchmark.sparkSession
    path = stage_path(spark, "benchmark")
    slim = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text"))
    slim.mapInArrow(tidy(run), "item string, words binary").where(F.length("words") > 0).write.parquet(f"{path}/items")
    items = spark.read.schema("item string, words binary").parquet(f"{path}/items")
    total = items.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    blocks = int(total // block_words) + 1
    items.repartition(blocks).write.parquet(f"{path}/blocks")
    return spark.read.schema("item string, words binary").parquet(f"{path}/blocks").inputFiles()


def read_blocks(files: list[str], n: int) -> Iterator[Phrases]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for path in files:
        where, name = fs.FileSystem.from_uri(path)
        got = pq.read_table(name, filesystem=where).to_pydict()
        yield Phrases(got["item"], [np.frombuffer(w, U64) for w in got["words"]], n)


def judge(docs: DataFrame, benchmark: DataFrame, n: int = N, share: int = 20, text: str = "text", clean: str | None = None,
          block_words: int = 250_000) -> DataFrame:
    """Add n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and share * n_hit >= n_words) and spans
    (merged word ranges ``start``, ``end``); ``clean`` names a column for the text without its hit words' bytes."""
    files = stage_benchmark(benchmark, block_words)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
             T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()), T.StructField("spans", span)]
    if clean:
        added.append(T.StructField(clean, T.StringType()))
    docs = without(docs, [f.name for f in added], [text])
    names = {f.name for f in added}
    fields = [f for f in docs.schema.fields if f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[Phrases] = []
        for batch in batches:
            for part in slices(batch, text, SHARD_BYTES):
                if not kept and len(files) == 1:
                    kept = list(read_blocks(files, n))
                yield _judged(part, text, kept or read_blocks(files, n), share, clean)

    return docs.select(*[f.name for f in fields]).mapInArrow(tidy(run), T.StructType([*fields, *added]))


def _judged(part: pa.RecordBatch, text: str, blocks, share: int, clean: str | None) -> pa.RecordBatch:
    raw, offsets = text_bytes(part.column(text))
    hashes, starts, ends, bounds = all_words(raw, offsets, ALNUM_WORD, lower=True)
    hit, items = shard_hits(hashes, bounds, blocks)
    before = np.concatenate([[0], np.cumsum(hit)])
    n_words, n_hit = np.diff(bounds), before[bounds[1:]] - before[bounds[:-1]]
    flips = np.zeros(len(hit) + 1, bool)
    flips[1:-1] = hit[1:] != hit[:-1]
    if len(hit):
        flips[0], flips[-1] = hit[0], hit[-1]
    joined = np.unique(bounds[(bounds > 0) & (bounds < len(hit))])
    joined = joined[hit[joined] & hit[joined - 1]] if len(joined) else joined
    marks = np.sort(np.concatenate([np.flatnonzero(flips), joined, joined])).astype(np.int64)
    first, last = marks[::2], marks[1::2]
    owner = np.searchsorted(bounds, first, side="right") - 1
    flat = pa.StructArray.from_arrays([pa.array(first - bounds[owner]), pa.array(last - bounds[owner])], ["start", "end"])
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(bounds))).astype(np.int32)), flat)
    columns = {
        "n_words": pa.array(n_words), "n_hit": pa.array(n_hit), "n_items": pa.array([len(i) for i in items], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items], pa.string()),
        "contaminated": pa.array((n_hit > 0) & (share * n_hit >= n_words)), "spans": spans,
    }
    if clean:
        keep = np.ones(len(raw), bool)
        if len(first):
            keep &= ~covered(len(raw), starts[first], ends[last - 1])
        columns[clean] = pa.array([raw[a:b][keep[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
    return pa.RecordBatch.from_arrays([*part.columns, *columns.values()], [*part.schema.names, *columns])
