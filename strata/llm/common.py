"""Helpers shared by the operators: table reading, staged tables, vectorised hashing of text."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

U64 = np.uint64


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on, and its next task may be another operator's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that leaves no freed memory behind when its task ends."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


#: Odd multiplier of the prefix polynomial (mod 2**64) and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    _MADE.append(f"{checkpoint_dir(spark).rstrip('/')}/strata-llm/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


#: Folders that this driver has made under the shared folder and not deleted yet.
_MADE: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made_folders() -> list[str]:
    """All staged folders of this driver that are not deleted yet, in order."""
    return list(_MADE)


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete staged folders; only once nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        if folder in _MADE:
            _MADE.remove(folder)


def without(df: DataFrame, names: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """``df`` without columns that are called like one of ``names``, whatever their case; those in ``keep`` stay."""
    taken, stay = {n.lower() for n in names}, set(keep)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in stay or c.lower() not in taken])


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


SYMBOLS = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; kept and grown per worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = np.full(size, base, dtype=U64)
        out[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(out)
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial sums P[i] = sum(values[j] * BASE**j for j < i)."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of the symbols in [start, end) from prefix sums; equal spans hash alike anywhere."""
    inverse = powers(BASE_INVERSE, len(sums))
    length = (end - start).astype(U64)
    return mix((sums[end] - sums[start]) * inverse[start] + length * U64(0xD1B54A32D192ED03))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of an Arrow string or binary array without copying; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(offsets) else raw[:0], offsets - (offsets[0] if len(offsets) else 0)


def chunks(offsets: np.ndarray, target: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``target`` bytes each (one longer row stands alone)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + target, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


#: Word tables: byte -> is it part of a word.
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated texts: 64-bit hashes, byte starts, byte ends, and word offsets per text."""
    n = len(raw)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, U64), empty, empty, np.zeros(len(offsets), np.int64)
    inside = is_word[raw]
    edge = np.empty(n + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0], edge[-1] = inside[0], inside[-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    joined = cut[inside[cut] & inside[cut - 1]]  # a word ends and the next begins at a text boundary
    marks = np.flatnonzero(edge)
    if len(joined):
        joined = np.unique(joined)
        marks = np.sort(np.concatenate([marks, joined, joined]))
    starts, ends = marks[::2], marks[1::2]
    return word_hashes(LOWER[raw] if lower else raw, starts, ends), starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: the sum of a mixed value for each (byte, place in the word), mixed with the length.

    A polynomial in the place would not do: the Thue-Morse word over any two letters and its complement agree under every
    polynomial mod 2**64 from 1,024 letters on. Here each pair has a value of its own, so no arrangement of bytes is special.
    """
    if not len(starts):
        return np.zeros(0, U64)
    first = int(starts[0])
    place = np.arange(first, len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    sums = np.zeros(len(raw) - first + 1, U64)
    np.cumsum(mix(SYMBOLS[raw[first:]] ^ (place.astype(U64) * U64(0xD6E8FEB86659FD93))), out=sums[1:])
    return mix(sums[ends - first] - sums[starts - first] + (ends - starts).astype(U64) * U64(0xD1B54A32D192ED03))


def all_words(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like :func:`words`, worked out chunk by chunk so that only the words' own arrays are held."""
    parts, bounds, shift = [], [np.zeros(1, np.int64)], 0
    for i, j in chunks(offsets):
        hashes, starts, ends, own = words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], is_word, lower)
        parts.append((hashes, starts + offsets[i], ends + offsets[i]))
        bounds.append(own[1:] + shift)
        shift += len(hashes)
    empty = (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    hashes, starts, ends = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else empty
    return hashes, starts, ends, np.concatenate(bounds)
