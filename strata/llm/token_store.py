"""Operator 10: token ids in bit-plane-shuffled binary files.

File format (little-endian):

    magic | block 0 | block 1 | ... | documents | chunk index | footer length (8 bytes) | magic

Each block holds ``block`` consecutive ids, transposed into planes: with
``planes="byte"`` plane k is byte k of every id, with ``planes="bit"`` it is bit k
of every id (packed). Planes that are zero throughout are left out. Every other
plane is one zstandard frame. The document section holds doc ids, null flags and
lengths; the chunk index (JSON) holds each block's offset, count and plane sizes, so a
reader can fetch any block alone.

Rows go to files by ranges of doc_id, so the files in order hold the ids of all
documents in ascending doc_id order (null first, ties by text). A file is named
by its task attempt and becomes part of the store through the manifest that
Spark commits; files of failed attempts stay unreferenced.

Null or empty text holds the end id only. Repeated rows are written each.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_characters
from .common import stage, stage_path, tidy
from .pretokens import PieceEncoder, Splitter, id_values, slices

MAGIC = b"PLANES01"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Characters of a text by which rows of one doc_id are dealt to files.
HEAD = 64
MANIFEST = "part int, path string, n_docs long, n_tokens long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Tokens:
    """The tokenizers library over pre-tokens.

    The file's added tokens in a text are ordinary text, or with ``added`` get their own ids, as the library does
    unless its ``encode_special_tokens`` is set.
    """

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import re

        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # the library's own byte-level characters, one per byte
        shown = "".join(p for p, _ in pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str("".join(map(chr, range(256)))))
        self.chars = dict(enumerate(byte_characters()))
        if not set(shown) <= set(self.chars.values()):
            raise ValueError("byte-level characters differ from the library's")
        known = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in known.values()):
            raise ValueError("added tokens that take spaces or need word boundaries are not supported")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in known.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        self.pieces = PieceEncoder(Splitter(pattern), self._many)

    def _many(self, tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens: the library's byte-level form, then its merges."""
        model, level = self.tokenizer.model, self.level
        return [array("I", [t.id for t in model.tokenize(level(token))]).tobytes() for token in tokens]

    def level(self, token: str) -> str:
        if token.isascii() and token.isprintable():  # of these only the space is shown as another character
            return token.replace(" ", self.chars[32])
        return token.encode().decode("latin-1").translate(self.chars)

    def encode(self, texts: pa.Array, added: bool = False) -> pa.Array:
        strings = texts.to_pylist() if added and self.cut else []
        if not any(a in t for t in strings if t for a in self.added):
            return self.pieces.encode(texts)
        parts = [self.cut(t or "") for t in strings]  # every second part is an added token
        coded = iter(self.pieces.encode(pa.array([q for p in parts for q in p[::2]], pa.string())).to_pylist())
        return pa.array([b"".join(self.added[q] if k % 2 else next(coded) for k, q in enumerate(p)) for p in parts], pa.large_binary())


_TOKENS: dict[tuple[str, str], Tokens] = {}


def tokens(path: str, pattern: str) -> Tokens:
    if (path, pattern) not in _TOKENS:
        _TOKENS[path, pattern] = Tokens(path, pattern)
    return _TOKENS[path, pattern]


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of one block, lowest first; an all-zero plane is empty."""
    if planes == "byte":
        rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    else:
        rows = np.packbits(((ids[None, :] >> np.arange(32, dtype=np.uint32)[:, None]) & 1).astype(np.uint8), axis=1)
    return [row.tobytes() if row.any() else b"" for row in rows]


def from_planes(rows: list[bytes], count: int, planes: str) -> np.ndarray:
    if planes == "byte":
        out = np.zeros((count, 4), np.uint8)
        for k, row in enumerate(rows):
            if row:
                out[:, k] = np.frombuffer(row, np.uint8)
        return out.view("<u4").ravel()
    ids = np.zeros(count, np.uint32)
    for k, row in enumerate(rows):
        if row:
            ids |= np.unpackbits(np.frombuffer(row, np.uint8), count=count).astype(np.uint32) << np.uint32(k)
    return ids


class Writer:
    """Appends ids to one file block by block."""

    def __init__(self, path: str, block: int, planes: str, level: int):
        import zstandard
        from pyarrow import fs

        where, name = fs.FileSystem.from_uri(path)
        where.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out, self.block, self.planes = where.open_output_stream(name), block, planes
        self.zip = zstandard.ZstdCompressor(level=level)
        self.index: list[list] = []
        self.rest: list[np.ndarray] = []
        self.held = self.offset = self.total = 0
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, "<u4")
        at = 0
        while len(ids) - at >= max(least, 1):
            part = ids[at:at + self.block]
            frames = [self.zip.compress(p) if p else b"" for p in to_planes(part, self.planes)]
            self.index.append([self.offset, len(part), [len(f) for f in frames]])
            self._put(b"".join(frames))
            at += len(part)
        self.rest, self.held = [ids[at:]], len(ids) - at

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids, nulls, lengths))
        self.rest.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block:
            self._flush(self.block)

    def close(self) -> None:
        self._flush(1)
        doc_ids, nulls, lengths = (np.concatenate(c) for c in zip(*self.docs, strict=True)) if self.docs else (np.zeros(0),) * 3
        start = self.offset
        section = self.zip.compress(doc_ids.astype("<i8").tobytes() + nulls.astype(np.uint8).tobytes() + lengths.astype("<u4").tobytes())
        self._put(section)
        footer = json.dumps({"planes": self.planes, "block": self.block, "blocks": self.index, "documents": [start, len(section), len(doc_ids)]}).encode()
        self._put(footer)
        self._put(len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()


class Reader:
    """Reads one file by its chunk index."""

    def __init__(self, path: str):
        import zstandard
        from pyarrow import fs

        where, name = fs.FileSystem.from_uri(path)
        self.file, self.zip = where.open_input_file(name), zstandard.ZstdDecompressor()
        size = self.file.size()
        tail = self._at(size - 16, 16)
        if tail[8:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError(f"not a token file: {path}")
        length = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self._at(size - 16 - length, length))

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc ids, null flags and token counts."""
        offset, size, n = self.footer["documents"]
        raw = self.zip.decompress(self._at(offset, size)) if n else b""
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool), np.frombuffer(raw, "<u4", n, 9 * n).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        offset, count, sizes = self.footer["blocks"][k]
        raw, rows, at = self._at(offset, sum(sizes)), [], 0
        for s in sizes:
            rows.append(self.zip.decompress(raw[at:at + s]) if s else b"")
            at += s
        return from_planes(rows, count, self.footer["planes"])

    def ids(self) -> Iterator[np.ndarray]:
        for k in range(len(self.footer["blocks"])):
            yield self.block(k)

    def document_ids(self) -> Iterator[np.ndarray]:
        """Each document's ids in turn, reading one block at a time."""
        _, _, lengths = self.documents()
        blocks, have = self.ids(), np.zeros(0, "<u4")
        for n in lengths.tolist():
            parts, size = [have], len(have)
            while size < n:
                parts.append(next(blocks))
                size += len(parts[-1])
            whole = np.concatenate(parts) if len(parts) > 1 else have
            yield whole[:n]
            have = whole[n:]


def write_ids(docs: DataFrame, folder: str, partitions: int | None = None, path: str = VOCABULARY,
              pattern: str = public_tokenizers.PATTERN, end_id: int = 0, block: int = 1 << 16,
              planes: str = "byte", level: int = 3, added: bool = False) -> DataFrame:
    """Encode doc_id, text rows and write them to ``folder``; returns the staged manifest, one row per file.

    With ``added``, strings of the vocabulary's added tokens in a text get those tokens' ids.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokens(path, pattern), TaskContext.get().partitionId()
        uri, writer, n_docs = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.planes", None, 0
        for batch in batches:
            for some in slices(batch, "text"):
                writer = writer or Writer(uri, block, planes, level)
                flat, ends = id_values(coder.encode(some.column("text"), added))
                ids = some.column("doc_id")
                writer.add(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                           np.diff(ends, prepend=0) + 1, np.insert(flat, ends, end_id))
                n_docs += some.num_rows
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": uri, "n_docs": n_docs, "n_tokens": writer.total}],
                                             pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    # the rows of a frequent doc_id are spread by the beginnings of their texts
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("_head", F.substring("text", 1, HEAD))
               .repartitionByRange(partitions, "doc_id", "_head").sortWithinPartitions("doc_id", "text").drop("_head"))
    return stage(ordered.mapInArrow(tidy(run), MANIFEST), "token-manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files of a manifest."""
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("base"))  # one row per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["path"])
                doc_ids, nulls, lengths = reader.documents()
                crc = np.fromiter((zlib.crc32(np.ascontiguousarray(i, "<u4")) for i in reader.document_ids()), np.int64, len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids.astype(np.int64), mask=nulls), pa.array(row["base"] + np.cumsum(lengths) - lengths), pa.array(lengths), pa.array(crc)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "path").mapInArrow(tidy(run), RESULT)


def store_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write all documents to a new folder of the shared store and read them back."""
    return read_ids(write_ids(docs, stage_path(docs.sparkSession, "token-files"), **options))
