"""Operator 5: byte-level BPE through a sentencepiece model serialised from a rank vocabulary.

The vocabulary's ranks become the pieces of a sentencepiece BPE model: each
token's bytes are mapped to 256 printable characters, its score is the negative
rank, and the normaliser is the identity. No tokenizer is trained. A text is cut
into pre-tokens by ``pattern``, with the character classes of the tokenizer
libraries; each pre-token's byte-mapped form is encoded by
sentencepiece, and ids are decoded by the inverse mapping of id to bytes.

Null or empty text gives no ids and empty decoded bytes. Rows are mapped one to
one, so repeated rows and extra columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tidy, without
from .pretokens import PieceEncoder, Splitter, id_values, joined, slices, with_columns

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Bytes of text encoded at a time, and pieces remembered within a task: both bound memory only.
SLICE, REMEMBERED = 2 << 20, 200_000


def byte_characters() -> list[str]:
    """One printable, non-space character for each byte: the byte itself where printable, else from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order of a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; one unknown piece follows them."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    chars = byte_characters()
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(chars[b] for b in token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size, spec.unk_id = pb.TrainerSpec.BPE, len(tokens) + 1, len(tokens)
    spec.bos_id = spec.eos_id = spec.pad_id = -1
    norm = model.normalizer_spec
    norm.name, norm.precompiled_charsmap = "identity", b""
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class ByteBPE:
    """Encoder and decoder of one vocabulary; build once per worker with :func:`codec`."""

    def __init__(self, path: str, pattern: str):
        from sentencepiece import SentencePieceProcessor

        self.tokens = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.chars = {b: c for b, c in enumerate(byte_characters())}
        self.whole_token = {t: i for i, t in enumerate(self.tokens)}
        self.token_bytes = pa.array(self.tokens, type=pa.large_binary())
        self.split = Splitter(pattern)
        self.forget()

    def forget(self) -> None:
        """Start with empty memos: they serve one task and don't stay with the worker."""
        self.pieces = PieceEncoder(self.split, self.pre_tokens, REMEMBERED)

    def pre_tokens(self, tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token; a pre-token that is itself in the vocabulary is that id."""
        raw = [t.encode("utf-8") for t in tokens]
        mapped = [r.decode("latin-1").translate(self.chars) for r in raw if r not in self.whole_token]
        merged = iter(self.model.encode(mapped, num_threads=1) if mapped else ())
        return [array("I", [self.whole_token[r]] if r in self.whole_token else next(merged)).tobytes() for r in raw]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers in one binary value. A column called like it is replaced."""
        return self.pieces.encode(texts)

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes that each row's ids stand for, by the inverse mapping of id to token bytes."""
        flat, ends = id_values(ids)
        return joined(self.token_bytes.take(pa.array(flat.astype(np.int64))), ends)


_CODECS: dict[tuple[str, str], ByteBPE] = {}


def codec(path: str, pattern: str) -> ByteBPE:
    key = (path, pattern)
    if key not in _CODECS:
        _CODECS[key] = ByteBPE(path, pattern)
    return _CODECS[key]


def _encoded(batch: pa.RecordBatch, bpe: ByteBPE, text: str, ids: str) -> pa.RecordBatch:
    return with_columns(batch, **{ids: bpe.encode(batch.column(text)).cast(pa.binary())})


def _decoded(batch: pa.RecordBatch, bpe: ByteBPE, ids: str, decoded: str) -> pa.RecordBatch:
    return with_columns(batch, **{decoded: bpe.decode(batch.column(ids)).cast(pa.binary())})


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str = VOCABULARY,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``ids``: the text's token ids as little-endian unsigned 32-bit integers in one binary value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                yield _encoded(part, bpe, text, ids)
        bpe.forget()

    df = without(df, [ids], [text])
    return df.mapInArrow(tidy(run), T.StructType([*df.schema.fields, T.StructField(ids, T.BinaryType())]))


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str = VOCABULARY,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``decoded``: the bytes that the ids stand for. A column called like it is replaced."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, ids, 4 * SLICE):
                yield _decoded(part, bpe, ids, decoded)

    df = without(df, [decoded], [ids])
    return df.mapInArrow(tidy(run), T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))


def _sha256(values: pa.Array, without_last: int = 0) -> list[str]:
    """Digests of binary values, each without its last bytes if it has any."""
    data = values.buffers()[2]
    raw = memoryview(data) if data is not None else memoryview(b"")
    at = np.frombuffer(values.buffers()[1], np.int64)[:len(values) + 1].tolist()
    return [hashlib.sha256(raw[a:max(a, b - without_last)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]


def round_trip(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, ids: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space), decoded_sha256 of every whole text; ``ids``
    names a further column for the ids themselves.

    Each slice of documents is encoded, decoded from its ids and digested in one pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        decimal = pa.array([b"%d " % i for i in range(len(bpe.tokens))], type=pa.large_binary())
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                coded = bpe.encode(part.column("text"))
                flat, ends = id_values(coded)
                lines = joined(decimal.take(pa.array(flat.astype(np.int64))), ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(ends, prepend=0)), pa.array(_sha256(lines, 1)), pa.array(_sha256(bpe.decode(coded))), *([coded.cast(pa.binary())] if ids else [])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *([ids] if ids else [])])
        bpe.forget()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (f", {ids} binary" if ids else ""))
