"""Byte-level BPE over columns: texts are cut into pieces that merges never cross, and each distinct piece is encoded once.

Natural text repeats its words, so a batch has far fewer distinct pieces than
pieces. Arrow cuts and dictionary-encodes them; only the distinct ones reach the
tokenizer, and Arrow gathers the ids back per text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

_ASCII_TOUCH = tuple(a + b for a, b in [("", "  ")] + [(w, " ") for w in "\t\n\v\f\r"] + [(" ", w) for w in "\t\n\v\f\r"])
_WIDE_SPACES = "\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


#: A mark after a word is a pre-token of its own.
_MARKS = (".", ",", ";", ":", "?", "!")


def _members(text: str) -> np.ndarray:
    found = np.zeros(0x110000, bool)
    found[np.frombuffer(text.encode("utf-32-le"), "<u4")] = True
    return found


def stand_ins(pattern: str) -> dict[int, int]:
    """Code points that the ``regex`` package and the tokenizer libraries class differently, each with one to cut in its place.

    Python's ``regex`` follows another Unicode version than the libraries. Every class that ``pattern`` names is
    asked of both over all code points; the stand-in lies, for both, in the classes that the libraries see.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    byte = {bytes([i]): i for i in range(256)}
    ours, theirs = np.zeros(0x110000, np.int64), np.zeros(0x110000, np.int64)
    for k, name in enumerate(sorted({n.lower() if len(n) == 2 else n.replace("P", "p", 1).replace("^", "") for n in re.findall(r"\\[pP]\{[^}]+\}|\\[pP]\w|\\[sSwWdD]", pattern)})):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=byte, special_tokens={})
        ours |= _members("".join(regex.findall(name + "+", every))).astype(np.int64) << k
        theirs |= _members(bytes(probe.encode_ordinary(every)).decode()).astype(np.int64) << k
    apart = np.flatnonzero(ours != theirs)
    agreed = ours == theirs
    agreed[:128] = agreed[0xD800:0xE000] = False
    agreed[[ord(c) for c in pattern]] = False
    for_classes = {}
    for seen in np.unique(theirs[apart]).tolist():
        fit = np.flatnonzero(agreed & (theirs == seen))
        if not len(fit):
            raise ValueError(f"no character stands for the classes of U+{int(apart[theirs[apart] == seen][0]):04X}")
        for_classes[seen] = int(fit[0])
    return {int(c): for_classes[int(theirs[c])] for c in apart}


def _ranges(points: Iterable[int]) -> str:
    """The body of a character class with these code points, neighbours as ranges."""
    c = np.array(sorted(points), np.int64)
    if not len(c):
        return ""
    gap = np.flatnonzero(np.diff(c) != 1)
    first, last = c[np.append(0, gap + 1)], c[np.append(gap, len(c) - 1)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


class Splitter:
    """Cuts a string into the matches of ``pattern`` as the tokenizer libraries do; unmatched text is left out."""

    def __init__(self, pattern: str):
        import regex

        compiled = regex.compile(pattern)
        self.find, self.whole = compiled.finditer, None if compiled.groups else compiled.findall
        self.swap = stand_ins(pattern)
        ranges = _ranges(self.swap)
        self.rare = re.compile(f"[{ranges}]") if ranges else None
        # one bitmap look-up a character: what is not in here is neither rare nor a wide space
        self.suspect = re.compile("[" + _WIDE_SPACES + _ranges(c for c in self.swap if c < 0x10000) + "\\U00010000-\\U0010ffff]")
        self.wide_space = re.compile(f"[{_WIDE_SPACES}]")
        #: the short cuts at spaces, words and marks hold for this pattern alone
        self.by_space = pattern == public_tokenizers.PATTERN

    def odd(self, text: str) -> bool:
        """True if ``text`` holds a code point that needs a stand-in."""
        return self.rare is not None and not text.isascii() and self.suspect.search(text) is not None and self.rare.search(text) is not None

    def cut_at_spaces(self, text: str) -> bool:
        """True if every space of ``text`` stands between non-space characters or at its ends, and no point is rare.

        Then a pre-token starts at each space, so the pieces cut there can be encoded on their own.
        """
        if not self.by_space or any(t in text for t in _ASCII_TOUCH):
            return False
        return text.isascii() or not self.suspect.search(text) or not (self.wide_space.search(text) or self.odd(text))

    def __call__(self, text: str) -> list[str]:
        if self.odd(text):
            return [text[m.start():m.end()] for m in self.find(text.translate(self.swap))]
        return self.whole(text) if self.whole else [m.group() for m in self.find(text)]


class Memo:
    """key -> ids as little-endian unsigned 32-bit bytes, kept from batch to batch.

    The first ``limit`` short keys are kept, the frequent ones among them; others are encoded again when they return.
    """

    def __init__(self, limit: int, longest: int = 32):
        self.limit, self.longest = limit, longest
        self.known: dict[str, bytes] = {}

    def values(self, keys: list[str], encode_many: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        out = list(map(self.known.get, keys))
        missing = [i for i, v in enumerate(out) if v is None]
        if missing:
            asked = [keys[i] for i in missing]
            found = encode_many(asked)
            for i, value in zip(missing, found, strict=True):
                out[i] = value
            short = ((k, v) for k, v in zip(asked, found, strict=True) if len(k) <= self.longest)
            self.known.update(islice(short, max(0, self.limit - len(self.known))))
        return out


class PieceEncoder:
    """Encodes columns of texts. ``split`` cuts a string into pre-tokens; ``encode_many`` gives each pre-token's ids as bytes."""

    def __init__(self, split: Splitter, encode_many: Callable[[list[str]], list[bytes]], remembered: int = 900_000):
        self.split, self.encode_many = split, encode_many
        self.memo = Memo(remembered)

    def _cut(self, piece: str) -> list[str]:
        """Pre-tokens of a space and what follows it; words, and words with one mark after them, need no pattern."""
        body = piece[1:]
        if body[-1:] in _MARKS and body[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.split(piece)

    def _encode_cut(self, cut: list[list[str]], known: dict[str, bytes]) -> list[bytes]:
        distinct = list({t for c in cut for t in c if t not in known})
        ids = {**known, **dict(zip(distinct, self.memo.values(distinct, self.encode_many), strict=True))}
        return [ids[c[0]] if len(c) == 1 else b"".join([ids[t] for t in c]) for c in cut]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Words are pre-tokens themselves; the others are cut, and their words mostly known by then."""
        words = [p for p in pieces if p[1:].isalpha()]
        known = dict(zip(words, self.encode_many(words), strict=True))
        others = [p for p in pieces if p not in known]
        known.update(zip(others, self._encode_cut(list(map(self._cut, others)), known), strict=True))
        return list(map(known.__getitem__, pieces))

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text (none for null or empty) as little-endian unsigned 32-bit integers, one binary value per text."""
        strings = texts.to_pylist()
        split = np.array([bool(t) and self.split.cut_at_spaces(t) for t in strings], bool)
        whole = self._encode_cut([self.split((t or "") if not s else t.split(" ", 1)[0]) for t, s in zip(strings, split, strict=True)], {})
        later = [t.split(" ", 1)[1] if s and " " in t else None for t, s in zip(strings, split, strict=True)]
        lists = pc.split_pattern(pa.array(later, pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        pieces = [" " + p for p in coded.dictionary.to_pylist()]
        values = pa.array(self.memo.values(pieces, self._encode_pieces) + whole, pa.binary())
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(counts)
        # each text's own head or whole encoding stands before its later pieces
        codes = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends - counts, len(pieces) + np.arange(len(strings)))
        return joined(values.take(pa.array(codes)), ends + np.arange(1, len(strings) + 1))


def joined(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """Consecutive binary values joined: value k is made of those before ``ends[k]`` and after the one before."""
    wide = pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[values.offset:values.offset + len(values) + 1]
    bounds = np.concatenate([at[:1], at[ends]]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), data if data is not None else pa.py_buffer(b"")])


def id_values(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and where each row's ids end."""
    if ids.null_count:
        ids = ids.fill_null(b"")
    wide = pa.types.is_large_binary(ids.type)
    _, offsets, data = ids.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw.view("<u4") if raw.ctypes.data % 4 == 0 else np.frombuffer(raw.tobytes(), "<u4"), (at[1:] - at[0]) // 4


def slices(batch: pa.RecordBatch, column: str, target: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded bytes, so that long texts don't pile up."""
    size = batch.column(column).nbytes
    step = max(1, batch.num_rows * target // max(size, 1))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])
