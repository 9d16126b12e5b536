"""Distributed search for repeated windows, shared by the suffix-array and the FM-index deduplication.

Documents are packed into files of a few megabytes in the shared folder; only
small records move between tasks:

1. pack: cut a pack into segments (windows.py), keep one record per distinct segment
   with its count and smallest doc_id, and deal the records by minimizer;
2. count: a minimizer seen once cannot repeat and gets no answer. One whose segments
   are all alike is settled by their count. Where segments differ, one pack is asked
   for each distinct segment's content, and all packs that have it wait for the result;
3. send: the asked packs read their files and send those segments;
4. resolve: the operator orders the segments' windows (suffix array or FM-index) and
   returns a value for each window, as runs;
5. finish: each pack turns the answers into removed ranges of its documents.

A record is made per pack and segment whatever its number of copies, so a
passage in a third of all documents costs one record a pack. A minimizer with
very many *different* segments (a common line in many contexts) is hot: from
``hot`` distinct segments on (per task) or ``hot_pack`` (per pack) its windows are dealt
singly by their own hash and settled by counting, so no task receives the group.

Keys are 64-bit hashes of the content; windows are compared by these and, inside
a minimizer's group, by content.
"""

from __future__ import annotations

import io
import uuid
from abc import ABC, abstractmethod
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, chunks, give_back, mix, prefix, span_hash, stage, stage_path, text_bytes, tidy
from .pretokens import slices
from .windows import segments

NO_DOC = np.iinfo(np.int64).max
VALUE, WANT, SHIP, HOT = 1, 2, 4, 8

RECORD = np.dtype([("key", "<u8"), ("digest", "<u8"), ("n", "<u4"), ("doc", "<i8")])
ANSWER = np.dtype([("key", "<u8"), ("digest", "<u8"), ("n", "<u4"), ("doc", "<i8"), ("code", "u1")])
SENT = np.dtype([("id", "<u8"), ("key", "<u8"), ("n", "<u4"), ("doc", "<i8"), ("size", "<u4")])
SINGLE = np.dtype([("hash", "<u8"), ("n", "<u4"), ("doc", "<i8")])
RUN = np.dtype([("id", "<u8"), ("length", "<u4"), ("value", "<i8")])


class Repeats(ABC):
    """What an operator adds: its symbols, how windows are resolved, and what becomes of a document."""

    width: int
    k: int
    by_doc: bool  # a window's value is the smallest doc_id that has it, else how often it occurs

    @abstractmethod
    def symbols(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit symbols of concatenated texts and their offsets per text."""

    @abstractmethod
    def resolve(self, sent: np.ndarray, content: list[np.ndarray]) -> list[np.ndarray]:
        """Values of all windows of distinct segments, from their own values and contents."""

    @abstractmethod
    def finish(self, batch: pa.RecordBatch, starts: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        """Output rows of a pack from the runs of removed windows."""

    def content(self, symbols: np.ndarray, raw: np.ndarray, a: int, b: int) -> bytes:
        return symbols[a:b].tobytes()

    def from_content(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u8")


def put(path: str, data: bytes) -> None:
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    where.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with where.open_output_stream(name) as out:
        out.write(data)


def get(path: str) -> bytes:
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_stream(name) as source:
        return source.read()


def segment_id(key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    return mix(key * U64(0xC2B2AE3D27D4EB4F) ^ digest)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """True where a row of sorted keys differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _own(op: Repeats, batch: pa.RecordBatch, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Symbols, bounds, bytes and first document of each chunk of a pack."""
    raw, offsets = text_bytes(batch.column(text))
    for i, j in chunks(offsets):
        piece = raw[offsets[i]:offsets[j]]
        yield *op.symbols(piece, offsets[i:j + 1] - offsets[i]), piece, i


def _doc_ids(batch: pa.RecordBatch, doc: str) -> np.ndarray:
    return batch.column(doc).cast(pa.int64()).fill_null(NO_DOC).to_numpy(zero_copy_only=False)


def _pack(op: Repeats, batch: pa.RecordBatch, text: str, doc: str, hot_pack: int) -> tuple[np.ndarray, np.ndarray]:
    """All segments of a pack (key, digest, start, count, document), and its distinct ones as records."""
    parts, shift = [], 0
    for symbols, bounds, _, first in _own(op, batch, text):
        found, _ = segments(symbols, bounds, op.width, op.k)
        parts.append((found.key, found.digest, found.start + shift, found.count, np.searchsorted(bounds, found.start, side="right") - 1 + first))
        shift += len(symbols)
    names = ["key", "digest", "start", "count", "row"]
    kinds = ["<u8", "<u8", "<i8", "<i4", "<i4"]
    own = np.zeros(sum(len(p[0]) for p in parts), np.dtype(list(zip(names, kinds, strict=True))))
    for k, name in enumerate(names):
        own[name] = np.concatenate([p[k] for p in parts]) if parts else own[name]
    order = np.lexsort((own["digest"], own["key"]))
    key, digest, docs = own["key"][order], own["digest"][order], _doc_ids(batch, doc)[own["row"][order]]
    if not len(order):
        return own, np.zeros(0, RECORD)
    new = _groups(key, digest)
    at = np.flatnonzero(new)
    out = np.zeros(len(at), RECORD)
    out["key"], out["digest"] = key[at], digest[at]
    out["n"] = np.diff(np.append(at, len(key)))
    out["doc"] = np.minimum.reduceat(docs, at)
    firsts = np.flatnonzero(_groups(out["key"]))
    many = np.diff(np.append(firsts, len(out)))
    crowded = np.repeat(many > hot_pack, many)
    if crowded.any():  # one record with n = 0 says: hot here
        flags = np.zeros(int((many > hot_pack).sum()), RECORD)
        flags["key"] = out["key"][firsts[many > hot_pack]]
        out = np.concatenate([out[~crowded], flags])
    return own, out


def _dealt(name: str, records: np.ndarray, buckets: int) -> Iterator[tuple[str, int, bytes]]:
    """Records split by bucket of their first field."""
    bucket = (mix(records[records.dtype.names[0]]) % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    at = np.flatnonzero(_groups(bucket)) if len(bucket) else []
    for a, b in zip(at, np.append(at[1:], len(bucket)), strict=True) if len(at) else ():
        yield name, int(bucket[a]), records[a:b].tobytes()


def _gather(batches: Iterator[pa.RecordBatch], dtype: np.dtype, column: str = "data") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """All records of a task, the number of the pack each is from, and the packs."""
    parts, owners, names = [], [], {}
    for batch in batches:
        for name, data in zip(batch.column("pack").to_pylist(), batch.column(column).to_pylist(), strict=True):
            records = np.frombuffer(data or b"", dtype)
            parts.append(records)
            owners.append(np.full(len(records), names.setdefault(name, len(names)), np.int64))
    empty = np.zeros(0, np.int64)
    return np.concatenate([np.zeros(0, dtype), *parts]), np.concatenate([empty, *owners]), list(names)


def _by_pack(records: np.ndarray, owner: np.ndarray, names: list[str]) -> Iterator[tuple[str, bytes]]:
    order = np.argsort(owner, kind="stable")
    records, owner = records[order], owner[order]
    at = np.searchsorted(owner, np.arange(len(names) + 1))
    for k, name in enumerate(names):
        if at[k + 1] > at[k]:
            yield name, records[at[k]:at[k + 1]].tobytes()


def count_records(records: np.ndarray, owner: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Answers to the records of one task, and the packs they go to."""
    order = np.lexsort((owner, records["digest"], records["key"]))
    records, owner = records[order], owner[order]
    new_key = _groups(records["key"])
    new = _groups(records["key"], records["digest"])
    if not len(records):
        return np.zeros(0, ANSWER), owner
    at_key, at = np.flatnonzero(new_key), np.flatnonzero(new)
    key_of, seg_of = np.cumsum(new_key) - 1, np.cumsum(new) - 1
    total = np.add.reduceat(records["n"].astype(np.int64), at_key)[key_of]
    distinct = np.bincount(key_of[at])[key_of]
    is_hot = ((np.minimum.reduceat(records["n"], at_key) == 0)[key_of]) | (distinct > hot)
    n = np.add.reduceat(records["n"].astype(np.int64), at)[seg_of]
    doc = np.minimum.reduceat(records["doc"], at)[seg_of]
    alone = (distinct == 1) & (total > 1)
    mixed = (distinct > 1) & ~is_hot
    code = np.where(is_hot, HOT, 0) | np.where(alone & ~is_hot, VALUE, 0)
    code |= np.where(mixed, WANT, 0) | np.where(mixed & new, SHIP, 0)
    out = np.zeros(len(records), ANSWER)
    for name in ("key", "digest"):
        out[name] = records[name]
    out["n"], out["doc"], out["code"] = np.minimum(n, 0xFFFFFFFF), doc, code
    keep = code > 0
    hot_at = np.flatnonzero(is_hot)  # one answer for each pack and hot key
    by = np.lexsort((owner[hot_at], records["key"][hot_at]))
    keep[hot_at[by]] = _groups(records["key"][hot_at[by]], owner[hot_at[by]])
    return out[keep], owner[keep]


def _load(pack: str) -> tuple[pa.RecordBatch, np.ndarray]:
    batch = pa.ipc.open_stream(get(f"{pack}.arrow")).read_next_batch()
    return batch, np.load(io.BytesIO(get(f"{pack}.segments")))


def _matches(own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (segment, answer) with equal ids; ``ids`` are distinct."""
    if not len(ids) or not len(own):
        none = np.zeros(0, np.int64)
        return none, none
    order = np.argsort(ids)
    mine = segment_id(own["key"], own["digest"])
    at = order[np.minimum(np.searchsorted(ids[order], mine), len(ids) - 1)]
    hit = np.flatnonzero(ids[at] == mine)
    return hit, at[hit]


def _hot_segments(own: np.ndarray, answers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.isin(own["key"], answers["key"][answers["code"] & HOT > 0]))


def _single_windows(op: Repeats, batch: pa.RecordBatch, text: str, own: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window positions of the picked segments and their hashes."""
    counts = own["count"][picked].astype(np.int64)
    at = np.repeat(own["start"][picked] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    out, shift = np.zeros(len(at), U64), 0
    for symbols, _, _, _ in _own(op, batch, text):
        inside = (at >= shift) & (at < shift + len(symbols))
        if inside.any():
            here = at[inside] - shift
            out[inside] = span_hash(prefix(symbols), here, here + op.width)
        shift += len(symbols)
    return at, out


def _send(op: Repeats, pack: str, answers: np.ndarray, text: str, doc: str, buckets: int) -> Iterator[tuple[str, int, bytes, bytes, bytes, bytes]]:
    """What a pack sends on: ids it waits for, segments it was asked for (records and contents), single windows of hot ones."""
    batch, own = _load(pack)
    wanted = answers[answers["code"] & WANT > 0]
    asked = answers[answers["code"] & SHIP > 0]
    segment, number = _matches(own, segment_id(asked["key"], asked["digest"]))
    one = np.unique(number, return_index=True)[1]
    segment, number = segment[one], number[one]
    by_start = np.argsort(own["start"][segment], kind="stable")
    segment, asked = segment[by_start], asked[number[by_start]]
    begin = own["start"][segment]
    end = begin + own["count"][segment] + op.width - 1
    content: list[bytes] = []
    shift, k = 0, 0
    for symbols, _, raw, _ in _own(op, batch, text):
        while k < len(begin) and begin[k] < shift + len(symbols):
            content.append(op.content(symbols, raw, int(begin[k] - shift), int(end[k] - shift)))
            k += 1
        shift += len(symbols)
    sent = np.zeros(len(asked), SENT)
    sent["id"], sent["key"], sent["n"], sent["doc"] = segment_id(asked["key"], asked["digest"]), asked["key"], asked["n"], asked["doc"]
    sent["size"] = [len(c) for c in content]
    hot = _hot_segments(own, answers)
    at, hashes = _single_windows(op, batch, text, own, hot)
    singles = np.zeros(0, SINGLE)
    if len(at):
        docs = np.repeat(_doc_ids(batch, doc)[own["row"][hot]], own["count"][hot])
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(_groups(hashes[order]))
        singles = np.zeros(len(first), SINGLE)
        singles["hash"], singles["n"] = hashes[order][first], np.diff(np.append(first, len(order)))
        singles["doc"] = np.minimum.reduceat(docs[order], first)
    spread = lambda keys: (mix(keys) % U64(buckets)).astype(np.int64)
    to_want, to_send, to_single = spread(wanted["key"]), spread(asked["key"]), spread(singles["hash"])
    ids = segment_id(wanted["key"], wanted["digest"])
    by_bucket = defaultdict(list)
    for i, b in enumerate(to_send.tolist()):
        by_bucket[b].append(i)
    for b in np.unique(np.concatenate([to_want, to_send, to_single])).tolist():
        rows = by_bucket.get(b, [])
        yield pack, b, ids[to_want == b].tobytes(), sent[rows].tobytes(), b"".join([content[i] for i in rows]), singles[to_single == b].tobytes()


def _key_batches(op: Repeats, records: np.ndarray, content: list[np.ndarray], most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Ranges of segments of about ``most`` windows; those of one minimizer stay together."""
    heads = np.append(np.flatnonzero(_groups(records["key"])), len(records))
    windows = np.cumsum([0, *(len(c) - op.width + 1 for c in content)])
    a = 0
    for b, after in zip(heads[1:-1].tolist(), heads[2:].tolist(), strict=True):
        if windows[after] - windows[a] > most:
            yield a, b
            a = b
    yield a, len(records)


def _resolved(op: Repeats, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, bytes]]:
    """Runs of window values for waiting packs, and totals of single windows."""
    names: dict[str, int] = {}
    wanted, want_owner, sent, content, singles, single_owner = [], [], [], [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            owner = names.setdefault(row["pack"], len(names))
            ids = np.frombuffer(row["wanted"], "<u8")
            wanted.append(ids)
            want_owner.append(np.full(len(ids), owner, np.int64))
            records, at = np.frombuffer(row["sent"], SENT), 0
            sent.append(records)
            for size in records["size"].tolist():
                content.append(op.from_content(row["content"][at:at + size]))
                at += size
            one = np.frombuffer(row["singles"], SINGLE)
            singles.append(one)
            single_owner.append(np.full(len(one), owner, np.int64))
    if not names:
        return
    none = np.zeros(0, np.int64)
    ids, owner, records = np.concatenate(wanted), np.concatenate(want_owner), np.concatenate(sent)
    runs, first, many = np.zeros(0, RUN), none, none
    if len(records):
        order = np.argsort(records["key"], kind="stable")
        records, content = records[order], [content[i] for i in order.tolist()]
        values = [v for a, b in _key_batches(op, records, content) for v in op.resolve(records[a:b], content[a:b])]
        flat = np.concatenate(values)
        segment = np.repeat(np.arange(len(values)), [len(v) for v in values])
        at = np.flatnonzero(_groups(segment, flat))
        runs = np.zeros(len(at), RUN)
        runs["id"], runs["length"], runs["value"] = records["id"][segment[at]], np.diff(np.append(at, len(flat))), flat[at]
        first = np.searchsorted(segment[at], np.arange(len(values)))
        many = np.diff(np.append(first, len(at)))
    out: dict[int, list[bytes]] = defaultdict(lambda: [b"", b""])
    if len(ids) and len(records):
        by_id = np.argsort(records["id"], kind="stable")
        which = by_id[np.minimum(np.searchsorted(records["id"][by_id], ids), len(records) - 1)]
        copies = many[which]
        index = np.repeat(first[which] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
        for name, data in _by_pack(runs[index], np.repeat(owner, copies), list(names)):
            out[names[name]][0] = data
    one, owner = np.concatenate(singles), np.concatenate(single_owner)
    if len(one):
        order = np.argsort(one["hash"], kind="stable")
        one, owner = one[order].copy(), owner[order]
        at = np.flatnonzero(_groups(one["hash"]))
        group = np.cumsum(_groups(one["hash"])) - 1
        one["n"] = np.minimum(np.add.reduceat(one["n"].astype(np.int64), at), 0xFFFFFFFF)[group]
        one["doc"] = np.minimum.reduceat(one["doc"], at)[group]
        keep = one["n"] > 1
        for name, data in _by_pack(one[keep], owner[keep], list(names)):
            out[names[name]][1] = data
    for name, k in names.items():
        if k in out:
            yield name, out[k][0], out[k][1]


def _removed(op: Repeats, pack: str, text: str, doc: str, answers: np.ndarray, runs: np.ndarray, singles: np.ndarray) -> pa.RecordBatch:
    batch, own = _load(pack)
    starts, counts, values, rows = [], [], [], []
    settled = answers[answers["code"] & VALUE > 0]
    segment, number = _matches(own, segment_id(settled["key"], settled["digest"]))
    starts.append(own["start"][segment])
    counts.append(own["count"][segment].astype(np.int64))
    values.append((settled["doc"] if op.by_doc else settled["n"].astype(np.int64))[number])
    rows.append(own["row"][segment])
    if len(runs):
        runs = runs[np.argsort(runs["id"], kind="stable")]
        first = np.flatnonzero(_groups(runs["id"]))
        many = np.diff(np.append(first, len(runs)))
        before = np.cumsum(runs["length"].astype(np.int64)) - runs["length"]
        before -= np.repeat(before[first], many)
        segment, number = _matches(own, runs["id"][first])
        copies = many[number]
        index = np.repeat(first[number] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
        starts.append(np.repeat(own["start"][segment], copies) + before[index])
        counts.append(runs["length"][index].astype(np.int64))
        values.append(runs["value"][index])
        rows.append(np.repeat(own["row"][segment], copies))
    if len(singles):
        hot = _hot_segments(own, answers)
        at, hashes = _single_windows(op, batch, text, own, hot)
        order = np.argsort(singles["hash"])
        which = order[np.minimum(np.searchsorted(singles["hash"][order], hashes), len(singles) - 1)]
        hit = singles["hash"][which] == hashes
        starts.append(at[hit])
        counts.append(np.ones(hit.sum(), np.int64))
        values.append((singles["doc"] if op.by_doc else singles["n"].astype(np.int64))[which[hit]])
        rows.append(np.repeat(own["row"][hot], own["count"][hot])[hit])
    start, count, value, row = (np.concatenate(x) for x in (starts, counts, values, rows))
    gone = value < _doc_ids(batch, doc)[row] if op.by_doc else value > 1
    bounds, shift = [np.zeros(1, np.int64)], 0
    for symbols, own_bounds, _, _ in _own(op, batch, text):
        bounds.append(own_bounds[1:] + shift)
        shift += len(symbols)
    return op.finish(batch, start[gone], count[gone], np.concatenate(bounds))


def _table(rows, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def run(docs: DataFrame, op: Repeats, added: list[T.StructField], text: str = "text", doc: str = "doc_id",
        pack_bytes: int = 4 << 20, hot: int = 5_000, hot_pack: int = 256) -> DataFrame:
    """``docs`` with the columns that ``op.finish`` adds or changes."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = stage_path(spark, "packs")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, pack_bytes):
                name = f"{folder}/{uuid.uuid4().hex}"
                own, records = _pack(op, part, text, doc, hot_pack)
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(part)
                put(f"{name}.arrow", sink.getvalue())
                sink = io.BytesIO()
                np.save(sink, own)
                put(f"{name}.segments", sink.getvalue())
                yield _table([(name, -1, b""), *_dealt(name, records, buckets)], ["pack", "bucket", "data"], [pa.string(), pa.int64(), pa.binary()])

    packed = stage(docs.mapInArrow(tidy(pack), "pack string, bucket long, data binary"), "packed")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, owner, names = _gather(batches, RECORD)
        answers, owner = count_records(records, owner, hot)
        yield _table(list(_by_pack(answers, owner, names)), ["pack", "data"], [pa.string(), pa.binary()])

    counted = stage(packed.where("bucket >= 0").repartition(buckets, "bucket").mapInArrow(tidy(count), "pack string, data binary"), "counted")

    def send(table: pa.Table) -> pa.Table:
        give_back()
        answers = np.concatenate([np.frombuffer(d, ANSWER) for d in table.column("data").to_pylist()])
        rows = list(_send(op, table.column("pack")[0].as_py(), answers, text, doc, buckets)) if (answers["code"] & (WANT | SHIP | HOT)).any() else []
        return pa.Table.from_batches([_table(rows, ["pack", "bucket", "wanted", "sent", "content", "singles"],
                                             [pa.string(), pa.int64(), *[pa.binary()] * 4])])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _table(list(_resolved(op, batches)), ["pack", "runs", "singles"], [pa.string(), pa.binary(), pa.binary()])

    sending = counted.repartition(buckets, "pack").groupBy("pack").applyInArrow(send, "pack string, bucket long, wanted binary, sent binary, content binary, singles binary")
    solved = stage(sending.repartition(buckets, "bucket").mapInArrow(tidy(resolve), "pack string, runs binary, singles binary"), "resolved")

    none = F.lit(None).cast("binary")
    parts = (packed.where("bucket = -1").select("pack", none.alias("data"), none.alias("runs"), none.alias("singles"))
             .unionByName(counted.select("pack", "data", none.alias("runs"), none.alias("singles")))
             .unionByName(solved.select("pack", none.alias("data"), "runs", "singles")))

    def finish(table: pa.Table) -> pa.Table:
        give_back()
        joined = lambda c, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(d, kind) for d in table.column(c).to_pylist() if d]])
        return pa.Table.from_batches([_removed(op, table.column("pack")[0].as_py(), text, doc, joined("data", ANSWER), joined("runs", RUN), joined("singles", SINGLE))])

    names = {f.name for f in added}
    schema = T.StructType([f for f in docs.schema.fields if f.name not in names] + added)
    return parts.repartition(buckets, "pack").groupBy("pack").applyInArrow(finish, schema)
