"""Operator 7: WARC archives of individually compressed records with an embedded Zstandard dictionary.

Each archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself compressed; every record after it is a frame of its own made
with that dictionary. The dictionary is trained on the archive's first records
(``sample_bytes`` of them); where they are too few to train on, their bytes serve
as a raw dictionary.

Records with equal payloads are stored once: the row with the largest page_id is
the response, the others are revisits that refer to it. Rows that repeat that
page_id are responses too; null page_ids never win over others, and a group of
null ids only is all responses. Null html is the empty payload, null url is an
empty target. Files are named by task attempt and count only through the
manifest that Spark commits.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, stage_path, tidy

SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "null" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int):
    """A trained dictionary, or the samples' own bytes where training finds too little."""
    import zstandard

    if len(samples) >= 8:
        try:
            return zstandard.train_dictionary(size, samples, k=256, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[-size:] or b"WARC/1.1\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    def __init__(self, path: str, dictionary_bytes: int, sample_bytes: int, level: int):
        from pyarrow import fs

        where, name = fs.FileSystem.from_uri(path)
        where.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.path, self.out = path, where.open_output_stream(name)
        self.size, self.sample, self.level = dictionary_bytes, sample_bytes, level
        self.waiting: list[bytes] = []
        self.held = self.records = self.raw = self.written = 0
        self.zip = None

    def add(self, rec: bytes) -> None:
        self.records += 1
        self.raw += len(rec)
        if self.zip:
            self._put(self.zip.compress(rec))
            return
        self.waiting.append(rec)
        self.held += len(rec)
        if self.held >= self.sample:
            self._start()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _start(self) -> None:
        import zstandard

        made = build_dictionary(self.waiting, self.size)
        self.zip = zstandard.ZstdCompressor(level=self.level, dict_data=made)
        frame = zstandard.ZstdCompressor(level=19).compress(made.as_bytes())
        self._put(struct.pack("<II", SKIPPABLE, len(frame)) + frame)
        for rec in self.waiting:
            self._put(self.zip.compress(rec))
        self.waiting = []

    def close(self) -> dict:
        if not self.zip:
            self._start()
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.written}


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one at a time."""
    import zstandard

    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the head of the archive")
    made = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(source.read(size)))
    plain = zstandard.ZstdDecompressor(dict_data=made).stream_reader(source, read_across_frames=True)
    lines = io.BufferedReader(plain, 1 << 20)
    while first := lines.readline():
        if first.strip() != b"WARC/1.1":
            raise ValueError("a record does not begin with its version")
        headers = {}
        while line := lines.readline().strip():
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        yield headers, lines.read(int(headers["Content-Length"]))
        lines.read(4)


def _page(urn: str) -> int | None:
    name = urn[len("<urn:page:"):-1]
    return None if name == "null" else int(name)


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, payload bytes, digest, type and reference of a record; a response's digest is computed anew."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(h.partition(b":")[2]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest(payload) != said):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    return _page(headers["WARC-Record-ID"]), length, said, kind, _page(headers["WARC-Refers-To"]) if kind == "revisit" else None


def mark_revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Add ``winner`` (the group's largest page_id, null where the row is a response) to page_id, url, html.

    Groups are counted by digest before any page moves; only digests that occur twice join back.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
                        ).withColumn("payload_key", F.sha1(F.col("html").cast("binary")))
    best = (rows.where(F.octet_length("html") >= min_payload).groupBy("payload_key")
            .agg(F.max("page_id").alias("best"), F.count("*").alias("n")).where("n > 1 and best is not null").drop("n"))
    revisit = F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return rows.join(best, "payload_key", "left").select("page_id", "url", "html", F.when(revisit, F.col("best")).alias("winner"))


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, dictionary_bytes: int = 1 << 16, sample_bytes: int = 4 << 20,
                   archive_bytes: int = 256 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every page as a record; returns the staged manifest, one row per archive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, archive, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for page_id, url, html, winner in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "winner")), strict=True):
                archive = archive or ArchiveWriter(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.zst", dictionary_bytes, sample_bytes, level)
                archive.add(record(page_id, url, html.encode(), winner, winner is not None, date))
                if archive.raw >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return stage(mark_revisits(pages, min_payload).mapInArrow(tidy(run), MANIFEST), "warc-manifest")


def _batches(rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    names, kinds = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], kind) for k, kind in enumerate(kinds)], names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_stream(name) as source:
                    yield from _batches(page_of(h, b) for h, b in read_records(source))

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(n, "path").mapInArrow(tidy(run), RESULT)


def archive_and_read(pages: DataFrame, **options) -> DataFrame:
    """Write all pages to a new folder of the shared store and read the archives back."""
    return read_archives(write_archives(pages, stage_path(pages.sparkSession, "warc"), **options))
