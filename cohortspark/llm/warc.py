"""WARC archives compressed with Zstandard: one frame a record, the dictionary in a leading skippable frame.

Pages with equal payloads are found by digest; the one with the smallest id is a response record, the others are revisit
records that name it and carry no payload. Tasks write archives of bounded size to the shared folder under names of their
own and report them in a table, so a repeated attempt leaves nothing behind that is read. Reading streams an archive record
by record and checks every header and length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cohortspark.llm.common import settle, shared_folder
from cohortspark.llm.files import open_new, open_old

ARCHIVE_BYTES = 64 << 20  # payload bytes after which a new archive is begun
SAMPLE_RECORDS = 200  # records the dictionary is trained on: the first of each archive, and at most
SAMPLE_BYTES = 2 << 20  # so many bytes of them
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
CHUNK = 1 << 20
DATE = "2026-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = b"WARC/1.1"
SKIPPABLE = 0x184D2A5D
FRAME = struct.pack("<I", 0xFD2FB528)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ----------------------------------------------------------------------------------------------------------
def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record (HTTP headers alone) where `refers_to` names the page it repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"


def fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"not a header line: {line[:80]!r}")
        out[name.decode()] = value.strip().decode()
    return out


def parse(data: bytes) -> dict:
    """The checked content of one record; ValueError where headers, lengths or digests do not fit."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError(f"not a record: {data[:40]!r}")
    h = fields(lines[1:])
    if missing := [k for k in NEEDED if k not in h]:
        raise ValueError(f"missing headers: {missing}")
    length = int(h["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{h['WARC-Record-ID']}: Content-Length {length}, but {len(rest) - 4} bytes are there")
    block = rest[:length]
    if h.get("WARC-Block-Digest") not in (None, f"sha1:{digest(block)}"):
        raise ValueError(f"{h['WARC-Record-ID']}: block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = int(fields(http.split(b"\r\n")[1:])["Content-Length"])
    kind, named = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"{h['WARC-Record-ID']}: payload length or digest differs")
    if kind == "revisit" and (payload or "WARC-Refers-To" not in h):
        raise ValueError(f"{h['WARC-Record-ID']}: not a revisit record")
    if kind not in ("response", "revisit"):
        raise ValueError(f"{h['WARC-Record-ID']}: unknown type {kind}")

    def number(urn: str | None) -> int | None:
        text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {
        "page_id": number(h["WARC-Record-ID"]), "url": h.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": named,
        "record_type": kind, "refers_to": number(h.get("WARC-Refers-To")), "payload": payload if kind == "response" else None,
    }


# --- archives ---------------------------------------------------------------------------------------------------------
class Writer:
    """One archive: the first records wait until the dictionary is trained on them, the rest go straight out."""

    def __init__(self, out: BinaryIO):
        self.out, self.waiting, self.size, self.records = out, [], 0, 0
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, data: bytes) -> None:
        self.size += len(data)
        self.records += 1
        if self.compressor is not None:
            self.out.write(self.compressor.compress(data))
            return
        self.waiting.append(data)
        if len(self.waiting) >= SAMPLE_RECORDS or self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        options = {"level": LEVEL, "write_checksum": True, "write_content_size": True}
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, self.waiting, level=LEVEL) if len(self.waiting) > 10 else None
        except zstandard.ZstdError:  # too few or too uniform records
            trained = None
        if trained is not None:
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
            self.out.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
            options["dict_data"] = trained
        self.compressor = zstandard.ZstdCompressor(**options)
        for data in self.waiting:
            self.out.write(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.out.close()


def frames(source: BinaryIO) -> Iterator[bytes]:
    """The content of each frame; a dictionary in a leading skippable frame is loaded first."""
    data = source.read(CHUNK)
    trained = None
    if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + size:
            more = source.read(CHUNK)
            if not more:
                raise ValueError("the dictionary is cut off")
            data += more
        own, data = data[8 : 8 + size], data[8 + size :]
        trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(own) if own[:4] == FRAME else own)
    decoder = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    while True:
        if not data:
            data = source.read(CHUNK)
            if not data:
                return
        one, parts = decoder.decompressobj(), []
        while True:
            parts.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            data = source.read(CHUNK)
            if not data:
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


# --- on tables --------------------------------------------------------------------------------------------------------
def mark_revisits(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to) with the id of the page that each repeats, NULL for those that stay responses."""
    rows = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    raw = F.encode("html", "UTF-8")
    rows = rows.withColumn("sha", F.sha2(raw, 256)).withColumn("size", F.octet_length(raw))
    groups = rows.filter(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("page_id").alias("c"))
    first = settle(groups.filter("c > 1").drop("c"), "revisits")
    other = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    return rows.join(first, ["sha", "size"], "left").select("page_id", "url", "html", other.alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of `mark_revisits` below `folder`; a settled table of (path, records, payload_bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path, made = None, "", []
        part = TaskContext.get().partitionId()
        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for page, url, html, other in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2].cast(pa.binary()).to_pylist(), columns[3].to_pylist()):
                if writer is None:
                    path = f"{folder}/part-{part:06d}-{len(made):04d}-{uuid.uuid4().hex}.warc.zst"
                    writer = Writer(open_new(path))
                writer.add(record(page, url, html, other))
                if writer.size >= archive_bytes:
                    writer.close()
                    made.append((path, writer.records, writer.size))
                    writer = None
        if writer is not None:
            writer.close()
            made.append((path, writer.records, writer.size))
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())],
                ["path", "records", "bytes"],
            )

    return settle(marked.mapInArrow(run, "path string, records long, bytes long"), "archives")


READ = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(archives: DataFrame, payloads: bool = True, rows: int = 64) -> DataFrame:
    """All records of the archives in column path, checked: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (NULL for revisits, and for all where `payloads` is off). An archive with another number of records
    than column records says, where there is one, is an error."""
    counted = "records" in archives.columns
    listed = archives.select("path", F.col("records") if counted else F.lit(None).cast("long").alias("records"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, count = [], 0
                with open_old(path) as source:
                    for data in frames(source):
                        one = parse(data)
                        if not payloads:
                            one["payload"] = None
                        held.append(one)
                        count += 1
                        if len(held) >= (rows if payloads else 4096):
                            yield pa.RecordBatch.from_pylist(held, pa.schema(READ))
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, pa.schema(READ))
                if want is not None and want != count:
                    raise ValueError(f"{path}: {count} records, {want} were written")

    tasks = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return listed.repartition(tasks, "path").mapInArrow(run, READ_SCHEMA)


def archive_and_read(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page (page_id, url, html) to archives in `folder` (default: a new one in the shared folder), read them back.

    NULL html is an empty payload. Of pages with equal payloads of at least `least_bytes` bytes all but the one with the
    smallest id become revisits of it; rows that repeat that smallest id stay responses, and so do rows without an id. An
    empty table gives no archive and no rows. Further columns are not used.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(mark_revisits(pages, least_bytes=least_bytes), folder, archive_bytes), payloads=False)
