"""WARC archives in seekable Zstandard bundles.

A task streams its pages into bundles. Records are gathered into independent frames of bounded size (a record never crosses two frames, one that
is longer makes a frame of its own), and a bundle ends with the seek table of the public seekable format: a skippable frame with the compressed
and plain size and the checksum of every frame. Any Zstandard reader that skips skippable frames sees a plain WARC file. The index maps
the identifier of a record to its bundle, its frame and its offset in that frame, so one record costs the read of one frame.

Of pages with equal payloads of at least ``min_bytes`` the one with the largest id is a ``response``, the others are ``revisit`` records that
refer to it and hold no payload; smaller payloads are all responses. Equal payloads are counted before the shuffle; where one payload is on
very many pages, the join with the counts can be split, as it has one row per payload.

A bundle is named anew by each attempt of a task and counts only when its index rows are committed with Spark's table of the index. What a lost
executor leaves behind is never read. Bundles are written and read through ``pyarrow.fs``, so the folder may be any that it and all executors reach.

A null payload is empty, a null id is smaller than any other and stays null, a null url is left out of its record. Rows that share id and
payload are equal records with one identifier: all of them are responses if no larger id has that payload. An empty table gives no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.session import shared_dir, write_stage

# Fixed values of the seekable format: a skippable frame's magic number, the footer's magic number, the flag of checksums.
SKIPPABLE, SEEKABLE, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER, HEAD = "<III", "<IBI", "<II"

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


class WarcParams(NamedTuple):
    # Payload bytes from which equal payloads are kept once.
    min_bytes: int = 0
    # Plain bytes after which a frame is closed, compressed bytes after which a bundle is.
    frame_bytes: int = 1 << 20
    bundle_bytes: int = 1 << 28
    level: int = 3
    # Time of capture of every record.
    date: str = "1970-01-01T00:00:00Z"


class Frame(NamedTuple):
    start: int
    size: int
    plain: int
    checksum: int


# -- records ----------------------------------------------------------------------------------------


def record_uuid(page: object, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}')}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _head(fields: list[tuple[str, object]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *[f"{name}: {value}\r\n" for name, value in fields if value is not None], "\r\n"]).encode()


def page_record(page: object, url: str | None, payload: bytes, refers_to: object | None, revisit: bool, date: str) -> tuple[str, bytes]:
    """Identifier and bytes of the record of one page."""
    digest = payload_digest(payload)
    block = HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    name = record_uuid(page, digest)
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m.group()), url)
    number = lambda value: None if value is None else quote(str(value), safe="")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{record_uuid(refers_to, digest)}>" if revisit else None),
        ("X-Refers-To-Page-ID", number(refers_to) if revisit else None),
        ("X-Page-ID", number(page)),
        ("X-Payload-Length", len(payload)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return name, _head(fields) + block + b"\r\n\r\n"


def info_record(name: str, date: str) -> bytes:
    block = b"software: lexigrade\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
    return _head([*fields, ("Content-Length", len(block))]) + block + b"\r\n\r\n"


def parse_records(plain: bytes, start: int = 0, end: int | None = None) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields (lower-cased names) and block of every record between ``start`` and ``end``."""
    at, end = start, len(plain) if end is None else end
    while at < end:
        close = plain.index(b"\r\n\r\n", at)
        lines = plain[at:close].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at offset {at}")
        fields = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines[1:])}
        body = close + 4
        after = body + int(fields["content-length"])
        if plain[after : after + 4] != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} has a wrong length")
        yield at, after + 4 - at, fields, plain[body:after]
        at = after + 4


# -- bundles ----------------------------------------------------------------------------------------


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:/", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


class BundleWriter:
    """One bundle; holds at most the records of one frame."""

    def __init__(self, folder: str, params: WarcParams):
        self.params, name = params, uuid.uuid4().hex
        self.path = f"{folder}/{name}.warc.zst"
        system, local = file_system(self.path)
        system.create_dir(local.rsplit("/", 1)[0], recursive=True)
        self.file = system.open_output_stream(local, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=params.level)
        self.plain, self.frames, self.written = bytearray(), [], 0
        self.add(info_record(name, params.date))

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, offset in it and length of the record."""
        if self.plain and len(self.plain) + len(record) > self.params.frame_bytes:
            self._close_frame()
        place = len(self.frames), len(self.plain), len(record)
        self.plain += record
        return place

    def _close_frame(self) -> None:
        plain = bytes(self.plain)
        packed = self.compressor.compress(plain)
        self.file.write(packed)
        self.frames.append(struct.pack(ENTRY, len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.written += len(packed)
        self.plain = bytearray()

    @property
    def full(self) -> bool:
        return self.written >= self.params.bundle_bytes

    def close(self) -> None:
        if self.plain:
            self._close_frame()
        table = b"".join(self.frames) + struct.pack(FOOTER, len(self.frames), WITH_CHECKSUMS, SEEKABLE)
        self.file.write(struct.pack(HEAD, SKIPPABLE, len(table)) + table)
        self.file.close()


class BundleReader:
    """Frames of one bundle by number; nothing but the seek table and the asked frame is read."""

    def __init__(self, path: str):
        system, local = file_system(path)
        self.path, self.file = path, system.open_input_file(local)
        size = self.file.size()
        count, flags, magic = struct.unpack(FOOTER, self._range(size - struct.calcsize(FOOTER), struct.calcsize(FOOTER)))
        if magic != SEEKABLE or flags != WITH_CHECKSUMS:
            raise ValueError(f"{path} has no seek table")
        length = count * struct.calcsize(ENTRY) + struct.calcsize(FOOTER)
        table = self._range(size - length - struct.calcsize(HEAD), length + struct.calcsize(HEAD))
        if struct.unpack_from(HEAD, table) != (SKIPPABLE, length):
            raise ValueError(f"{path} has a damaged seek table")
        self.frames, start = [], 0
        for i in range(count):
            packed, plain, checksum = struct.unpack_from(ENTRY, table, struct.calcsize(HEAD) + i * struct.calcsize(ENTRY))
            self.frames.append(Frame(start, packed, plain, checksum))
            start += packed

    def _range(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        frame = self.frames[number]
        plain = zstandard.ZstdDecompressor().decompress(self._range(frame.start, frame.size), max_output_size=frame.plain)
        if len(plain) != frame.plain or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != frame.checksum:
            raise ValueError(f"{self.path}: frame {number} is damaged")
        return plain


# -- jobs -------------------------------------------------------------------------------------------


def classified(pages: DataFrame, params: WarcParams = WarcParams(), page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``(page, url, payload, revisit, refers_to)`` of every page."""
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page"), F.col(url).cast("string").alias("url"), text.cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    shared = rows.where(F.octet_length("payload") >= params.min_bytes).groupBy(F.col("sha1").alias("same"))
    shared = shared.agg(F.max("page").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(shared, F.col("sha1") == F.col("same"), "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page").eqNullSafe(F.col("largest"))
    return joined.select("page", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("largest")).alias("refers_to"))


def archive(
    pages: DataFrame, folder: str | None = None, params: WarcParams = WarcParams(), page_id: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write the bundles and return their stored index ``(record_id, page, path, frame, offset, length)``."""
    rows = classified(pages, params, page_id, url, payload)
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    kind = rows.schema["page"].dataType

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            placed = []
            for page, target, body, revisit, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if bundle is None:
                    bundle = BundleWriter(folder, params)
                name, record = page_record(page, target, body, refers_to, revisit, params.date)
                placed.append((name, bundle.path, *bundle.add(record)))
                if bundle.full:
                    bundle.close()
                    bundle = None
            names, paths, frames, offsets, lengths = zip(*placed) if placed else [()] * 5
            columns = [pa.array(names, pa.string()), batch.column(0), pa.array(paths, pa.string()), pa.array(frames, pa.int32())]
            columns += [pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["record_id", "page", "path", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    schema = f"record_id string, page {kind.simpleString()}, path string, frame int, offset long, length long"
    return write_stage(rows.mapInArrow(write, schema), "warc-index")


_RECORD = "path string, frame int, offset long, length long, type string, record_id string, uri string, page string, refers_to string, "
_RECORD += "payload_bytes long, payload_digest string, payload binary"


class _Open:
    """The bundle that a task reads, with the frame that it read last."""

    def __init__(self) -> None:
        self.bundle, self.number, self.plain = None, -1, b""

    def frame(self, path: str, number: int) -> bytes:
        if self.bundle is None or self.bundle.path != path:
            self.bundle, self.number = BundleReader(path), -1
        if self.number != number:
            self.plain, self.number = self.bundle.frame(number), number
        return self.plain


def _record_row(place: tuple, fields: dict[str, str], block: bytes) -> tuple:
    kind, text = fields["warc-type"], lambda name: unquote(fields[name]) if name in fields else None
    payload = block[block.index(b"\r\n\r\n") + 4 :] if kind == "response" else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"{place}: the payload does not have its digest")
    return (
        *place, kind, fields["warc-record-id"][1:-1], fields.get("warc-target-uri"), text("x-page-id"), text("x-refers-to-page-id"),
        int(fields["x-payload-length"]), digest, payload,
    )


def _as_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names = [field.split(" ")[0] for field in _RECORD.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[field.split(" ")[1]] for field in _RECORD.split(", ")]
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held), types)], names=names)

    for row in rows:
        held.append(row)
        size += row[3]
        if size > 1 << 24:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def bundles(index: DataFrame) -> DataFrame:
    """The committed bundles of an index."""
    return index.select("path").distinct()


def read_archives(paths: DataFrame) -> DataFrame:
    """All page records of the bundles, frame by frame; frames are dealt to tasks whatever bundle they are in."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                numbers = range(len(BundleReader(path).frames))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(numbers)), pa.array(numbers, pa.int32())], names=["path", "frame"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            opened = _Open()
            for batch in batches:
                for path, number in zip(*[c.to_pylist() for c in batch.columns]):
                    for offset, length, fields, block in parse_records(opened.frame(path, number)):
                        if fields["warc-type"] != "warcinfo":
                            yield _record_row((path, number, offset, length), fields, block)

        yield from _as_batches(records())

    frames = paths.select("path").mapInArrow(tables, "path string, frame int")
    # A row stands for a whole frame, so the number of tasks is given: sizes of the rows say nothing.
    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frames.repartition(tasks, "path", "frame").sortWithinPartitions("path", "frame")
    return dealt.mapInArrow(read, _RECORD)


def fetch(located: DataFrame) -> DataFrame:
    """The records at ``(path, frame, offset, length)``, such as rows of the index: each costs the read of its frame."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            opened = _Open()
            for batch in batches:
                for path, number, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                    for _, _, fields, block in parse_records(opened.frame(path, number), offset, offset + length):
                        yield _record_row((path, number, offset, length), fields, block)

        yield from _as_batches(records())

    places = located.select("path", "frame", "offset", "length").repartition("path", "frame").sortWithinPartitions("path", "frame", "offset")
    return places.mapInArrow(read, _RECORD)


def archived_pages(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every page, as read back from its archive."""
    index = archive(pages, params=params)
    kind = pages.schema["page_id"].dataType
    return read_archives(bundles(index)).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
