"""Archives against the pages they were made of, and against plain Zstandard readers."""

from __future__ import annotations

import base64
import glob
import hashlib
import io
import os
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from lexigrade.llm import warc
from tests.llm.conftest import prose

SCHEMA = "page_id long, url string, html string, sha1 string, largest int, path string, frame int"


def awkward_pages():
    same, body = "<p>" + prose(1, 50) + "</p>", prose(2, 40_000)
    return [
        (1, "https://a.example/x", same), (2, "https://a.example/y", same), (7, None, same), (3, "https://b.example/\r\nX: y z", "é \U0001f600 \x00"),
        (4, "u", None), (5, "", ""), (None, "n", same), (None, "n", "only null"), (None, "m", "only null"), (6, "r", "twice"), (6, "r", "twice"),
        (8, "long", body), (9, "lines", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"),
    ]


def frame(spark, pages):
    return spark.createDataFrame([(*p, "x", 1, "y", 2) for p in pages], SCHEMA).repartition(3)


def expected(pages, min_bytes=0):
    raw = [(i, (h or "").encode()) for i, _, h in pages]
    out = []
    for page, payload in raw:
        ids = [i for i, other in raw if other == payload and i is not None]
        largest = max(ids) if ids and len(payload) >= min_bytes else None
        revisit = largest is not None and page != largest
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", largest if revisit else None))
    return sorted(out, key=repr)


def records(df):
    return sorted((tuple(r) for r in df.select("page", "payload_bytes", "payload_digest", "type", "refers_to").collect()), key=repr)


def as_text(rows):
    return sorted(((None if p is None else str(p), n, d, t, None if r is None else str(r)) for p, n, d, t, r in rows), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 100])
@pytest.mark.parametrize("sizes", [{}, {"frame_bytes": 300, "bundle_bytes": 500}])
def test_archives_read_back(spark, min_bytes, sizes):
    pages = awkward_pages()
    index = warc.archive(frame(spark, pages), params=warc.WarcParams(min_bytes=min_bytes, **sizes))
    back = warc.read_archives(warc.bundles(index))
    assert records(back) == as_text(expected(pages, min_bytes))
    payloads = sorted(bytes(r["payload"]) for r in back.where("type = 'response'").collect())
    wanted = expected(pages, min_bytes)
    assert len(payloads) == sum(kind == "response" for _, _, _, kind, _ in wanted)
    assert set(payloads) == {(h or "").encode() for _, _, h in pages}


def test_query_form(spark):
    found = warc.archived_pages(frame(spark, awkward_pages()))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(awkward_pages())
    assert warc.archived_pages(frame(spark, [])).collect() == []


def test_index_finds_single_records(spark):
    """A record is read through its identifier, frame and offset; only its frame is decompressed."""
    pages = [(i, f"https://h.example/{i}", f"<p>{prose(i, 60)}</p>") for i in range(200)]
    index = warc.archive(frame(spark, pages), params=warc.WarcParams(frame_bytes=2_000, bundle_bytes=20_000))
    assert index.select("path").distinct().count() > 3 and index.agg(F.max("frame")).first()[0] > 3
    digest = base64.b32encode(hashlib.sha1(pages[77][2].encode()).digest()).decode()
    wanted = index.where(F.col("record_id") == warc.record_uuid(77, digest))
    (row,) = warc.fetch(wanted).collect()
    assert (row["page"], row["uri"], bytes(row["payload"]).decode()) == ("77", *pages[77][1:])
    every = warc.fetch(index)
    assert records(every) == as_text(expected(pages))


def test_bundles_are_plain_zstandard_and_seekable(spark, tmp_path):
    pages = [(i, "u", f"{prose(i % 40, 80)}") for i in range(120)]
    params = warc.WarcParams(frame_bytes=4_000, bundle_bytes=30_000)
    index = warc.archive(frame(spark, pages), str(tmp_path), params)
    seen = 0
    for path in glob.glob(f"{tmp_path}/*.warc.zst"):
        raw = open(path, "rb").read()
        count, flags, magic = struct.unpack("<IBI", raw[-9:])
        assert (flags, magic) == (0x80, 0x8F92EAB1)
        start = len(raw) - 17 - 12 * count
        assert struct.unpack("<II", raw[start : start + 8]) == (0x184D2A5E, 12 * count + 9)
        sizes = [struct.unpack_from("<III", raw, start + 8 + 12 * i) for i in range(count)]
        assert sum(s for s, _, _ in sizes) == start and all(p <= 4_000 for _, p, _ in sizes)
        # Frames are independent: each decompresses alone; all together, the skipped table included, are one WARC file.
        at, plain = 0, b""
        for size, length, _ in sizes:
            plain += zstandard.ZstdDecompressor().decompress(raw[at : at + size], max_output_size=length)
            at += size
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        assert whole == plain
        kinds = [fields["warc-type"] for _, _, fields, _ in warc.parse_records(plain)]
        assert kinds[0] == "warcinfo" and kinds.count("warcinfo") == 1
        seen += len(kinds) - 1
    assert seen == 120 == index.count()


def test_only_committed_bundles_are_read(spark, tmp_path):
    """What a lost attempt leaves behind is not in the index, so nobody reads it."""
    index = warc.archive(frame(spark, [(1, "u", "x")]), str(tmp_path))
    lost = warc.BundleWriter(str(tmp_path), warc.WarcParams())
    lost.add(warc.page_record(9, "u", b"lost", None, False, "1970-01-01T00:00:00Z")[1])
    lost.close()
    assert [r["page"] for r in warc.read_archives(warc.bundles(index)).collect()] == ["1"]
    assert len(os.listdir(tmp_path)) >= 2


def test_damage_is_found(tmp_path):
    bundle = warc.BundleWriter(str(tmp_path), warc.WarcParams(frame_bytes=100))
    bundle.add(warc.page_record(1, "u", b"x" * 500, None, False, "1970-01-01T00:00:00Z")[1])
    bundle.close()
    raw = bytearray(open(bundle.path, "rb").read())
    raw[-10] ^= 1  # the checksum of the last frame
    open(bundle.path, "wb").write(raw)
    reader = warc.BundleReader(bundle.path)
    reader.frame(0)
    with pytest.raises(ValueError, match="frame 1 is damaged"):
        reader.frame(1)
    open(bundle.path, "wb").write(raw[:-1])
    with pytest.raises(ValueError, match="no seek table"):
        warc.BundleReader(bundle.path)
