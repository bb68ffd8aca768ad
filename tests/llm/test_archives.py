import base64
import hashlib
import io
import struct

import pytest
import zstandard

import __spark_entry__ as entry
from tests.llm.shared import SF
from tillstream.llm import registry, warc
from tillstream.sources.settings import fresh_folder
from tools.compare import compare, connect


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, name):
    matches, note = compare(spark, connect(SF), SF, name)
    assert matches, note


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def record(text="<p>x</p>", page=1, refers=None, url="http://a/b"):
    payload = text.encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    row = {"page_id": page, "url": url, "payload": payload, "digest": digest, "refers_to": refers}
    return warc.record_bytes(row, "2024-01-01T00:00:00Z")


def archive(records, limit=warc.ARCHIVE_BYTES):
    out = io.BytesIO()
    assert warc.write_archive(out, iter(records), limit) == len(records)
    return out.getvalue()


def test_archive_begins_with_its_dictionary_and_has_a_frame_per_record():
    records = [record(f"<html>page {i} {'same words ' * 40}{i * 7919}</html>" * 3, i) for i in range(400)]
    data = archive(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == warc.ZSTD_MAGIC and size < len(data)
    assert list(warc.frames(io.BytesIO(data))) == records
    assert [warc.parsed(r).page_id for r in records] == list(range(400))
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    bare = struct.pack("<II", magic, len(plain)) + plain + data[8 + size :]
    assert list(warc.frames(io.BytesIO(bare))) == records
    assert len(data) < len(b"".join(zstandard.compress(r) for r in records))


def test_archives_without_dictionary_and_empty_ones():
    assert list(warc.frames(io.BytesIO(archive([record()])))) == [record()]
    assert list(warc.frames(io.BytesIO(b""))) == [] and archive([]) == b""


def test_small_reads_do_not_matter(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 3)
    records = [record("a"), record("b" * 1000), record("")]
    assert list(warc.frames(io.BytesIO(archive(records)))) == records


def test_skippable_frames_may_stand_anywhere(monkeypatch):
    records = [record("a"), record("b" * 1000)]

    def skippable(number, content):
        return struct.pack("<II", 0x184D2A50 + number, len(content)) + content

    data = zstandard.compress(records[0]) + skippable(3, b"x" * 5000) + skippable(0, b"") + zstandard.compress(records[1]) + skippable(15, b"end")
    for read_bytes in (1, 7, 1 << 16):
        monkeypatch.setattr(warc, "READ_BYTES", read_bytes)
        assert list(warc.frames(io.BytesIO(data))) == records
        with pytest.raises(warc.Damaged):
            list(warc.frames(io.BytesIO(data[:-1])))


@pytest.mark.parametrize(
    "harm",
    [
        lambda d: d[:-3],
        lambda d: d[:20] + b"\x00" + d[21:],
        lambda d: d + b"rest",
        lambda d: zstandard.compress(record().replace(b"Content-Length: ", b"Content-Length: 1", 1)),
        lambda d: zstandard.compress(record().replace(b"<p>x", b"<p>y")),
        lambda d: zstandard.compress(record() + b"more"),
        lambda d: zstandard.compress(record().replace(b"WARC/1.1", b"WARC/9.9")),
        lambda d: zstandard.compress(record().replace(b"WARC-Date", b"WARC-Dart")),
    ],
)
def test_damage_is_refused(harm):
    with pytest.raises(warc.Damaged):
        for data in warc.frames(io.BytesIO(harm(zstandard.compress(record())))):
            warc.parsed(data)


def test_round_trip_of_awkward_pages(spark):
    long = "<p>" + "long " * 300_000
    pages = [
        (3, "u", "same"), (1, "http://x/ä\r\nInjected: 1", "same"), (2, None, "same"), (1, "u", "same"), (4, "u", None), (5, "u", ""),
        (None, "u", "same"), (None, None, None), (6, "u", long), (7, "u", "Ünï 😀\r\n\r\nrest"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as payload", "2 as first", "3 as digest")
    made = warc.write_archives(warc.planned(frame), fresh_folder(spark, "warc-test"), limit=1)
    got = warc.read_archives(made).collect()
    assert made.agg({"n_records": "sum"}).first()[0] == len(pages) == len(got)
    for r in got:
        html = r.payload.decode() if r.payload is not None else None
        if r.record_type == "response":
            assert (r.page_id, html) in {(i, h or "") for i, _, h in pages} and r.payload_bytes == len(html.encode())
    kinds = sorted((repr(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted(
        [("1", "response", None)] * 2 + [("2", "revisit", 1), ("3", "revisit", 1), ("4", "response", None), ("5", "revisit", 4)]
        + [("None", "response", None)] * 2 + [("6", "response", None), ("7", "response", None)], key=lambda k: (k[0], k[1])
    )
    assert all(r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode() for r in got if r.payload is not None)


def test_small_payloads_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = {r.page_id: r.refers_to for r in warc.planned(pages, min_bytes=3).collect()}
    assert kinds == {1: None, 2: None, 3: None, 4: 3}
    none = warc.write_archives(warc.planned(pages.limit(0)), fresh_folder(spark, "warc-none"))
    assert none.count() == 0 and warc.read_archives(none).count() == 0
