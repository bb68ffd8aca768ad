"""WARC archives compressed with Zstandard: one frame for each record, the dictionary first.

An archive may begin with a skippable frame that holds the dictionary, plain or itself
compressed; every further frame is one record. Archives are written and read in tasks,
record by record, so that a task never holds more than one record and the rows on their
way to Spark.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import stored

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
ARCHIVE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
READ_BYTES = 1 << 20
ID_PREFIX = "urn:record:"

RECORD = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, target_uri string, payload binary"
RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("target_uri", pa.string()), ("payload", pa.binary()),
    ]
)


class Damaged(ValueError):
    """An archive that isn't what its headers say."""


class Record(NamedTuple):
    page_id: int | None
    record_type: str
    refers_to: int | None
    payload_digest: str
    payload_bytes: int
    target_uri: str | None
    payload: bytes | None


def base32(hex_digest: Column) -> Column:
    """Upper-case base 32 of 40 hex digits: each 5 of them are 4 letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for i in range(8):
        number = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("long")
        parts += [F.substring(letters, F.shiftright(number, 15 - 5 * k).bitwiseAND(31).cast("int") + 1, F.lit(1)) for k in range(4)]
    return F.concat(*parts)


def planned(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Decide which records are responses and which revisit one.

    Of pages whose payloads are equal and have at least `min_bytes` bytes, that with the
    smallest id is the response. A page without an id is a response, and so are rows that
    repeat the smallest id. Returns page_id, url, payload, digest, n_bytes, refers_to.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    heads = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"n_bytes": F.octet_length("payload").cast("long"), "same": F.sha2("payload", 256)})
    large = heads.where((F.col("n_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = large.groupBy("same").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    first = first.where("first < last").select(F.col("same").alias("of"), F.xxhash64("same").alias("spread"), "first")
    # The second key makes both sides shuffle for the join itself, so that a hot payload can be split there.
    found = heads.join(first, (heads["same"] == first["of"]) & (F.xxhash64(heads["same"]) == first["spread"]), "left")
    repeats = (F.col("n_bytes") >= min_bytes) & (F.col("page_id") != F.col("first"))
    return found.select(
        "page_id", "url", "payload", base32(F.sha1("payload")).alias("digest"), "n_bytes", F.when(repeats, F.col("first")).alias("refers_to")
    )


def record_bytes(row: dict, date: str) -> bytes:
    """One record. A revisit keeps the HTTP head, with the full payload's length, and no payload."""
    revisit = row["refers_to"] is not None
    payload = row["payload"] or b""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    number = "none" if row["page_id"] is None else row["page_id"]
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{ID_PREFIX}{number}>"), ("WARC-Date", date)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", quote(row["url"], safe="%/:=&?~#+!$,;'@()*[]")))
    fields += [("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{row['refers_to']}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_archive(out: BinaryIO, records: Iterable[bytes], limit: int = ARCHIVE_BYTES) -> int:
    """Write records until about `limit` bytes; returns how many. The first ones train the dictionary."""
    records, sample, size, count = iter(records), [], 0, 0
    for record in records:
        sample.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    trained = None
    if len(sample) >= 16 and size >= 4 * DICTIONARY_BYTES:
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, [r[: 32 << 10] for r in sample])
        except zstandard.ZstdError:  # too alike or too few: no dictionary
            trained = None
    written = 0
    if trained is not None:
        packed = zstandard.ZstdCompressor().compress(trained.as_bytes())
        written += out.write(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
    pack = zstandard.ZstdCompressor(dict_data=trained, write_checksum=True, write_content_size=True)
    for part in (sample, records):
        for record in part:
            written += out.write(pack.compress(record))
            count += 1
            if part is records and written >= limit:
                return count
    return count


def write_archives(plan: DataFrame, folder: str, date: str | None = None, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records to archives in a shared folder, one or more for each task.

    Returns a stored table with path and n_records of the archives. A task that is run
    again writes files of the same names, each moved into place when it is whole.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        disk.create_dir(root, recursive=True)
        task = TaskContext.get()
        rows = (record_bytes(row, date) for batch in batches for i in range(len(batch)) for row in batch.slice(i, 1).to_pylist())
        number, more = 0, next(rows, None)
        while more is not None:
            name = f"{root}/part-{task.partitionId():05d}-{number:03d}.warc.zst"
            draft = f"{name}.{task.taskAttemptId()}"
            with disk.open_output_stream(draft, compression=None) as out:
                count = write_archive(out, chained(more, rows), limit)
            disk.move(draft, name)
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": pa.array([count], pa.int64())})
            number, more = number + 1, next(rows, None)

    return stored(plan.mapInArrow(write, "path string, n_records long"), "warc-list")


def chained(first, rest: Iterator) -> Iterator:
    yield first
    yield from rest


def frames(source: BinaryIO) -> Iterator[bytes]:
    """The content of each frame of an archive; the dictionary of a leading skippable frame is used."""
    start = source.read(8)
    trained = None
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", start[4:])[0]
        held = source.read(size)
        if len(held) != size:
            raise Damaged("the dictionary is cut short")
        if held[:4] == ZSTD_MAGIC:
            held = zstandard.ZstdDecompressor().decompress(held)
        trained, start = zstandard.ZstdCompressionDict(held), b""
    unpack = zstandard.ZstdDecompressor(dict_data=trained)
    pending = start
    while True:
        pending = pending or source.read(READ_BYTES)
        if not pending:
            return
        pending, skipped = without_skippable(pending, source)
        if skipped:
            continue
        frame, parts = unpack.decompressobj(), []
        while not frame.eof:
            if not pending:
                pending = source.read(READ_BYTES)
                if not pending:
                    raise Damaged("the last frame is cut short")
            try:
                parts.append(frame.decompress(pending))
            except zstandard.ZstdError as error:
                raise Damaged(f"a frame can't be decoded: {error}") from error
            pending = b""
        pending = frame.unused_data
        yield b"".join(parts)


# The magic numbers of skippable frames, which may stand anywhere and hold nothing to decode.
SKIPPABLE = range(0x184D2A50, 0x184D2A60)


def without_skippable(pending: bytes, source: BinaryIO) -> tuple[bytes, bool]:
    """The bytes behind a skippable frame, if one begins here."""
    while len(pending) < 8 and (more := source.read(READ_BYTES)):
        pending += more
    if len(pending) < 8 or struct.unpack("<I", pending[:4])[0] not in SKIPPABLE:
        return pending, False
    left = 8 + struct.unpack("<I", pending[4:8])[0]
    while len(pending) < left:
        left -= len(pending)
        pending = source.read(READ_BYTES)
        if not pending:
            raise Damaged("a skippable frame is cut short")
    return pending[left:], True


def parsed(data: bytes) -> Record:
    """Read one record and check it: version, fields, lengths, digests, nothing left over."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(VERSION):
        raise Damaged("no WARC/1.1 head")
    fields = {}
    for line in head[len(VERSION) :].decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged(f"not a field: {line[:60]!r}")
        fields[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing or not fields["content-length"].isdigit():
        raise Damaged(f"missing or bad fields: {sorted(missing) or fields['content-length']}")
    size = int(fields["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise Damaged(f"the block has not the stated {size} bytes")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise Damaged("the block's digest differs")
    http, found, payload = block.partition(b"\r\n\r\n")
    stated = next((v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"), None)
    kind = fields["warc-type"]
    if not found or stated is None or not stated.strip().isdigit() or kind not in ("response", "revisit"):
        raise Damaged("not a response with a stated length")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    full = int(stated)
    if kind == "response" and (len(payload) != full or base32_sha1(payload) != digest):
        raise Damaged("the payload's length or digest differs")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise Damaged("a revisit has a payload, or refers to nothing")
    number, origin = (
        (lambda x: int(x) if x.lstrip("-").isdigit() else None)(fields.get(f, "").strip("<>").removeprefix(ID_PREFIX))
        for f in ("warc-record-id", "warc-refers-to")
    )
    return Record(number, kind, origin, digest, full, fields.get("warc-target-uri"), payload if kind == "response" else None)


def read_archives(paths: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives named in the column `path`, in any number of tasks.

    A damaged archive fails the query: nothing is skipped. Without `payload` the payloads
    are checked but not returned.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                disk, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
                rows, size = [], 0
                with disk.open_input_stream(name, compression=None) as source:
                    for data in frames(source):
                        record = parsed(data)
                        rows.append(record if payload else record._replace(payload=None))
                        size += len(data) if payload else 512
                        if size >= BATCH_BYTES:
                            yield packed_rows(rows)
                            rows, size = [], 0
                if rows:
                    yield packed_rows(rows)

    return paths.select("path").mapInArrow(read, RECORD)


def packed_rows(rows: list[Record]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_ARROW)], schema=RECORD_ARROW)
