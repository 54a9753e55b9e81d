"""Web archives packed in ZIP files, read by range without extraction.

An archive is a ZIP file whose members are stored, not compressed: `archive/pages.warc.gz`, WARC records each
in a gzip member of its own, and `indexes/pages.cdxj`, one JSON line for each record with its place in
that member. A reader looks at the end of the file, goes by way of the ZIP64 locator where there is one to
the central directory, takes the members' places from it and the records' places from the index, and
then reads just the bytes of the records it wants.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from limnospark.llm.shared import named, new_folder, open_folder, partitions, stored, text_of

# Signatures of the ZIP format.
LOCAL_HEADER, DIRECTORY_ENTRY, DIRECTORY_END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
ZIP64_LOCATOR, ZIP64_END = b"PK\x06\x07", b"PK\x06\x06"
# Names of the WARC format.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS, INDEX = "archive/pages.warc.gz", "indexes/pages.cdxj"
READ_BYTES = 4 << 20
CHUNK_RECORDS = 2_048


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored_size: int
    header_at: int


class ZipFileRanges:
    """Members of a ZIP file by their places; `read_at(start, count)` is all that is asked of the file."""

    def __init__(self, read_at, size: int):
        self._read_at, self._size = read_at, size
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self._size - 22 - 65_535)  # the end record and the longest comment after it
        tail = self._read_at(tail_at, self._size - tail_at)
        end = tail.rfind(DIRECTORY_END)
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(DIRECTORY_END, 0, end)  # the signature may stand in the comment
        if end < 0:
            raise ValueError("no end of a ZIP directory")
        count, length, at = struct.unpack_from("<HII", tail, end + 10)
        locator_at = tail_at + end - 20
        if locator_at >= 0 and (locator := self._read_at(locator_at, 20))[:4] == ZIP64_LOCATOR:
            record = self._read_at(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != ZIP64_END:
                raise ValueError("the ZIP64 locator points to no end record")
            count, length, at = struct.unpack_from("<QQQ", record, 32)
        entries, place = self._read_at(at, length), 0
        for _ in range(count):
            if entries[place : place + 4] != DIRECTORY_ENTRY:
                raise ValueError("broken ZIP directory")
            flags, method = struct.unpack_from("<HH", entries, place + 8)
            small, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", entries, place + 20)
            header_at = struct.unpack_from("<I", entries, place + 42)[0]
            name = entries[place + 46 : place + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = entries[place + 46 + n_name : place + 46 + n_name + n_extra]
            size, small, header_at = _wide(extra, size, small, header_at)
            yield Member(name, method, size, small, header_at)
            place += 46 + n_name + n_extra + n_comment

    def start(self, name: str) -> int:
        """Where the bytes of a stored member begin."""
        member = self.members[name]
        if member.method:
            raise ValueError(f"{name} is compressed and can't be read by range")
        header = self._read_at(member.header_at, 30)
        if header[:4] != LOCAL_HEADER:
            raise ValueError(f"no header for {name}")
        return member.header_at + 30 + sum(struct.unpack_from("<HH", header, 26))

    def read(self, name: str) -> bytes:
        return self._read_at(self.start(name), self.members[name].size)


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values of an entry; those that do not fit in 32 bits stand in its ZIP64 field, in this order."""
    place, wide = 0, b""
    while place + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, place)
        if kind == 1:
            wide = extra[place + 4 : place + 4 + length]
        place += 4 + length
    result, place = [], 0
    for value in values:
        if value == 0xFFFFFFFF:
            value = struct.unpack_from("<Q", wide, place)[0]
            place += 8
        result.append(value)
    return result


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", len(block))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload of a record that holds an HTTP response."""
    head, _, rest = record.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _headers(http), payload


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


class _ArchiveWriter:
    def __init__(self, folder: str, name: str):
        self._system, path = open_folder(folder)
        self._name, self._draft = f"{path}/{name}", f"{path}/.{name}-{uuid.uuid4().hex}"
        self._sink = self._system.open_output_stream(self._draft)
        self._zip = zipfile.ZipFile(self._sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._records = self._zip.open(RECORDS, "w", force_zip64=True)
        self._index: list[str] = []
        self.size = 0

    def add(self, row: dict, record: bytes) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self._records.write(packed)
        self._index.append(json.dumps({"urn": row["urn"], "url": row["url"], "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> int:
        """Only whole files get their names, so a task that runs again replaces them by equal ones."""
        self._records.close()
        self._zip.writestr(INDEX, "\n".join(self._index))
        self._zip.close()
        self._sink.close()
        named(self._system, self._draft, self._name)
        return len(self._index)


def urn(page: str | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(name: str) -> Column:
    """The page id in a record's name, null for pages without one."""
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def write_archives(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = 256 << 20,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each page; one row for each archive: folder, name, records.

    Of records with equal payloads of at least `least_bytes` bytes, that with the largest page_id holds
    the payload, and the others are revisits that refer to it; rows that repeat its id are alike and hold it
    too. Null html counts as empty; a page without an id revisits like others, or holds its payload if no
    page with an id does. An empty table has no archive.
    """
    spark = pages.sparkSession
    payload = F.encode(text_of("html"), "UTF-8")
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digest = F.unhex(F.sha1("payload"))
    holders = stored(given.where(F.length("payload") >= least_bytes).groupBy(digest.alias("digest")).agg(F.max("page_id").alias("holder")), "holders")
    known = given.withColumn("digest", digest).join(holders, "digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    rows = known.select(
        "page_id", "url", "digest", F.length("payload").cast("long").alias("size"), F.when(revisit, F.col("holder")).alias("holder"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    folder = new_folder(spark, "archives")
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for row in (row for at in range(0, batch.num_rows, 64) for row in batch.slice(at, 64).to_pylist()):
                if writer is not None and writer.size >= archive_bytes:
                    done.append((name, writer.close()))
                    writer, number = None, number + 1
                if writer is None:
                    name = f"pages-{part:06d}-{number:04d}.zip"
                    writer = _ArchiveWriter(folder, name)
                row["urn"] = urn(row["page_id"])
                writer.add(row, _page_record(row, date))
        if writer is not None:
            done.append((name, writer.close()))
        if done:
            yield pa.RecordBatch.from_pydict({"folder": [folder] * len(done), "name": [n for n, _ in done], "records": [c for _, c in done]})

    return stored(rows.mapInArrow(write, "folder string, name string, records long"), "archive-list")


def _page_record(row: dict, date: str) -> bytes:
    headers = [
        ("WARC-Type", "response" if row["payload"] is not None else "revisit"), ("WARC-Record-ID", row["urn"]), ("WARC-Date", date),
        ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base64.b32encode(row['digest']).decode()}"),
    ]
    if row["url"] is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), row["url"])))
    if row["payload"] is None:
        headers += [("WARC-Refers-To", urn(row["holder"])), ("WARC-Profile", IDENTICAL)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    return record_bytes(headers, http.encode() + (row["payload"] or b""))


def read_records(archives: DataFrame) -> DataFrame:
    """Each record of the archives: urn, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    A revisit has no payload; its size and digest are those its headers give. A payload that does not have
    the digest in its record's headers is an error. Tasks take ranges of records, not whole archives.
    """
    chunks = archives.withColumn("first", F.explode(F.expr(f"sequence(0L, records - 1, {CHUNK_RECORDS}L)")))
    schema = "urn string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    names = [field.split()[0] for field in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = open_folder(row["folder"])
                with system.open_input_file(f"{path}/{row['name']}") as file:
                    for records in _ranges(file, row["first"]):
                        columns = zip(*map(_result, records))
                        yield pa.record_batch([pa.array(c, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
                                               for n, c in zip(names, columns)], names=names)

    dealt = chunks.repartition(partitions(archives.sparkSession), "folder", "name", "first")
    return dealt.select("folder", "name", "first").mapInArrow(read, schema)


def _ranges(file, first: int) -> Iterator[list[bytes]]:
    """Records `first` to `first + CHUNK_RECORDS` of an archive; neighbours are read together, up to `READ_BYTES`."""
    def read_at(start: int, count: int) -> bytes:
        return file.read_at(count, start)

    ranges = ZipFileRanges(read_at, file.size())
    begin = ranges.start(RECORDS)
    places = [json.loads(line) for line in ranges.read(INDEX).split(b"\n")[first : first + CHUNK_RECORDS]]
    while places:
        count = 1
        while count < len(places) and places[count]["offset"] + places[count]["length"] - places[0]["offset"] <= READ_BYTES:
            count += 1
        at = places[0]["offset"]
        held = read_at(begin + at, places[count - 1]["offset"] + places[count - 1]["length"] - at)
        yield [zlib.decompress(held[p["offset"] - at : p["offset"] - at + p["length"]], 31) for p in places[:count]]
        places = places[count:]


def _result(record: bytes) -> tuple:
    warc, http, payload = parse_record(record)
    digest, revisit = warc["warc-payload-digest"].removeprefix("sha1:"), warc["warc-type"] == "revisit"
    if not revisit and digest_of(payload) != digest:
        raise ValueError(f"{warc['warc-record-id']}: the payload is not the one its digest names")
    size = int(http["content-length"]) if revisit else len(payload)
    return (warc["warc-record-id"], warc.get("warc-target-uri"), warc["warc-type"], warc.get("warc-refers-to"), size, digest,
            None if revisit else payload)
