import base64
import hashlib
import io
import struct
import zipfile
from collections import defaultdict

import pytest

from limnospark.llm import warc
from limnospark.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, digest string, holder string"


def ranges_of(data):
    asked = []

    def read_at(start, count):
        asked.append(count)
        return data[start : start + count]

    return warc.ZipFileRanges(read_at, len(data)), asked


def zipped(members, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"x" * 65_535, b"PK\x05\x06 in the comment"])
@pytest.mark.parametrize("limit", [None, 10])
def test_directories(monkeypatch, comment, limit):
    if limit:  # everything above ten bytes takes the ZIP64 fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    members = {"a": b"first" * 9, "indexes/é.cdxj": b"", "archive/b": bytes(range(256)) * 100}
    data = zipped(members, comment)
    assert (warc.ZIP64_END in data) == bool(limit)
    ranges, _ = ranges_of(b"leading" * 0 + data)
    assert {n: ranges.read(n) for n in ranges.members} == members
    assert [m.size for m in ranges.members.values()] == [len(m) for m in members.values()]


def test_wide_fields_in_order():
    extra = struct.pack("<HHI", 9, 4, 7) + struct.pack("<HHQQ", 1, 16, 5 << 32, 6 << 32)
    assert warc._wide(extra, 0xFFFFFFFF, 12, 0xFFFFFFFF) == [5 << 32, 12, 6 << 32]


def test_members_are_not_extracted():
    data = zipped({"archive/big": b"z" * 1_000_000, "small": b"s"})
    ranges, asked = ranges_of(data)
    assert ranges.read("small") == b"s" and sum(asked) < 70_000


def test_refused():
    with pytest.raises(ValueError):
        ranges_of(b"no archive")
    ranges, _ = ranges_of(zipped({"a": b"x" * 1000}, method=zipfile.ZIP_DEFLATED))
    with pytest.raises(ValueError):
        ranges.read("a")


def expected(rows, least=0):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    result = []
    for page, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p in groups[html or ""] if p is not None]
        holder = max(ids) if ids and len(payload) >= least else None
        revisit = holder is not None and page != holder
        result.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", holder if revisit else None))
    return sorted(result, key=str)


ROWS = [(1, "http://a/", "<p>x"), (2, "http://b\r\nX: y", "<p>x"), (3, None, None), (4, "", ""), (None, "u", "<p>x"), (None, "v", "alone"),
        (-5, "w", "HTTP\r\n\r\nWARC/1.1\r\n\r\n"), (6, "y", "é" * 300_000), (7, "z", "é" * 300_000), (8, "q", "z"), (8, "q", "z")]


@pytest.mark.parametrize("least,archive", [(0, 1), (0, 1 << 20), (3, 1 << 20)])
def test_round_trip(spark, least, archive):
    df = spark.createDataFrame([(*r, "a", "b") for r in ROWS], SCHEMA)
    archives = warc.write_archives(df, least_bytes=least, archive_bytes=archive)
    records = warc.read_records(archives)
    got = records.select(warc.page_of("urn"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to")).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS, least)
    payloads = {bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    assert payloads == {html or "" for _, _, html in ROWS}
    for row in archives.collect():
        system, path = warc.open_folder(row.folder)
        with zipfile.ZipFile(f"{path}/{row['name']}") as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}


def test_empty_table(spark):
    assert warc.read_records(warc.write_archives(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    got = QUERIES["op8_warc"](spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
