import gzip
import io
import os
import uuid
import zlib
from base64 import b32encode
from hashlib import sha1

import pytest

from grainmill.llm.catalog import QUERIES, SQL
from grainmill.llm.warc import Inflated, header_value, normalise, page_records, parse_head, read_records, write_archives
from grainmill.session import scratch_path

import oracle

PAGES = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (9, "http://c/", "<p>same</p>"), (9, "http://c/", "<p>same</p>"),
    (9, "http://b/", "<p>same</p>"), (3, None, None), (4, "", ""), (None, "http://d/ x\r\ny", ""), (5, "http://e/é", "é\r\n\r\nWARC/1.1\r\n"),
    (None, None, "alone"), (6, "http://f/", "long " * 300_000), (7, "x" * 5_000, "\x00\x01"), (None, "u", "only null"), (None, "v", "only null"),
]


def plain(pages, least=0):
    """Rows of the result, by groups in memory."""
    groups, found = {}, []
    for i, (page, url, html) in enumerate(pages):
        data = (html or "").encode()
        key = data if len(data) >= least else (data, i)
        groups.setdefault(key, []).append((page is not None, page or 0, url is not None, url or ""))
    for key, of in groups.items():
        data = key if isinstance(key, bytes) else key[0]
        digest = b32encode(sha1(data).digest()).decode()
        of.sort()
        ids = [page if known else None for known, page, _, _ in of]
        found += [(page, len(data), digest, "revisit", ids[-1]) for page in ids[:-1]] + [(ids[-1], len(data), digest, "response", None)]
    return sorted(map(repr, found))


def told(df):
    return sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in df.collect())


def trip(spark, pages, file_bytes=1 << 26, **options):
    raw, members = scratch_path(spark, "raw"), scratch_path(spark, "members")
    archives = write_archives(page_records(pages, **options), raw, file_bytes=file_bytes)
    return archives, raw, normalise(archives, raw, members), members


@pytest.mark.parametrize("least, heavy, file_bytes", [(0, 100_000, 1 << 26), (5, 1, 3_000), (6, 2, 1)])
def test_round_trip_like_groups_in_memory(spark, frame, least, heavy, file_bytes):
    pages = frame([(*p, "x", 1) for p in PAGES], "page_id int, url string, html string, key string, size int")
    archives, raw, index, members = trip(spark, pages, file_bytes, least=least, heavy=heavy)
    got = read_records(index, members)
    assert told(got) == plain(PAGES, least)
    texts = {(html or "").encode() for _, _, html in PAGES}
    assert {bytes(r.payload) for r in got.where("record_type = 'response'").collect()} == texts
    assert len({r.record_id for r in index.collect()}) == len(PAGES)


def test_files_members_and_sidecar(spark, frame):
    archives, raw, index, members = trip(spark, frame(PAGES, "page_id int, url string, html string"))
    root = members.removeprefix("file://")
    names = {r.path for r in index.collect()}
    assert {r.records for r in archives.collect()} and sum(r.records for r in archives.collect()) == len(PAGES)
    for r in archives.collect():
        whole = open(f"{raw.removeprefix('file://')}/{r.path}", "rb").read()
        one = zlib.decompressobj(31)
        assert len(one.decompress(whole)) == r.bytes and one.eof and not one.unused_data
    for name in names:
        data = open(f"{root}/{name}", "rb").read()
        rows = sorted((r for r in index.collect() if r.path == name), key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))] and sum(r.length for r in rows) == len(data)
        lines = open(f"{root}/{name}.idx", encoding="utf-8").read().splitlines()
        assert lines == [f"{r.offset}\t{r.length}\t{r.record_id}\t{r.record_type}" for r in rows]
        for r in rows:
            record = gzip.decompress(data[r.offset : r.offset + r.length])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def record(n, block):
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{n}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_normalises_foreign_archives(spark, tmp_path):
    blocks = [b"", b"one\r\n\r\ntwo", os.urandom(700_000), b"\r\n"]
    mixed = gzip.compress(record(0, blocks[0]) + record(1, blocks[1])[:30]) + gzip.compress(record(1, blocks[1])[30:] + record(2, blocks[2])) + gzip.compress(record(3, blocks[3]))
    (tmp_path / "a.warc.gz").write_bytes(mixed)
    (tmp_path / "empty.warc.gz").write_bytes(gzip.compress(b""))
    found = normalise(spark.createDataFrame([("a.warc.gz",), ("empty.warc.gz",)], "path string"), str(tmp_path), str(tmp_path / "new")).orderBy("offset").collect()
    assert [(r.record_id, r.record_type) for r in found] == [(f"<{n}>", "resource") for n in range(4)]
    for r, block in zip(found, blocks):
        data = (tmp_path / "new" / r.path).read_bytes()[r.offset : r.offset + r.length]
        assert gzip.decompress(data) == record(int(r.record_id[1]), block)


@pytest.mark.parametrize("cut", [5, 40, 200])
def test_broken_archives_are_errors(cut):
    whole = gzip.compress(record(1, os.urandom(300)))
    stream = Inflated(io.BytesIO(whole[:-cut]))
    with pytest.raises(ValueError):
        while (head := stream.head()) is not None:
            list(stream.block(int(parse_head(head)["content-length"])))


def test_no_pages(spark, frame):
    archives, raw, index, members = trip(spark, frame([], "page_id long, url string, html string"))
    assert (archives.count(), index.count(), read_records(index, members).count()) == (0, 0, 0)


def test_header_values():
    assert header_value("a b\r\nWARC-Type: x\x7f") == "a%20b%0D%0AWARC-Type:%20x%7F"
    with pytest.raises(ValueError):
        parse_head(b"HTTP/1.1 200 OK\r\n\r\n")


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert oracle.compare(QUERIES["op11_archives"](spark, folder), oracle.connect(folder), SQL["op11_archives"]) == []
