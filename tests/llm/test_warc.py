"""Archives written, read back and assembled, against plain versions."""

import base64
import gzip
import hashlib
import io

import pytest

from meterflow.llm import warc_captures as w
from meterflow.llm.common import kept, table
from tests.compare import compare, duck

PAGES = "page_id long, url string, html string"


def plain(rows, least=0):
    last = {}
    for i, (page, _, html) in enumerate(rows):
        key = (html or "").encode()
        last[key] = max(last.get(key, (-1, -1, None)), (page if page is not None else -1, i, page))
    out = []
    for i, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        own = len(body) < least or last[body][1] == i
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if own else "revisit", None if own else last[body][2]))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def got(frame):
    return sorted(map(tuple, frame.select(*COLUMNS).collect()), key=repr)


ODD = [(1, "http://a/", "x"), (2, "http://b c/\r\nWARC-Type: request", "x"), (3, None, None), (4, "u", ""), (5, "é", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
       (6, "v", "long " * 60_000), (7, "v", "x"), (9, "w", "\r\n\r\n"), (10, "w", "\n"), (-4, "w", "\n"), (None, None, "z"), (12, "q", "z")]


def test_odd_pages(spark):
    pages = spark.createDataFrame([(*r, "a", 1) for r in ODD], PAGES + ", payload string, row int").coalesce(1)
    assert got(w.round_trip(pages)) == plain(ODD)
    assert got(w.round_trip(pages, least=2)) == plain(ODD, least=2)
    assert w.round_trip(pages.limit(0)).count() == 0


def test_repeated_pages_have_one_response(spark):
    pages = spark.createDataFrame([(1, "u", "x")] * 40 + [(2, "u", "y")] * 3 + [(None, None, None)] * 2, PAGES)
    found = got(w.round_trip(pages))
    assert [(r[0], r[3], r[4]) for r in found if r[3] == "response"] == [(1, "response", None), (2, "response", None), (None, "response", None)]
    assert sum(r[3] == "revisit" and r[4] == r[0] for r in found) == 39 + 2 + 1


def test_the_given_table_equals_its_sql(spark, sf_dir):
    assert compare(spark, duck(sf_dir), "op13", lambda s, d: w.round_trip(table(s, d, "pages")), w.ORACLE, sf_dir) is None


@pytest.mark.parametrize("codec", ["none", "gzip"])
def test_archives_are_valid_and_hold_few_records(spark, tmp_path, codec):
    """Read by hand: every record is closed by blank lines, its length holds, no file has more than its share."""
    pages = spark.createDataFrame(ODD, PAGES).coalesce(1)
    w.write_archives(pages, str(tmp_path / "a"), codec=codec, records=5)
    total = 0
    for file in (tmp_path / "a").glob("part-*"):
        data = file.read_bytes()
        stream = io.BytesIO(gzip.decompress(data) if codec == "gzip" else data)
        n = 0
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            head = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                head[name] = value
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Target-URI"} <= set(head)
            block = stream.read(int(head["Content-Length"]))
            if head["WARC-Type"] == "response":
                payload = block.split(b"\r\n\r\n", 1)[1]
                assert head["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert stream.read(4) == b"\r\n\r\n"
            n += 1
        assert n <= 5
        total += n
    assert total == 3 * len(ODD)


def record(kind, own, block, *lines):
    return "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"warc-record-id: {own}", *lines, f"Content-Length: {len(block.encode())}", "", block, "", ""])


def test_foreign_archives_are_assembled(spark, tmp_path):
    """Records that name each other in any direction, members compressed one by one, and lone ones."""
    http = "Content-Type: application/http;msgtype=response"
    records = [record("warcinfo", "<i>", "software: x"), record("response", "<r1>", "HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\n", http),
               record("request", "<q1>", "GET /1", "WARC-Concurrent-To:", " <r1>"), record("metadata", "<m1>", "page_id: 4\r\n", "WARC-Concurrent-To: <q1>"),
               record("response", "<r2>", "HTTP/1.1 200 OK\r\n\r\n", http, "WARC-Concurrent-To: <q2>", "WARC-Concurrent-To: <m2>"),
               record("request", "<q2>", "GET /2"), record("metadata", "<m2>", "via: y"), record("metadata", "<m3>", "alone"),
               record("request", "<q4>", "GET /4", "WARC-Concurrent-To: <gone>"), record("resource", "<r5>", "plain")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r.encode()) for r in records[:5]))
    (tmp_path / "b.warc").write_bytes("".join(records[5:]).encode())
    found = kept(w.read_archives(spark, str(tmp_path)), "records")
    captures = {r.id: r for r in w.assembled(found).collect()}
    assert set(captures) == {"<r1>", "<r2>", "<m3>", "<q4>", "<r5>"}
    first = captures["<r1>"]
    assert bytes(first.response.payload) == b"body\r\n\r\n" and first.response.head == "HTTP/1.1 200 OK\r\nA: b"
    assert [q.id for q in first.requests] == ["<q1>"] and [m.told for m in first.metadata] == ["page_id: 4\r\n"]
    assert [q.id for q in captures["<r2>"].requests] == ["<q2>"] and [m.id for m in captures["<r2>"].metadata] == ["<m2>"]
    assert captures["<m3>"].response is None and captures["<q4>"].response is None and bytes(captures["<r5>"].response.payload) == b"plain"
    assert [(r.page_id, r.record_type) for r in w.pages_of(w.assembled(found)).orderBy("page_id").collect()][-1] == (4, "response")


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        list(w.parsed(b"no archive at all\r\n\r\n"))
