"""WARC archives of pages: written, read back and assembled to one nested row per capture.

A capture is a transaction of three records: the request, the response (or a revisit, where
another capture already holds an equal payload) and metadata. Request and metadata name the
response in WARC-Concurrent-To. Archives are written by Spark's text writer, one record per
row with the blank lines that end a record as separator, so they lie wherever Spark can
write and only finished tasks leave files. They are read as whole files of bounded size and
parsed by the lengths that records tell, record by record. Records of a transaction are then
joined through their concurrent-to identifiers, in either direction and over a record in
between, and revisits through the identifier of the response they refer to.

Equal payloads are told by SHA-256. The largest page_id among them is the response; counts
per payload are reduced before they are joined to the pages, and a payload that very many
pages share is split by adaptive execution.

Defined results: a null html is an empty payload; a null url leaves the target a name made
of the record's identifier; pages with an equal id and payload are captures of their own, of
which the last row is the response; a null page_id is below all others and stays null. Rows
are numbered by their place in the scan, so the input should be a table. Request or metadata
records that reach no response make a row without one. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import column, kept, shared_folder

#: Records in an archive, which bounds what a reader holds.
ARCHIVE_RECORDS = 6_000

#: Bytes of records that a reader passes on at once.
BATCH_BYTES = 4 << 20

#: Line ends, types and the profile that the format prescribes.
END = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HOLDERS = ("response", "revisit", "resource")


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: 15 hexadecimal digits make 12 of its letters."""
    told = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(told, at, size), 16, 32), size * 4 // 5, "0") for at, size in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _id(kind: str, row: Column) -> Column:
    """A record's identifier, the same whenever a lost task is done again."""
    told = F.sha2(F.concat_ws("|", F.lit(kind), row), 256)
    part = [F.substring(told, at, size) for at, size in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), part[0], F.lit("-"), part[1], F.lit("-8"), part[2], F.lit("-8"), part[3], F.lit("-"), part[4], F.lit(">"))


def _record(kind: Column | str, own: Column, date: str, content: str, block: Column, **more: Column) -> Column:
    """A record's text; header lines whose value is null are left out."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(END, F.lit(VERSION), line("WARC-Type", kind), line("WARC-Record-ID", own), line("WARC-Date", F.lit(date)),
                       *(line("WARC-" + n.replace("_", "-"), v) for n, v in more.items()),
                       line("Content-Type", F.lit(content)), line("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(END + END), block)


def captures_to_write(pages: DataFrame, least: int = 0) -> DataFrame:
    """row, page_id, url, payload, digest, is_response and the row it refers to.

    Payloads of fewer than ``least`` bytes are always responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("same"))
    last = rows.groupBy("same").agg(F.max(F.struct("page_id", "row")).alias("last"))
    own = (F.col("last.row") == F.col("row")) | (F.octet_length("payload") < least)
    return rows.join(last, "same").select("row", "page_id", "url", "payload", base32_sha1(F.col("payload").cast("binary")).alias("digest"),
                                          own.alias("is_response"), F.col("last.row").alias("refers_to"))


def records_of(captures: DataFrame, date: str) -> DataFrame:
    """value: the three records of every capture, each as a row."""
    row = F.col("row").cast("string")
    holder = _id("response", row)
    uri = F.col("url")
    for sign, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        uri = F.replace(uri, F.lit(sign), F.lit(code))
    uri = F.coalesce(uri, F.substring(holder, 2, 45))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(END + END))
    response = F.col("is_response")
    held = _record(
        F.when(response, "response").otherwise("revisit"), holder, date, "application/http; msgtype=response",
        F.concat(head, F.when(response, F.col("payload")).otherwise("")),
        Target_URI=uri, Payload_Digest=F.concat(F.lit("sha1:"), F.col("digest")),
        Profile=F.when(~response, REVISIT_PROFILE), Refers_To=F.when(~response, _id("response", F.col("refers_to").cast("string"))))
    asked = F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{END}Accept: text/html{END}{END}"))
    request = _record("request", _id("request", row), date, "application/http; msgtype=request", asked, Target_URI=uri, Concurrent_To=holder)
    told = F.concat_ws("", F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(END)))
    metadata = _record("metadata", _id("metadata", row), date, "application/warc-fields", told, Target_URI=uri, Concurrent_To=holder)
    return captures.select(F.explode(F.array(request, held, metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = 0, codec: str = "gzip",
                   records: int = ARCHIVE_RECORDS) -> None:
    """Writes every page as a capture of three records, into archives of at most so many records."""
    (records_of(captures_to_write(pages, least), date).write.option("lineSep", END + END).option("compression", codec)
     .option("maxRecordsPerFile", records).text(path))


# -- reading -------------------------------------------------------------------

def parsed(content: bytes) -> Iterator[dict]:
    """The records of an archive, plain or compressed, as a whole or record by record.

    A record's end follows from the length that it tells, so payloads may hold anything.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and fields:
                fields[-1] = fields[-1][0], f"{fields[-1][1]} {line.decode('utf-8', 'replace').strip()}".strip()
            else:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields.append((name.strip().lower(), value.strip()))
        one = dict(reversed(fields))
        block = stream.read(int(one.get("content-length", 0)))
        head, payload = b"", block
        if one.get("content-type", "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
        yield {"type": one.get("warc-type"), "id": one.get("warc-record-id"), "date": one.get("warc-date"), "uri": one.get("warc-target-uri"),
               "concurrent_to": [v for n, v in fields if n == "warc-concurrent-to"], "refers_to": one.get("warc-refers-to"),
               "told_digest": one.get("warc-payload-digest"), "head": head.decode("utf-8", "replace"), "payload": payload}


_FIELDS = pa.schema([(n, pa.string()) for n in ("type", "id", "date", "uri")] + [("concurrent_to", pa.list_(pa.string()))]
                    + [(n, pa.string()) for n in ("refers_to", "told_digest", "head")] + [("payload", pa.binary())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record: type, id, date, uri, concurrent_to, refers_to, told_digest, head (of HTTP),
    payload, payload_bytes and payload_digest, the last two of the payload that was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in column(batch, "content"):
                found, size = [], 0
                for record in parsed(content.as_py()):
                    found.append(record)
                    size += 500 + len(record["payload"])
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(found, schema=_FIELDS)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema=_FIELDS)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    records = files.mapInArrow(run, "type string, id string, date string, uri string, concurrent_to array<string>, refers_to string, "
                                    "told_digest string, head string, payload binary")
    return records.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})


def holders_of(records: DataFrame, hops: int = 2) -> DataFrame:
    """id and holder, the response, revisit or resource that a record's concurrent-to
    identifiers lead to, whichever of two records names the other. Longer ways than
    ``hops`` records are not followed; of several holders the smallest identifier counts."""
    named = records.select("id", F.explode("concurrent_to").alias("other"))
    links = named.unionByName(named.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    holders = records.where(F.col("type").isin(*HOLDERS)).select("id", F.col("id").alias("holder"))
    reached = holders
    for hop in range(hops):
        near = links.join(reached.select(F.col("id").alias("other"), "holder"), "other").groupBy("id").agg(F.min("holder").alias("holder"))
        fresh = near.join(reached.select("id"), "id", "left_anti")
        reached = kept(reached.unionByName(fresh), f"holders-{hop}")
    return reached


def assembled(records: DataFrame, hops: int = 2) -> DataFrame:
    """One nested row per capture: id, response (with its payload), requests, metadata.

    records: as ``read_archives`` gives them, as a table, since it is read several times.
    """
    reached = holders_of(records, hops)
    small = records.where(F.col("type").isin("request", "metadata")).select("id", "type", "uri", "head", F.col("payload").cast("string").alias("told"))
    part = F.struct("id", "uri", F.when(F.col("type") == "request", F.col("head")).otherwise(F.col("told")).alias("told"))
    of_kind = [F.sort_array(F.collect_list(F.when(F.col("type") == kind, part))).alias(name)
               for kind, name in (("request", "requests"), ("metadata", "metadata"))]
    parts = small.join(reached, "id", "left").groupBy(F.coalesce("holder", "id").alias("id")).agg(*of_kind)
    response = F.struct("type", "id", "date", "uri", "refers_to", "told_digest", "head", "payload", "payload_bytes", "payload_digest")
    held = records.where(F.col("type").isin(*HOLDERS)).select("id", response.alias("response"))
    return held.join(parts, "id", "full_outer")


def pages_of(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every capture with
    a response; a revisit's payload is that of the response it refers to."""
    told = F.regexp_extract(F.get("metadata", F.lit(0))["told"], r"(?m)^page_id: (-?[0-9]+)\r?$", 1)
    own = captures.where("response is not null").select(
        F.when(told != "", told).cast("long").alias("page_id"), F.col("response.type").alias("record_type"), F.col("response.id").alias("id"),
        F.col("response.refers_to").alias("source"), "response.payload_bytes", "response.payload_digest")
    own = kept(own, "captures")
    sources = own.where("record_type <> 'revisit'").select(
        F.col("id").alias("source"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"))
    again = own.where("record_type = 'revisit'").join(sources, "source", "left").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"), "record_type", "refers_to")
    first = own.where("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return first.unionByName(again)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages written as archives in the shared folder, read back and assembled."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark, 'warc')}/archives"
    write_archives(pages, path, least=least)
    return pages_of(assembled(kept(read_archives(spark, path), "records")))


_BASE32 = """list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
  ((('0x' || substr(sha1(body) || '0', 1 + (i * 5) // 4, 2))::BIGINT >> (3 - (i * 5) % 4)) & 31)::BIGINT, 1)), 'string_agg', '')"""

#: The same as SQL.
ORACLE = f"""WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
placed AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS place, max(page_id) OVER (PARTITION BY body) AS last FROM page)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
 CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN last END AS refers_to FROM placed"""
