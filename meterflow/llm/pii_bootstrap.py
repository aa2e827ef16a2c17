"""Personal data: fixed patterns as seeds, and contexts that they teach.

Base findings are the seed entities. The words before an entity are a lexical pattern;
patterns and the identifiers they stand before make a graph. Spark scores it in turns: a
pattern is trusted by the share of its uses, in all texts that hold identifiers, that
stand before trusted instances; an instance by its patterns together. Identifiers that no base pattern knows, but
that trusted patterns introduce, become findings too (kind ``context_`` + the kind taught).

Defined results: null is as empty text, without findings; repeated rows are findings each
for itself, and one text's repeats of an identifier count once for a pattern; spans are in
code points, end exclusive, ordered by start, then kind. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import bytes_of, column, kept, pieces

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Bytes outside ASCII match none of their classes.
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
#: Identifiers that contexts may discover: words of this form with at least 5 digits.
_CANDIDATE = re.compile(rb"[A-Za-z0-9+(][A-Za-z0-9@()/._-]*[0-9][A-Za-z0-9@/_-]*")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
CANDIDATE_DIGITS = 5

_IS_LOCAL = np.zeros(256, dtype=bool)
_IS_LOCAL[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-", dtype=np.uint8)] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: from each @, back over the local part and on over the domain."""
    done, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > done and _IS_LOCAL[text[start - 1]]:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find(b"@", max(at + 1, done))


def base(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the findings of the fixed patterns, in bytes."""
    found = [(s, 0, e) for s, e in emails(text)] if b"@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in m[0].split(b".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(b" ", b"").replace(b"-", b"")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def contexts(text: bytes, start: int) -> list[bytes]:
    """Patterns of a place: the last one and two words before it, in lower case."""
    words = _WORD.findall(text[max(0, start - 80):start].lower())
    if start > 80 and words and text[start - 81:start - 80] not in (b" ", b"\n", b"\t"):
        words = words[1:]
    return [b" ".join(words[-k:]) for k in (1, 2) if len(words) >= k]


def mentions(text: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, bytes, int]]]:
    """Base findings, and for the graph (start, end, kind or -1, pattern, pattern's uses in the text)."""
    found = base(text)
    taken, places = list(found), [(s, e, kind) for s, kind, e in found]
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        if sum(48 <= c <= 57 for c in m[0]) >= CANDIDATE_DIGITS and not any(s < y and x < e for x, _, y in taken):
            places.append((s, e, -1))
    lower, uses, out = text.lower(), {}, []
    for s, e, kind in places:
        for pattern in contexts(text, s):
            if pattern not in uses:
                uses[pattern] = lower.count(pattern)
            out.append((s, e, kind, pattern, uses[pattern]))
    return found, out


_SCANNED = ("row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
            "base array<struct<s:long,k:int,e:long>>, "
            "places array<struct<s:long,e:long,k:int,pattern:binary,instance:binary,uses:long>>")


def scanned(docs: DataFrame) -> DataFrame:
    """A row per document with its base findings and its part of the graph; no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in pieces(batches, "text"):
            flat, offsets = bytes_of(column(part, "text"))
            data = flat.tobytes()
            digits = np.concatenate(([0], np.cumsum(_DIGIT[flat] | (flat == 64))))
            some = digits[offsets[1:]] > digits[offsets[:-1]]
            counts, shas, bases, graph = [], [], [], []
            for k in range(part.num_rows):
                found, places = mentions(data[offsets[k]:offsets[k + 1]]) if some[k] else ([], [])
                if found or places:
                    text = flat[offsets[k]:offsets[k + 1]]
                    at = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80))).tolist()
                    raw = data[offsets[k]:offsets[k + 1]]
                    places = [{"s": at[s], "e": at[e], "k": kind, "pattern": pattern, "instance": hashlib.md5(raw[s:e].lower()).digest()[:12], "uses": uses}
                              for s, e, kind, pattern, uses in places]
                    found = [(at[s], kind, at[e]) for s, kind, e in found]
                counts.append([sum(x[1] == kind for x in found) for kind in range(4)])
                shas.append(hashlib.sha256(",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in found).encode()).hexdigest())
                bases.append([{"s": s, "k": kind, "e": e} for s, kind, e in found])
                graph.append(places)
            yield pa.record_batch(
                [pa.array(range(row, row + part.num_rows), type=pa.int64()), column(part, "doc_id"),
                 *(pa.array([c[kind] for c in counts], type=pa.int64()) for kind in range(4)),
                 pa.array(shas, type=pa.string()), pa.array(bases, type=span_type), pa.array(graph, type=place_type)],
                names=["row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "places"])
            row += part.num_rows

    span_type = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]))
    place_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("k", pa.int32()), ("pattern", pa.binary()), ("instance", pa.binary()), ("uses", pa.int64())]))
    return docs.select("doc_id", "text").mapInArrow(run, _SCANNED)


def discovered(places: DataFrame, turns: int = 3, support: int = 3, trust: float = 0.5, accept: float = 0.5) -> DataFrame:
    """instance, k: the identifiers that trusted patterns introduce, with the kind taught.

    ``places`` has row, pattern, instance, k (-1 where unknown) and uses. A pattern needs
    ``support`` different instances and the share ``trust`` of its uses.
    """
    uses = places.groupBy("row", "pattern").agg(F.max("uses").alias("uses"))
    uses = uses.groupBy("pattern").agg(F.sum("uses").alias("uses"))
    edges = kept(places.groupBy("pattern", "instance").agg(F.max("k").alias("k"), F.countDistinct("row").alias("n")), "edges")
    uses = kept(uses, "uses")
    seeds = edges.where("k >= 0").groupBy("instance").agg(F.max("k").alias("k")).withColumn("s", F.lit(1.0))
    scored = seeds
    for turn in range(turns):
        by_kind = edges.drop("k").join(scored, "instance").groupBy("pattern", "k").agg(
            F.sum(F.col("s") * F.col("n")).alias("s"), F.count("*").alias("instances"))
        patterns = (
            by_kind.join(uses, "pattern").withColumn("p", F.col("s") / (F.col("uses") + 1))
            .where((F.col("instances") >= support) & (F.col("p") >= trust)).select("pattern", "k", "p"))
        hidden = edges.where("k < 0").select("pattern", "instance").join(patterns, "pattern")
        by_instance = hidden.groupBy("instance", "k").agg((1 - F.exp(F.sum(F.log1p(-F.least("p", F.lit(0.99)))))).alias("s"))
        best = by_instance.groupBy("instance").agg(F.max_by("k", F.struct("s", -F.col("k"))).alias("k"), F.max("s").alias("s"))
        scored = kept(seeds.unionByName(best.join(seeds.select("instance"), "instance", "left_anti")), f"scores-{turn}")
    return scored.join(seeds.select("instance"), "instance", "left_anti").where(F.col("s") >= accept).select("instance", "k")


def find(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, counts and digest of base findings, and all spans, of every document."""
    rows = kept(scanned(docs), "scanned")
    places = rows.select("row", F.explode("places").alias("p")).select("row", "p.*")
    new = discovered(places, **settings)
    hidden = places.where("k < 0").drop("k", "pattern", "uses").distinct()
    added = hidden.join(new, "instance").groupBy("row").agg(
        F.collect_list(F.struct("s", (F.col("k") + len(KINDS)).alias("k"), "e")).alias("more"))
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"context_{k}") for k in KINDS])
    every = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<s:long,k:int,e:long>>"))))
    told = F.transform(every, lambda x: F.concat_ws(":", F.get(names, x.k), x.s.cast("string"), x.e.cast("string")))
    return rows.drop("places").join(added, "row", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(told, ",").alias("spans"))
