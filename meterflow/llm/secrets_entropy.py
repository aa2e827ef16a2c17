"""Secret scan: fixed patterns, and sliding-window entropy of candidate strings.

Candidates are runs of characters that keys are made of. A window slides over each; its
characters' counts change by one in and one out, which updates the Shannon entropy without
counting again. Every character class has its own window and threshold, and strings that
an allow-list knows whole (dates, versions, plain words) are let go, as are the parts between
separators that are placeholders or alphabets; what stands beside such a part is scanned.

Defined results: null is as empty text, without findings; repeated rows are scanned one by
one; spans are in code points, end exclusive, ordered by start, then kind. Extra columns
are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterflow.llm.common import bytes_of, column, pieces

KINDS = ("assign", "access", "hex", "entropy")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")
#: The base patterns. Bytes outside ASCII match none of their classes.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

#: Character class: window, bits of entropy that a window must reach. For a candidate shorter
#: than the window, it is as long as that, and the bits are less in proportion to the most possible.
CLASSES = {"hex": (16, 2.9), "letters and digits": (20, 3.7), "base64": (24, 3.9)}
CANDIDATE_LEAST = 20
#: Parts between separators that are never secrets by entropy alone.
PLACEHOLDERS = (
    rb"(?i)[a-z0-9]*(example|placeholder|changeme|dummy|sample|xxxx|0000000|1234567)[a-z0-9]*",
    rb"(?i)[a-z0-9]*(abcdefgh|ghijklmn|qwertyui)[a-z0-9]*",
)
#: Strings that are never secrets by entropy alone: a date may go on with numbers and words.
ALLOWED = (
    *PLACEHOLDERS,
    rb"(19|20)[0-9]{2}-?(0[1-9]|1[0-2])-?(0[1-9]|[12][0-9]|3[01])"
    rb"(?:[T_/+=-]*+(?:[0-9]++|Z)|[-_/+=]++[A-Za-z]++[0-9]{0,4}+)*+[-_/+=]*+",
    rb"v?[0-9]+([._-][0-9a-z]{1,6})+",
    rb"([A-Za-z]+[-_/+=]+)*[A-Za-z]+[0-9]{0,4}", rb"[0-9+/_=-]+",
    rb"[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
)

_HEX = np.zeros(256, dtype=bool)
_HEX[np.frombuffer(b"0123456789abcdef", dtype=np.uint8)] = True
_RUN = np.zeros(256, dtype=bool)
_RUN[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", dtype=np.uint8)] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True


def runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least so many true bytes; none crosses a text's start."""
    if not len(inside):
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    edge = np.zeros(len(inside), dtype=bool)
    edge[offsets[:-1][offsets[:-1] < len(inside)]] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge))
    after = np.concatenate((inside[1:], [False]))
    next_edge = np.concatenate((edge[1:], [True]))
    ends = np.flatnonzero(inside & (~after | next_edge)) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def window_entropies(text: bytes, width: int) -> list[float]:
    """Bits of entropy of every window of so many characters, by counts kept up to date."""
    if len(text) < width:
        return []
    weigh = [0.0] + [k * math.log2(k) for k in range(1, width + 1)]
    counts, total, full = [0] * 256, 0.0, math.log2(width)
    out = []
    for i, c in enumerate(text):
        if i >= width:
            gone = text[i - width]
            k = counts[gone]
            counts[gone] = k - 1
            total += weigh[k - 1] - weigh[k]
        k = counts[c]
        counts[c] = k + 1
        total += weigh[k + 1] - weigh[k]
        if i >= width - 1:
            out.append(full - total / width)
    return out


def class_spans(text: bytes) -> list[tuple[int, int]]:
    """Parts of a string whose windows reach the threshold of its class."""
    if re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", text):
        name = "hex"
    elif text.isalnum():
        name = "letters and digits"
    else:
        name = "base64"
    if name == "base64" and sum(bool(re.search(c, text)) for c in (rb"[a-z]", rb"[A-Z]", rb"[0-9]")) < 3:
        return []
    window, least = CLASSES[name]
    width = min(window, len(text))
    least *= math.log2(width) / math.log2(window)
    found: list[list[int]] = []
    for i, bits in enumerate(window_entropies(text, width)):
        if bits >= least:
            if found and i <= found[-1][1]:
                found[-1][1] = i + width
            else:
                found.append([i, i + width])
    return [(a, b) for a, b in found if any(48 <= c <= 57 for c in text[a:b])]


def entropy_spans(text: bytes, allowed: list[re.Pattern]) -> list[tuple[int, int]]:
    """Parts of a candidate string whose windows reach their class's threshold.

    Placeholders among its parts are cut out; what is left between them is scanned whole,
    and long parts also each by their own class.
    """
    if any(a.fullmatch(text) for a in allowed):
        return []
    known = [a for a in allowed if a.pattern in PLACEHOLDERS]
    parts = [m.span() for m in re.finditer(rb"[A-Za-z0-9]+", text)]
    gone = [(a, b) for a, b in parts if any(p.fullmatch(text, a, b) for p in known)]
    between = list(zip([0, *[b for _, b in gone]], [*[a for a, _ in gone], len(text)], strict=True))
    found: list[list[int]] = []
    spans = [(x, y) for x, y in {*between, *parts} - set(gone) if y - x >= CANDIDATE_LEAST]
    spans = sorted((x + a, x + b) for x, y in spans if not any(p.fullmatch(text, x, y) for p in allowed) for a, b in class_spans(text[x:y]))
    for a, b in spans:
        if any(p.fullmatch(text, a, b) for p in allowed):
            continue
        if found and a <= found[-1][1]:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


def scan(flat: np.ndarray, offsets: np.ndarray, allowed: tuple[bytes, ...] = ALLOWED) -> dict[int, list[tuple[int, int, int]]]:
    """Findings (start, kind, end) of each text that has any; kind is a place in KINDS."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    data = flat.tobytes()

    def owner(at: int) -> int:
        return int(np.searchsorted(offsets, at, side="right")) - 1

    def texts_with(part: bytes, where: bytes) -> set[int]:
        out, at = set(), where.find(part)
        while at >= 0:
            k = owner(at)
            out.add(k)
            at = where.find(part, offsets[k + 1])
        return out

    lower = data.lower()
    for k in sorted(set().union(*(texts_with(w, lower) for w in _KEYWORDS))):
        for m in _ASSIGN.finditer(data[offsets[k]:offsets[k + 1]]):
            if len(m[2]) >= ASSIGN_LEAST:
                found.setdefault(k, []).append((m.start(), 0, m.end()))
    for k in sorted(texts_with(b"AKIA", data)):
        for m in _ACCESS.finditer(data[offsets[k]:offsets[k + 1]]):
            if len(m[0]) >= ACCESS_LEAST:
                found.setdefault(k, []).append((m.start(), 1, m.end()))
    for a, b in zip(*runs(_HEX[flat], offsets, HEX_LEAST), strict=True):
        k = owner(a)
        found.setdefault(k, []).append((int(a - offsets[k]), 2, int(b - offsets[k])))
    patterns = [re.compile(a) for a in allowed]
    starts, ends = runs(_RUN[flat], offsets, CANDIDATE_LEAST)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[flat])))
    for a, b in zip(starts, ends, strict=True):
        if digits[b] == digits[a]:
            continue
        k = owner(a)
        for s, e in entropy_spans(data[a:b], patterns):
            s, e = int(a - offsets[k] + s), int(a - offsets[k] + e)
            if not any(x <= s and e <= y for x, kind, y in found.get(k, []) if kind < 3):
                found.setdefault(k, []).append((s, 3, e))
    for k, spans in found.items():
        text = flat[offsets[k]:offsets[k + 1]]
        if len(text) and text.max() >= 128:
            letters = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))
            spans[:] = [(int(letters[s]), kind, int(letters[e])) for s, kind, e in spans]
        spans.sort()
    return found


def find(docs: DataFrame, allowed: tuple[bytes, ...] = ALLOWED) -> DataFrame:
    """doc_id, counts of base findings, digest of them and all spans, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            found = scan(*bytes_of(column(part, "text")), allowed)
            rows = [found.get(k, []) for k in range(part.num_rows)]
            counts = [pa.array([sum(x[1] == kind for x in spans) for spans in rows], type=pa.int64()) for kind in range(3)]
            told = [[f"{KINDS[kind]}:{s}:{e}" for s, kind, e in spans] for spans in rows]
            base = [",".join(t for t, x in zip(text, spans, strict=True) if x[1] < 3) for text, spans in zip(told, rows, strict=True)]
            yield pa.record_batch(
                [column(part, "doc_id"), *counts, pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], type=pa.string()),
                 pa.array([",".join(t) for t in told], type=pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[secret]", allowed: tuple[bytes, ...] = ALLOWED) -> DataFrame:
    """The documents with every finding replaced by a mark; n_chars follows, where it is.

    Findings that overlap are replaced as one. No document goes, and all columns stay.
    """
    names = docs.columns

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for s, _, e in spans:
            if s >= at:
                out += [text[at:s], mark]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            texts = column(part, "text")
            found = scan(*bytes_of(texts), allowed)
            columns = list(part.columns)
            if found:
                new = texts.to_pylist()
                for k, spans in found.items():
                    new[k] = clean(new[k], spans)
                columns[names.index("text")] = pa.array(new, type=texts.type)
                if "n_chars" in names:
                    at = names.index("n_chars")
                    sizes = columns[at].to_pylist()
                    for k in found:
                        sizes[k] = len(new[k]) if sizes[k] is not None else None
                    columns[at] = pa.array(sizes, type=columns[at].type)
            yield pa.record_batch(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
