"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pretoken there is exactly one token that can end its encoding. It is
found among the vocabulary's tokens that are suffixes of the prefix, which an automaton
yields while it reads the pretoken once; a candidate is right if it may stand next to the
last token of the prefix before it, that is if merging the pair's text again gives the
pair. Back-pointers then give the exact ids, without replaying merges.

Texts are cut into pretokens first; encodings of those seen before are looked up, in two
generations: a full young one becomes the old one, and what is met in the old one moves up.
Defined results: null is as empty text, with no ids; repeated rows are encoded one by one;
a special token's string in a text becomes its id. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from meterflow.llm.common import column, pieces

#: Fixed value: the pattern that cuts texts before byte-level merges.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Encodings that each generation of a worker's stores remembers: of words with a space
#: before them, and of all other parts.
REMEMBERED = 250_000

#: Letters of a part or pretoken that is remembered, at most.
LONGEST = 64

#: White space next to a space, at an end, or other than single line breaks between words.
_UNEVEN = re.compile(r"^\s|\s$|\s\s")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Lately(dict):
    """Values worked out when they are first asked for; long keys are not kept."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, key: str) -> str:
        value = self.learn(key)
        if len(key) <= LONGEST:
            self[key] = value
        return value


class Vocabulary:
    """Tokens, merges and pair tests of a byte-level vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        byte_of = {c: b for b, c in byte_letters().items()}
        ids = file["model"]["vocab"]
        text = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.text = text | {i: t.encode() for t, i in self.special.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        for rank, m in enumerate(file["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            whole, pair = ids[left + right], (ids[left], ids[right])
            self.merged[pair] = rank
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = pair, rank
        self.automaton = ahocorasick.Automaton()
        for i, t in text.items():
            if len(t) == 1 or i in self.parts:
                self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()
        self.cut = regex.compile(PRETOKENS).findall
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fits: dict[int, bool] = {}
        self.most = REMEMBERED
        self.old: dict[str, str] = {}
        self.old_other: dict[str, str] = {}
        self.spaced, self.other = Lately(self._spaced), Lately(self._other)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the text of both tokens together is encoded as just this pair.

        Merges are undone from the latest on, on the side that was made last; a pair at
        the seam that would have merged before that moment breaks the two tokens up.
        """
        rank, parts, merged = self.rank, self.parts, self.merged
        limit = len(merged)
        while True:
            seam = merged.get((left, right))
            if seam is not None and seam < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, parts[left][1]
            else:
                limit, right = b + 1, parts[right][0]

    def last_tokens(self, word: bytes) -> list[int]:
        """The ids of a pretoken, by one pass over its prefixes."""
        n = len(word)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        fits, compatible = self.fits, self.compatible
        last[0] = -2
        for end, (token, size) in self.automaton.iter(word.decode("latin-1")):
            here = end + 1
            if last[here] != -1:
                continue
            before = last[here - size]
            if before == -1:
                continue
            if before == -2:
                ok = True
            else:
                ok = fits.get(before << 32 | token)
                if ok is None:
                    ok = fits[before << 32 | token] = compatible(before, token)
            if ok:
                last[here], start[here] = token, here - size
        ids = []
        while n:
            if last[n] < 0:
                raise ValueError("a byte of the text is not in the vocabulary")
            ids.append(last[n])
            n = start[n]
        return ids[::-1]

    def _word(self, word: str) -> str:
        """Ids of a pretoken, which decode to its own bytes."""
        data = word.encode()
        ids = self.last_tokens(data)
        if b"".join(map(self.text.__getitem__, ids)) != data:
            raise ValueError(f"{word!r} is not what its tokens decode to")
        return ",".join(map(str, ids))

    def _spaced(self, word: str) -> str:
        """Ids of the pretokens of a word and the space before it."""
        found = self.old.get(word)
        if found is None:
            cut = self.cut(" " + word)
            found = self._word(cut[0]) if len(cut) == 1 else ",".join(map(self.other.__getitem__, cut))
        return found

    def _other(self, part: str) -> str:
        """Ids of pretokens without a space before them, or of a special token."""
        found = self.old_other.get(part)
        if found is None:
            cut = [part] if part in self.special else self.cut(part)
            if len(cut) > 1:
                found = ",".join(map(self.other.__getitem__, cut))
            else:
                found = str(self.special[part]) if part in self.special else self._word(part)
        return found

    def encode(self, text: str) -> tuple[str, bytes, int]:
        """Ids as decimal text joined by commas, bytes they decode to, number of ids.

        Parts that no pretoken crosses are looked up: words with the space before them, or
        pretokens where white space is uneven. What a part's ids decode to has been found
        equal to it, so the text's decoding is its parts in a row.
        """
        if len(self.spaced) >= self.most:
            self.old, self.spaced = self.spaced, Lately(self._spaced)
        if len(self.other) >= self.most:
            self.old_other, self.other = self.other, Lately(self._other)
        if len(self.fits) >= 1 << 20:
            self.fits.clear()
        found = []
        for k, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if k % 2:
                found.append(self.other[part])
            elif _UNEVEN.search(part):
                found += map(self.other.__getitem__, self.cut(part))
            elif part:
                first, *rest = part.split(" ")
                found.append(self.other[first])
                found += map(self.spaced.__getitem__, rest)
        ids = ",".join(found)
        return ids, text.encode(), ids.count(",") + 1 if ids else 0

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, loaded once in a worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and the text decoded from them, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for part in pieces(batches, "text"):
            found = [v.encode(t or "") for t in column(part, "text").to_pylist()]
            yield pa.record_batch(
                [column(part, "doc_id"), pa.array([list(map(int, f[0].split(","))) if f[2] else [] for f in found], type=pa.list_(pa.int32())),
                 pa.array([f[1].decode("utf-8", "replace") for f in found], type=pa.string())],
                names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and of the decoded text: ids leave no worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for part in pieces(batches, "text"):
            found = [v.encode(t or "") for t in column(part, "text").to_pylist()]
            yield pa.record_batch(
                [column(part, "doc_id"), pa.array([f[2] for f in found], type=pa.int64()),
                 pa.array([hashlib.sha256(f[0].encode()).hexdigest() for f in found], type=pa.string()),
                 pa.array([hashlib.sha256(f[1].decode("utf-8", "replace").encode()).hexdigest() for f in found], type=pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
