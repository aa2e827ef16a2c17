"""Alignment of two tokenizers' tokens over the same bytes.

Both encode a text, tokens get their byte intervals, and the intervals of both sides are
coalesced: sorted by start, with the running maximum of their ends, a group ends where the
next start reaches that maximum. Inside a group every A token is expanded to the B tokens
that its interval overlaps; pairs that end together are the links. A link's weight is how
often its pair of ids is linked in all documents.

No token of either vocabulary goes on behind a space that follows something else, so texts
are cut there, and each distinct part is encoded and aligned once in a worker.

Which pairs can end together is settled by the vocabularies: one token's bytes end the
other's. A token of n bytes has at most n such partners that are not longer, so the table of
pair counts has at most as many rows as both vocabularies have bytes (some 500,000), whatever
the corpus; only that table is broadcast.

Defined results: a text that is null or empty, or that either side does not give back byte
for byte, has no tokens: all numbers are 0 and the groups are an empty text. Repeated rows
and ids, and rows without an id, are aligned one by one. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.bpe_prefix import byte_letters
from meterflow.llm.common import column, kept, pieces

#: Distinct parts that each of a worker's two generations remembers, and their longest.
REMEMBERED, LONGEST = 250_000, 64

#: Bytes of new parts that are encoded in one call.
CALL_BYTES = 1 << 15

#: Bytes of text whose parts are made distinct at once.
PIECE = 4 << 20

#: The letter that a piece vocabulary writes for a space.
SPACE = "▁"

_UNEVEN = re.compile(r"^ |\s ").search
_CUT = re.compile(r"(?<=\S)(?= )").split


def coalesced(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and of each B token, counted from 0 in order of position."""
    start, end = np.concatenate((a_start, b_start)), np.concatenate((a_end, b_end))
    side = np.repeat(np.array([0, 1], dtype=np.int8), (len(a_start), len(b_start)))
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    group = np.zeros(len(order), dtype=np.int64)
    np.cumsum(start[order][1:] >= reach[:-1], out=group[1:])
    of = np.empty_like(group)
    of[order] = group
    return of[:len(a_start)], of[len(a_start):]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all A and B tokens whose intervals share a byte; each side lies end to end."""
    first = np.searchsorted(b_end, a_start, side="right")
    count = np.searchsorted(b_start, a_end, side="left") - first
    a = np.repeat(np.arange(len(a_start)), count)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + first[a]


class Aligner:
    """Both tokenizers, the bytes of their tokens and the parts aligned lately."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a_bytes, self.b_bytes = _bytes_a(self.a), _bytes_b(self.b)
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = np.array([s + str(i) for s in ("", ",", "|", ";") for i in range(most)], dtype=object)
        self.most, self.lone = most, self.b.piece_to_id(SPACE)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for a text that begins with a space; None where bytes get lost."""
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:], num_threads=1) if len(text) > 1 else [self.lone]
        data = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def aligned(self, units: list[str]) -> list[tuple | None]:
        """For parts that stand in a row: numbers of A and B tokens and groups, the groups
        as text, and the linked pairs as whole numbers in bytes."""
        found = self.ids("".join([" " + u for u in units]))
        if found is None:
            return [None] if len(units) == 1 else list(chain.from_iterable(self.aligned([u]) for u in units))
        a, b = found
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        a_group, b_group = coalesced(a_start, a_end, b_start, b_end)
        groups = int(a_group[-1]) + 1
        over_a, over_b = overlaps(a_start, a_end, b_start, b_end)
        together = a_end[over_a] == b_end[over_b]
        over_a, over_b = over_a[together], over_b[together]
        pairs = (a[over_a] * len(self.b_bytes) + b[over_b]).astype("<i8").tobytes()

        ends = np.cumsum([1 + len(u.encode()) for u in units])
        a_cut, b_cut = np.searchsorted(a_end, ends, "right").tolist(), np.searchsorted(b_end, ends, "right").tolist()
        g_end = np.zeros(groups, dtype=np.int64)
        g_end[a_group] = a_end
        g_cut = np.searchsorted(g_end, ends, "right").tolist()
        l_cut = np.searchsorted(a_end[over_a], ends, "right").tolist()

        side = np.repeat(np.array([0, 1]), (len(a), len(b)))
        group, token = np.concatenate((a_group, b_group)), np.concatenate((a, b))
        order = np.lexsort((np.arange(len(side)), side, group))
        side, group, token = side[order], group[order], token[order]
        mark = np.ones(len(side), dtype=np.int64)
        mark[1:][(side[1:] == 1) & (side[:-1] == 0)] = 2
        mark[1:][group[1:] != group[:-1]] = 3
        mark[[0, *[i + j for i, j in zip(a_cut[:-1], b_cut[:-1], strict=True)]]] = 0
        shown = self.shown[mark * self.most + token].tolist()
        out, i, j, g, k = [], 0, 0, 0, 0
        for i2, j2, g2, k2 in zip(a_cut, b_cut, g_cut, l_cut, strict=True):
            out.append((i2 - i, j2 - j, g2 - g, "".join(shown[i + j:i2 + j2]), pairs[8 * k:8 * k2]))
            i, j, g, k = i2, j2, g2, k2
        return out

    def look_up(self, units: list[str]) -> list[tuple | None]:
        """The alignment of distinct parts; what neither generation knows is aligned now."""
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        young, old, here = self.young, self.old, {}
        new, size = [], 0

        def learn():
            for u, v in zip(new, self.aligned(new), strict=True):
                here[u] = v
                if len(u) <= LONGEST:
                    young[u] = v

        for u in units:
            if u in young:
                continue
            if u in old:
                young[u] = old[u]
            elif u and not u[-1].isspace():
                new.append(u)
                size += len(u)
                if size >= CALL_BYTES:
                    learn()
                    new, size = [], 0
            else:
                here[u] = self.aligned([u])[0]
        if new:
            learn()
        return [here[u] if u in here else young[u] for u in units]

    def texts(self, texts: list[str | None]) -> tuple[list, list, list, list, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and groups of each text, and its distinct pairs with how often they are linked."""
        cut = []
        for t in texts:
            if not t or SPACE in t:
                cut.append([])
            elif _UNEVEN(t):
                cut.append([u[1:] for u in _CUT(" " + t)])
            else:
                cut.append(t.split(" "))
        sizes = np.array([len(c) for c in cut], dtype=np.int64)
        place = {u: i for i, u in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
        found = self.look_up(list(place))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(sizes.sum()))
        none = (0, 0, 0, "", b"")
        bad = np.array([f is None for f in found], dtype=bool)
        found = [f or none for f in found]
        numbers = np.array([f[:3] for f in found], dtype=np.int64).reshape(-1, 3)
        shown = np.array([f[3] for f in found], dtype=object)
        pool = np.frombuffer(b"".join([f[4] for f in found]), dtype="<i8")
        count = np.array([len(f[4]) // 8 for f in found], dtype=np.int64)
        first = np.cumsum(count) - count

        n_a, n_b, n_groups, groups, pairs, times, lengths = [], [], [], [], [], [], []
        end = np.cumsum(sizes)
        for i, j in zip((end - sizes).tolist(), end.tolist(), strict=True):
            own = at[i:j]
            if not len(own) or bad[own].any():
                own = own[:0]
            a, b, g = numbers[own].sum(axis=0).tolist()
            n_a.append(a)
            n_b.append(b)
            n_groups.append(g)
            groups.append(";".join(shown[own].tolist()))
            c = count[own]
            where = np.arange(int(c.sum())) + np.repeat(first[own] - (np.cumsum(c) - c), c)
            p, t = np.unique(pool[where], return_counts=True)
            pairs.append(p)
            times.append(t)
            lengths.append(len(p))
        empty = [np.zeros(0, dtype=np.int64)]
        return n_a, n_b, n_groups, groups, np.concatenate(pairs or empty), np.concatenate(times or empty), np.array(lengths, dtype=np.int64)


def _bytes_a(tokenizer) -> list[bytes]:
    byte_of = {c: b for b, c in byte_letters().items()}
    vocabulary = tokenizer.get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return out


def _bytes_b(model) -> list[bytes]:
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
    return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The tokenizers, loaded once in a worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2`` in order of position), and
    the text's distinct linked pairs, a * |B| + b, with how often each is linked in it.

    ``row`` tells rows apart whose ids are equal or null; it holds for this frame's one run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for part in pieces(batches, "text", PIECE):
            n_a, n_b, n_groups, groups, pairs, times, lengths = both.texts(column(part, "text").to_pylist())
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), type=pa.int32())
            yield pa.record_batch(
                [column(part, "row"), column(part, "doc_id"), pa.array(n_a, type=pa.int64()), pa.array(n_b, type=pa.int64()),
                 pa.array(n_groups, type=pa.int64()), pa.array(groups, type=pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs, type=pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, type=pa.int32()))],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, "
                                "pairs array<long>, times array<int>")


def pair_counts(links: DataFrame, b_tokens: int) -> DataFrame:
    """pair, n (how often it is linked) and whether no other A token is linked with its B
    token more often. links: pair, times."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("n"))
    highest = counts.groupBy((F.col("pair") % b_tokens).alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", F.col("pair") % b_tokens).join(highest, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    b_tokens = sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()
    found = align(docs, path_a, path_b)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups"), 256)).otherwise("")
    found = kept(found.select("row", "doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "pairs", "times"), "alignments")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").cast("long").alias("times"))
    counts = kept(pair_counts(links.select("pair", "times"), b_tokens), "pair-counts")
    # the module's docstring says why this table's size has a bound
    sums = links.join(F.broadcast(counts), "pair").groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    told = found.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "row", "left")
    number = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return told.select("doc_id", "n_a", "n_b", "n_groups", *number, "groups_sha256")
