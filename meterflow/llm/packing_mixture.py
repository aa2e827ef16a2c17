"""Packing of documents into training sequences by deficit round-robin over sources.

Each source is a queue of tokens. In a round every queue adds its quantum to its deficit,
serves the whole tokens in it and carries the rest to the next round. The tokens served
stand one behind another, and every 2048 of them are a sequence, so each sequence holds
the target proportions to within a few tokens, and only the last one is padded. With very
many sources that cuts documents into single tokens. ``run`` then makes a round as many
sequences as a source of mean share needs to serve that many tokens at once: with 64, one
sequence for up to 32 sources, and more for more. Proportions then hold over a round.

What a queue has served after r rounds is floor(carry + r * quantum), whatever happened
in other queues or tasks. So the deficit that a partition's first document meets is known
from its queue's token offset alone, and placing documents takes no shuffle of tokens:
tokens are written once, offsets come from sums per (part, queue), and each document's
pieces are worked out where its tokens are.

Sources beyond QUEUES share one queue of the rounds, in which a balanced tree of them deals
out the places: a node's tokens are shared by its two halves in proportion to their totals,
so a source's places follow from the totals beside its path, which are joined to it. With
weights, shared sources serve a token a turn while they last, and the queue's quantum is as
many tokens as sources are left.

Defined results: null texts hold the end token only; null is a source of its own; repeated
rows are packed each for itself; an empty table gives no sequences. Extra columns are
ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import bytes_of, column, kept, pieces

LENGTH, END = 2048, 1
#: Tokens that a source of mean share serves at once where ``run`` asks for it.
RUN = 64
#: Sources with most rows whose totals the driver holds; all others are dealt inside one queue more.
QUEUES = 255
#: Rows of (part, queue) offsets, about 40 bytes each, up to which they are broadcast.
BROADCAST_ROWS = 500_000
#: Bytes of text whose words are made distinct at once.
PIECE = 4 << 20
#: Words, and pretokens, that each of a worker's two generations remembers.
REMEMBERED = 350_000

#: Fixed value: how the word vocabulary cuts text, here for lower-case ASCII and Latin-1
#: letters, which no normalisation changes further. Other words go to the library whole.
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall
_BYTES = np.arange(256)
_FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8).tobytes()
_IN_WORD = ((_BYTES >= 97) & (_BYTES <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57))
_MARK, _BLANK = np.isin(_BYTES, list(b".,;:!?")), np.isin(_BYTES, (9, 10, 11, 12, 13, 32))


def loosened(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Texts in lower-case ASCII with a blank before marks that end a word: such a mark is
    a pretoken of its own anyway, and more words are then known. Texts beside what could
    be a special token's string are left as they are."""
    data = flat.tobytes()
    if b"<|" not in data and len(flat) > 2:
        data = data.translate(_FOLDED)
        flat = np.frombuffer(data, dtype=np.uint8)
        at = np.flatnonzero(_MARK[flat[1:-1]]) + 1
        at = at[_IN_WORD[flat[at - 1]] & _BLANK[flat[at + 1]]]
        offsets, data = offsets + np.searchsorted(at, offsets), np.insert(flat, at, 32).tobytes()
    return [data[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]


_PLAIN = re.compile(r"(?!.*<\|)[\x00-\x7fÀ-ÖØ-öø-ÿ]*", re.DOTALL).fullmatch


class Words:
    """Token ids by the tokenizers library, which is asked once for each distinct word.

    White space never joins what stands on its sides, so texts are cut there, and ASCII
    words further into the vocabulary's pretokens, whose ids are remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.whole: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_whole: dict[bytes, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def _ask(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in found]

    def _ask_pretokens(self, words: list[str]) -> list[bytes]:
        """Ids of single pretokens: asked for as one text, and parted where words end."""
        found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype=self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._ask(words)
        data, size = ids.tobytes(), self.kind.itemsize
        return [data[a * size:b * size] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as bytes of ``kind``."""
        number: dict[bytes, int] = defaultdict(count().__next__)  # of each distinct word of the texts
        split = [list(map(number.__getitem__, t.split())) for t in texts]
        if len(self.whole) > REMEMBERED:
            self.old_whole, self.whole = self.whole, {}
        if len(self.parts) > REMEMBERED:
            self.old_parts, self.parts = self.parts, {}
        whole, parts, old, old_parts = self.whole, self.parts, self.old_whole, self.old_parts
        cuts, other = {}, []
        for w in number:
            if w in whole:
                continue
            if w in old:
                whole[w] = old[w]
            elif w.isalpha():  # letters of ASCII only: one pretoken
                cuts[w] = (w.lower().decode(),)
            elif _PLAIN(text := w.decode()):
                cuts[w] = _CUT(text.lower())
            else:
                other.append((w, text))
        whole.update(zip([w for w, _ in other], self._ask([t for _, t in other]), strict=True))
        unknown = []
        for p in set().union(*cuts.values()).difference(parts):
            if p in old_parts:
                parts[p] = old_parts[p]
            else:
                unknown.append(p)
        for i in range(0, len(unknown), 4096):
            some = unknown[i:i + 4096]
            parts.update(zip(some, self._ask_pretokens(some), strict=True))
        for w, cut in cuts.items():
            whole[w] = parts[cut[0]] if len(cut) == 1 else b"".join([parts[p] for p in cut])
        ids = [whole[w] for w in number]
        return [b"".join([ids[i] for i in words]) for words in split]


_LOADED: dict[str, Words] = {}


def own_queues(docs: DataFrame, queues: int = QUEUES, weights: dict[str, float] | None = None) -> tuple[list[str | None], bool]:
    """Sources with a queue of their own, those with a weight first, and whether there are others."""
    named = F.coalesce(F.col("source").isin([s for s in weights or {} if s is not None]), F.lit(None in (weights or {})))
    most = max(queues, len(weights or {}))
    first = docs.groupBy("source").count().orderBy(named.desc(), F.desc("count"), "source").limit(most + 1).collect()
    return [r.source for r in first[:most]], len(first) > most


def tokens(docs: DataFrame, path: str, own: list[str | None]) -> DataFrame:
    """part, queue, source (where it shares the last queue), at (offset among the part's
    tokens of the queue and source), doc_id, n, ids."""
    queue_of = {s: k for k, s in enumerate(own)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = Words(path)
        words = _LOADED[path]
        end = np.array([END], dtype=words.kind).tobytes()
        part, served = TaskContext.get().partitionId(), {}
        for batch in pieces(batches, "text", PIECE):
            ids = words.encode(loosened(*bytes_of(column(batch, "text"))))
            ids = [i + end for i in ids]
            sources = column(batch, "source").to_pylist()
            queue = [queue_of.get(s, len(queue_of)) for s in sources]
            n, at = [len(i) // words.kind.itemsize for i in ids], []
            for s, k in zip(sources, n, strict=True):
                at.append(served.get(s, 0))
                served[s] = at[-1] + k
            shared = [None if q < len(queue_of) else s for q, s in zip(queue, sources, strict=True)]
            yield pa.record_batch(
                [pa.array([part] * len(n), type=pa.int32()), pa.array(queue, type=pa.int32()),
                 pa.array(shared, type=pa.string()), pa.array(at, type=pa.int64()), column(batch, "doc_id"), pa.array(n, type=pa.int32()), pa.array(ids, type=pa.binary())],
                names=["part", "queue", "source", "at", "doc_id", "n", "ids"])

    return docs.select("doc_id", "source", "text").mapInArrow(
        run, "part int, queue int, source string, at long, doc_id long, n int, ids binary")


def _scaled(x: np.ndarray, times: np.ndarray | int, by: np.ndarray | int, add: np.ndarray | int = 0) -> np.ndarray:
    """floor((x * times + add) / by), in whole numbers of any size."""
    if not len(x):
        return np.zeros(x.shape, dtype=np.int64)
    whole, times = np.divmod(times, by)
    if int(np.max(np.abs(x))) * int(np.max(times)) + int(np.max(np.abs(add))) < 1 << 62:
        return x * whole + (x * times + add) // by
    return x * whole + ((x.astype(object) * times + add) // by).astype(np.int64)


class Rounds:
    """Where each queue's tokens go. One phase for natural proportions; with given weights
    a new phase begins, with the deficits carried on, when a queue has run empty."""

    shared = -1

    def __init__(self, totals: list[int], weights: list[float] | None = None, served_in_round: int = LENGTH):
        left = np.array(totals, dtype=np.int64)
        self.phases = []
        done, carry, start = np.zeros_like(left), np.zeros_like(left), 0
        while left.sum():
            if weights is None:
                unit, quantum = int(left.sum()), served_in_round * left
                rounds = -(-unit // served_in_round)
            else:
                unit, w = 1 << 20, np.where(left > 0, np.maximum(weights, 1e-9), 0.0)
                quantum = np.where(left > 0, np.maximum(1, w / w.sum() * served_in_round * unit), 0).astype(np.int64)
                rounds = min(-(-(int(t) * unit - int(c)) // int(q)) for t, c, q in zip(left, carry, quantum, strict=True) if t)
            served = np.array([min(int(t), (int(c) + rounds * int(q)) // unit) for t, c, q in zip(left, carry, quantum, strict=True)])
            self.phases.append((done.copy(), left.copy(), carry.copy(), quantum, unit, rounds, served, start))
            carry = np.array([(int(c) + rounds * int(q)) % unit for c, q in zip(carry, quantum, strict=True)])
            done, left, start = done + served, left - served, start + int(served.sum())

    def place(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of token ranges of queues: (which range, start in it, length, place)."""
        out = []
        for done, left, carry, quantum, unit, _, served, start in self.phases:
            low = np.maximum(first, done[queue])
            high = np.minimum(first + n, done[queue] + served[queue])
            on = np.flatnonzero(high > low)
            if not len(on):
                continue
            q, a, b = queue[on], low[on] - done[queue[on]], high[on] - done[queue[on]]
            begin = self._round(a, q, carry, quantum, unit)
            last = self._round(b - 1, q, carry, quantum, unit)
            slow = (quantum[q] < unit) & (q != self.shared)  # less than a token a round: each token by itself
            count = np.where(slow, b - a, last - begin + 1)
            of = np.repeat(np.arange(len(on)), count)
            step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            r = np.where(slow[of], self._round(a[of] + np.where(slow[of], step, 0), q[of], carry, quantum, unit), begin[of] + step)
            before = self._served(r, q[of], left, carry, quantum, unit)
            after = self._served(r + 1, q[of], left, carry, quantum, unit)
            p, e = np.maximum(before, a[of]), np.minimum(after, b[of])
            some = e > p
            of, r, p, e, before = of[some], r[some], p[some], e[some], before[some]
            place = start + self._offset(r, q[of], left, carry, quantum, unit) + p - before
            out.append((on[of], p + done[q[of]] - first[on[of]], e - p, place))
        if not out:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
        which, at, length, place = (np.concatenate(c) for c in zip(*out, strict=True))
        parts = (place + length - 1) // LENGTH - place // LENGTH + 1
        k = np.repeat(np.arange(len(which)), parts)
        nth = np.arange(len(k)) - np.repeat(np.cumsum(parts) - parts, parts)
        low = np.maximum(place[k], (place[k] // LENGTH + nth) * LENGTH)
        high = np.minimum(place[k] + length[k], (place[k] // LENGTH + nth + 1) * LENGTH)
        return which[k], at[k] + low - place[k], high - low, low

    def _round(self, token, q, carry, quantum, unit):
        return np.maximum(0, -_scaled(-(token + 1), unit, quantum[q], carry[q]) - 1) if len(token) else token

    def _served(self, r, q, left, carry, quantum, unit):
        return np.minimum(left[q], _scaled(r, quantum[q], unit, carry[q]))

    def _all_served(self, rounds, left, carry, quantum, unit):
        return np.minimum(left, _scaled(rounds, quantum[None], unit, carry[None]))

    def _offset(self, r, q, left, carry, quantum, unit):
        """Tokens of all queues before round r, and of the queues before q in it."""
        rounds, back = np.unique(r, return_inverse=True)
        out = np.zeros(len(r), dtype=np.int64)
        many = max(1, (1 << 20) // len(left))
        for low in range(0, len(rounds), many):
            these = rounds[low:low + many, None]
            now = self._all_served(these, left, carry, quantum, unit)
            then = self._all_served(these + 1, left, carry, quantum, unit)
            ahead = now.sum(axis=1)[:, None] + np.cumsum(then - now, axis=1) - (then - now)
            at = np.flatnonzero((back >= low) & (back < low + many))
            out[at] = ahead[back[at] - low, q[at]]
        return out


class Turns:
    """Tokens that sources have served after so many turns of one token for each that is left."""

    def __init__(self, sizes: list[int], counts: list[int]):
        order = np.argsort(sizes)
        self.ends, counts = np.array(sizes, dtype=np.int64)[order], np.array(counts, dtype=np.int64)[order]
        self.left = counts[::-1].cumsum()[::-1]
        self.served = np.cumsum(np.diff(self.ends, prepend=0) * self.left)

    def after(self, turn: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(self.ends, turn), len(self.ends) - 1)
        return self.served[i] - (self.ends[i] - np.minimum(turn, self.ends[-1])) * self.left[i]

    def turn(self, token: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.served, token, side="right")
        return self.ends[i] - 1 - (self.served[i] - 1 - token) // self.left[i]


class SharedRounds(Rounds):
    """Rounds with given weights whose last queue is shared by sources of weight 1. One
    phase: quanta stay, and rounds become shorter as queues and sources run empty."""

    def __init__(self, totals: list[int], weights: list[float], turns: Turns):
        served = np.array(totals, dtype=np.int64)
        left, none, unit = served.copy(), np.zeros_like(served), 1 << 30
        self.shared, self.turns, left[-1] = len(left) - 1, turns, turns.ends[-1]
        w = np.maximum([*weights, 1.0], 1e-9)
        quantum = np.maximum(1, w / (w[:-1].sum() + turns.left[0]) * LENGTH * unit).astype(np.int64)
        self.phases = [(none, left, none, quantum, unit, 0, served, 0)]

    def _round(self, token, q, carry, quantum, unit):
        own = q != self.shared
        turn = np.where(own, token, self.turns.turn(np.where(own, 0, token)))
        return super()._round(turn, q, carry, quantum, unit)

    def _served(self, r, q, left, carry, quantum, unit):
        served = super()._served(r, q, left, carry, quantum, unit)
        return np.where(q == self.shared, self.turns.after(served), served)

    def _all_served(self, rounds, left, carry, quantum, unit):
        served = super()._all_served(rounds, left, carry, quantum, unit)
        served[:, -1] = self.turns.after(served[:, -1])
        return served


def dealt(first: np.ndarray, n: np.ndarray, index: np.ndarray, beside: np.ndarray, size: np.ndarray, block: int) -> tuple[np.ndarray, ...]:
    """Pieces of token ranges of sources in their shared queue, as of ``Rounds.place``.

    ``index`` is the source's leaf in the tree, ``beside`` the totals of its path's other
    halves from the leaf up. Every ``block`` tokens of the queue are sorted by source.
    """
    sizes = size[:, None] + np.concatenate((np.zeros((len(size), 1), dtype=np.int64), np.cumsum(beside, axis=1)), axis=1)
    of = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    k = first[of] + step
    for level in range(beside.shape[1]):
        right = index[of] >> level & 1
        k = _scaled(k + 1 - right, sizes[of, level + 1], sizes[of, level], right - 1)
    block_of = k // block
    new = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(block_of, prepend=-1) != 0))
    of, at, nth, length = of[new], step[new], block_of[new], np.diff(np.append(new, len(step)))
    low, ahead = nth * block, np.zeros(len(new), dtype=np.int64)
    high = np.minimum(low + block, sizes[of, -1])
    for level in range(beside.shape[1] - 1, -1, -1):
        right = (index[of] >> level & 1).astype(bool)
        half = np.where(right, beside[of, level], sizes[of, level])
        a, b = (_scaled(x, half, sizes[of, level + 1]) for x in (low, high))
        ahead += np.where(right, b - a, 0)
        low, high = np.where(right, low - a, a), np.where(right, high - b, b)
    return of, at, length, nth * block + ahead + first[of] + at - low


def leaves(sizes: DataFrame, by_size: bool) -> DataFrame:
    """source, size and index, counted from 0, of all sources; with ``by_size`` the largest first."""
    group = [F.col("size")] if by_size else []
    hashed = sizes.withColumn("bucket", F.pmod(F.xxhash64("source"), F.lit(256)))
    nth = F.row_number().over(Window.partitionBy(*group, "bucket").orderBy("source"))
    before = [Window.unboundedPreceding, -1]
    start = hashed.groupBy(*group, "bucket").count()
    start = start.withColumn("start", F.coalesce(F.sum("count").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(*before)), F.lit(0)))
    if by_size:
        larger = sizes.groupBy("size").count().select(
            "size", F.coalesce(F.sum("count").over(Window.orderBy(F.desc("size")).rowsBetween(*before)), F.lit(0)).alias("larger"))
        start = start.join(larger, "size").withColumn("start", F.col("start") + F.col("larger")).drop("larger")
    return hashed.withColumn("nth", nth).join(start.drop("count"), ["size", "bucket"] if by_size else ["bucket"]).select(
        "source", "size", (F.col("start") + F.col("nth") - 1).alias("index"))


def paths(indexed: DataFrame, many: int) -> DataFrame:
    """source, size, index and beside: totals of the other halves on each leaf's way up."""
    levels = max(1, (many - 1).bit_length())
    nodes = F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda x: F.struct(
        x.alias("level"), F.call_function("shiftright", F.col("index"), x).alias("node")))
    each = indexed.select("index", "size", F.inline(nodes))
    totals = each.groupBy("level", "node").agg(F.sum("size").alias("other"))
    other = each.select("index", "level", F.col("node").bitwiseXOR(F.lit(1)).alias("node")).join(totals, ["level", "node"], "left")
    beside = other.groupBy("index").agg(F.sort_array(F.collect_list(F.struct("level", F.coalesce("other", F.lit(0)).alias("other"))))["other"].alias("beside"))
    return indexed.join(beside, "index")


def pack(
    docs: DataFrame, path: str, weights: dict[str, float] | None = None, queues: int = QUEUES, with_ids: bool = False, run: int = 1,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and queue, one for each source; with_ids adds the piece's ids.

    ``weights`` sets the target share of sources while they last, each source not named
    having weight 1; without it all sequences have the whole table's proportions. ``run`` is
    the least run of a source of mean share; sources that share a queue by weights serve
    single tokens whatever it is.
    """
    own, others = own_queues(docs, queues, weights)
    by_queue = None if weights is None else [float(weights.get(s, 1.0)) for s in own]
    written = kept(tokens(docs, path, own), "tokens")
    sums = written.groupBy("part", "queue", "source").agg(F.max(F.col("at") + F.col("n")).alias("size"))
    before = Window.partitionBy("queue", "source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = kept(sums.select("part", "queue", "source", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "bases")
    by_sum = {r.queue: r.total for r in bases.groupBy("queue").agg(F.sum("size").alias("total")).collect()}
    totals = [by_sum.get(k, 0) for k in range(max(by_sum, default=-1) + 1)]
    small, on, most, turns, shared = bases.drop("size", "source"), ["part", "queue"], BROADCAST_ROWS, None, 0
    if others:
        sizes = kept(bases.where(F.col("queue") == len(own)).groupBy("source").agg(F.sum("size").alias("size")), "sizes")
        indexed = kept(leaves(sizes, weights is not None), "leaves")
        shared = indexed.count()
        if weights is None:
            indexed = kept(paths(indexed, shared), "paths")
        else:
            indexed = indexed.withColumn("beside", F.lit(None).cast("array<long>"))
            turns = Turns(*zip(*[(r["size"], r["count"]) for r in sizes.groupBy("size").count().collect()], strict=True))
        of = indexed.withColumnRenamed("source", "of").withColumn("of_queue", F.lit(len(own)))
        shares = (F.col("queue") == F.col("of_queue")) & F.col("source").eqNullSafe(F.col("of"))
        small = kept(bases.drop("size").join(of, shares, "left").drop("of", "of_queue").withColumnsRenamed(
            {"part": "b_part", "queue": "b_queue", "source": "b_source"}), "shared-bases")
        on = (F.col("part") == F.col("b_part")) & (F.col("queue") == F.col("b_queue")) & F.col("source").eqNullSafe(F.col("b_source"))
        most //= 8
    served_in_round = LENGTH * max(1, -(-run * (len(own) + shared) // LENGTH))
    rounds = SharedRounds(totals, by_queue, turns) if turns else Rounds(totals, by_queue, served_in_round)
    block = max(1, served_in_round * by_sum.get(len(own), 0) // max(1, sum(totals)))
    placed = written.join(F.broadcast(small) if small.count() <= most else small, on)

    def place(batch: pa.RecordBatch, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of the batch's documents in the sequences, and the queue of each document."""
        if not others:
            return *rounds.place(queue, first, n), queue
        own_rows, rows = np.flatnonzero(queue < len(own)), np.flatnonzero(queue == len(own))
        whole = rounds.place(queue[own_rows], first[own_rows], n[own_rows])
        index, size = (column(batch, c).take(pa.array(rows)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("index", "size"))
        if turns:
            of = np.repeat(np.arange(len(rows)), n[rows])
            at = np.arange(len(of)) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows])
            length, start = np.ones(len(of), dtype=np.int64), turns.after(first[rows][of] + at) + index[of]
        else:
            beside = np.array(column(batch, "beside").take(pa.array(rows)).to_pylist(), dtype=np.int64).reshape(len(rows), -1)
            of, at, length, start = dealt(first[rows], n[rows], index, beside, size, block)
        which, more, length, at_place = rounds.place(np.full(len(of), len(own)), start, length)
        found = (own_rows[whole[0]], rows[of[which]]), (whole[1], at[which] + more), (whole[2], length), (whole[3], at_place)
        queue = queue.copy()
        queue[rows] += index
        return *(np.concatenate(c) for c in found), queue

    def placed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "ids"):
            n = column(batch, "n").to_numpy().astype(np.int64)
            queue = column(batch, "queue").to_numpy().astype(np.int64)
            first = column(batch, "at").to_numpy() + column(batch, "base").to_numpy()
            which, at, length, to, queue = place(batch, queue, first, n)
            order = np.lexsort((at, which))
            which, at, length, to = which[order], at[order], length[order], to[order]
            flat, offsets = bytes_of(column(batch, "ids"))
            size = int((offsets[-1] - offsets[0]) // max(1, n.sum()))
            ids = flat.view(f"<u{size}").astype("<u4") if len(flat) else np.zeros(0, dtype="<u4")
            begin = (offsets[:-1] // size)[which] + at
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(begin, begin + length, strict=True)]
            out = [column(batch, "doc_id").take(pa.array(which)), pa.array(at), pa.array(length), pa.array(crc, type=pa.int64()),
                   pa.array(n[which]), pa.array(to // LENGTH), pa.array(to % LENGTH), pa.array(queue[which].astype(np.int32))]
            if with_ids:
                out.append(pa.array([ids[a:b].astype(np.int32) for a, b in zip(begin, begin + length, strict=True)], type=pa.list_(pa.int32())))
            yield pa.record_batch(out, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue", *["ids"] * with_ids]
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue int"
              + ", ids array<int>" * with_ids)
    more = ["index", "size", "beside"] if others else []
    return placed.select("doc_id", "queue", "at", "n", "base", "ids", *more).mapInArrow(placed_pieces, schema)
