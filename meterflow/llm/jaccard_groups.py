"""Exact n-gram Jaccard join by groups of similar documents.

Documents become sets of hashed word shingles; equal sets are one. Two sets that are
similar enough share a token among the first ones of each in any fixed order (the prefix).
The order puts last what tasks have met in several sets, and before that shingles of
common words. Then:

1. Every set is compared with the sets it shares most prefix tokens with, among the
   smallest and largest keys of each token. The links found partition the sets into groups,
   which are compared with each other in the same way, as if each was one set.
2. Groups, in parts of bounded size, are stored with their members' token union. A set
   that shares a prefix token with a part of another group is a query to it. The overlap
   with the union bounds the overlap with every member, so only parts where it is large
   enough are opened and their members compared. The bound is first taken on counts of
   tokens by range of hash, which are small, then on the tokens themselves.

Links inside a group need no search, as it is connected already; across groups none is
lost. Comparisons are exact but for the chance of equal 64-bit hashes.

Defined results: null texts and texts without words have empty sets and link with nothing;
texts with fewer words than a shingle are one shingle of them all; repeated rows are equal
sets; a null doc_id takes part and is passed over for the smallest id. Extra columns are
ignored by ``linked`` and kept by ``one_of_each``, which leaves one row of each component
whatever its ids are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import bytes_of, column, dropped, kept, pieces, released, writers
from meterflow.llm.components import components

#: Tokens that the order puts last at most, words taken for common ones, and the shingles
#: that a task counts at once. They shape the order and so the work, never the result.
FREQUENT, COMMON, COUNTED = 200_000, 8192, 1 << 21
#: Ranges of hash by which a set's tokens are counted, prefix tokens of a bucket.
RANGES, BUCKET = 128, 1 << 20
#: Sets of other groups that a group is compared with in each turn before questions are
#: asked, and turns at most. They shape the work only.
ENDS, TURNS = 8, 2
#: Members of a part of a group, on average.
PART = 64
#: Bits of the filter that tells tasks which texts others ask for.
FILTER_BITS = 24

_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_random = np.random.default_rng(20_07)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64)[_LOWER] * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C13)
_BACK = np.uint64(pow(0x9E3779B97F4A7C13, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's begin.

    A word's hash is a difference of running sums, so all words of a slice are hashed in a
    few steps whatever their lengths.
    """
    flat, offsets = bytes_of(texts)
    if not len(flat):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    solid = ~_BLANK[flat]
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate(([False], solid[:-1]))))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1
    power = np.full(len(flat), _STEP, dtype=np.uint64)
    power[0] = 1
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[flat] * np.multiply.accumulate(power))))
    power[:] = _BACK
    power[0] = 1
    words = _mixed((sums[ends] - sums[starts]) * np.multiply.accumulate(power)[starts])
    return words, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, first: np.ndarray, k: int, common: dict | None = None) -> list:
    """The sorted distinct 64-bit shingle hashes of each text; with ``common`` words and
    their weights, also how common each shingle's words are together."""
    none, out = np.zeros(0, dtype=np.uint64), []
    whole = weight = none
    if common:
        at = np.minimum(np.searchsorted(common["words"], words), len(common["words"]) - 1)
        each = np.where(common["words"][at] == words, common["weights"][at], 0).astype(np.uint64)
    if len(words) >= k:
        whole = np.zeros(len(words) - k + 1, dtype=np.uint64)
        weight = np.zeros(len(words) - k + 1, dtype=np.uint64)
        for i in range(k):
            whole = whole * np.uint64(0xD1342543DE82EF95) + words[i:len(words) - k + 1 + i]
            if common:
                weight += each[i:len(words) - k + 1 + i]
        whole = _mixed(whole)
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= k:
            if common:
                tokens, at = np.unique(whole[a:b - k + 1], return_index=True)
                out.append((tokens, weight[a:b - k + 1][at]))
                continue
            tokens = np.unique(whole[a:b - k + 1])
        elif b > a:
            h = int(b - a)
            for w in words[a:b].tolist():
                h = (h * 0xD1342543DE82EF95 + w) & 0xFFFFFFFFFFFFFFFF
            tokens = _mixed(np.array([h], dtype=np.uint64))
        else:
            tokens = none
        out.append((tokens, np.zeros(len(tokens), dtype=np.uint64)) if common else tokens)
    return out


def key_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def short(tokens: np.ndarray) -> bytes:
    """Six bytes of each hash, in the hashes' order."""
    return (tokens >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def long(stored: bytes) -> np.ndarray:
    out = np.zeros((len(stored) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(stored, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted sets: each of the smaller is looked up in the larger."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def counted(docs: DataFrame, k: int) -> DataFrame:
    """kind, hash, c: how often tasks have met shingles (several times) and common words.

    Tasks count all shingles and words of their documents, each set once. Something that
    is frequent is met in many tasks, so what single tasks leave out doesn't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, seen, size = [], set(), 0

        def told() -> Iterator[pa.RecordBatch]:
            values, counts = np.unique(np.concatenate([t for t, _ in met]), return_counts=True)
            often = counts >= 2
            words, uses = np.unique(np.concatenate([w for _, w in met]), return_counts=True)
            top = np.argsort(-uses, kind="stable")[:2 * COMMON]
            for kind, v, c in ((0, values[often], counts[often]), (1, words[top], uses[top])):
                yield pa.record_batch(
                    [pa.array([kind] * len(v), type=pa.int32()), pa.array(v.view(np.int64)), pa.array(c)], names=["kind", "hash", "c"])

        for part in pieces(batches, "text"):
            words, first = hashed(column(part, "text"))
            for tokens, a, b in zip(shingles(words, first, k), first, first[1:], strict=False):
                key = key_of(tokens)
                if len(tokens) and key not in seen:
                    seen.add(key)
                    met.append((tokens, words[a:b]))
                    size += len(tokens)
            if size > COUNTED:
                yield from told()
                met, size = [], 0
        if met:
            yield from told()

    return docs.select("text").mapInArrow(run, "kind int, hash long, c long").groupBy("kind", "hash").agg(F.sum("c").alias("c"))


def order_of(docs: DataFrame, k: int, tasks: int | None = None) -> dict:
    """Frequent shingles, and common words with weights that rise with their logarithm."""
    counts = kept(counted(docs, k), "counts", tasks=tasks)
    often = counts.where("kind = 0 and c >= 4").orderBy(F.desc("c"), "hash").limit(FREQUENT).toArrow()
    words = counts.where("kind = 1").orderBy(F.desc("c"), "hash").limit(COMMON).toArrow()
    dropped(counts)
    h, c = (words.column(x).to_numpy() for x in ("hash", "c"))
    h = h.astype(np.int64).view(np.uint64)
    at = np.argsort(h)
    weights = 1 + np.floor(4 * np.log2(np.maximum(1, c[at] / max(1, c.min(initial=1 << 62)))))
    none = {"words": np.zeros(1, dtype=np.uint64), "weights": np.zeros(1)}
    return {"often": np.sort(often.column("hash").to_numpy().astype(np.int64).view(np.uint64)),
            **({"words": h[at], "weights": np.minimum(weights, 255)} if len(h) else none)}


def prefixes(docs: DataFrame, k: int, num: int, den: int, tasks: int | None = None) -> DataFrame:
    """doc_id, key, n, a mark of the text and, for the first of equal sets in a task, the
    prefix tokens and the counts of tokens by range of hash."""
    order = docs.sparkSession.sparkContext.broadcast(order_of(docs, k, tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = order.value, set()
        often = known["often"]
        for part in pieces(batches, "text"):
            keys, sizes, heads, ranges = [], [], [], []
            for tokens, weight in shingles(*hashed(column(part, "text")), k, known):
                n = len(tokens)
                key = key_of(tokens) if n else None
                keys.append(key)
                sizes.append(n)
                if not n or key in seen:
                    heads.append(None)
                    ranges.append(None)
                    continue
                seen.add(key)
                rank = (weight << np.uint64(48)) | (tokens >> np.uint64(16))
                if len(often):
                    at = np.searchsorted(often, tokens)
                    at[at == len(often)] = 0
                    rank |= (often[at] == tokens).astype(np.uint64) << np.uint64(63)
                size = n + (-num * n // den) + 1
                first = np.argpartition(rank, size - 1)[:size] if size < n else np.arange(n)
                heads.append(tokens[first[np.argsort(rank[first])]].tobytes())
                ranges.append(np.bincount((tokens >> np.uint64(57)).astype(np.int64), minlength=RANGES).astype("<u4").tobytes())
            yield pa.record_batch(
                [column(part, "doc_id"), pa.array(keys, type=pa.int64()), pa.array(sizes, type=pa.int64()),
                 column(part, "mark"), pa.array(heads, type=pa.binary()), pa.array(ranges, type=pa.binary())],
                names=["doc_id", "key", "n", "mark", "prefix", "ranges"])

    return marked(docs, "doc_id").mapInArrow(
        run, "doc_id long, key long, n long, mark long, prefix binary, ranges binary")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Token, key and room (tokens of the set from this one on in the order) of each prefix
    token, some millions at a time, sorted by token, key."""
    tokens, keys, rooms, size = [], [], [], 0

    def told() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t, k, r = np.concatenate(tokens), np.concatenate(keys), np.concatenate(rooms)
        at = np.lexsort((k, t))
        return t[at], k[at], r[at]

    for batch in batches:
        flat, offsets = bytes_of(column(batch, "prefix"))
        tokens.append(flat.view("<u8"))
        many, begin = np.diff(offsets) // 8, offsets[:-1] // 8
        keys.append(np.repeat(column(batch, "key").to_numpy(), many))
        rooms.append(np.repeat(column(batch, "n").to_numpy() + begin, many) - np.arange(len(tokens[-1])))
        size += len(tokens[-1])
        if size > COUNTED:
            yield told()
            tokens, keys, rooms, size = [], [], [], 0
    if size:
        yield told()


def _starred(tokens: np.ndarray, keys: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of keys with the smallest and largest key of a token they share, counted;
    and where each token's run begins, its smallest and its largest key."""
    edge = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    begin = np.flatnonzero(edge)
    end = np.concatenate((begin[1:], [len(tokens)])) - 1
    run = np.cumsum(edge) - 1
    low, high = keys[begin], keys[end]
    pairs = [np.stack((keys[x], other[run][x]), axis=1) for other in (low, high) for x in (keys != other[run],)]
    pairs, counts = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
    batch = pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.array(counts)], names=["key", "other", "c"])
    return batch, begin, low, high


def stars(heads: DataFrame, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, other, c): sets and the sets at the ends of tokens they share c of; and the
    tokens (token) that several sets have in their prefixes.

    Each task links the sets it holds and passes on only the two ends of each token, as
    plain bytes in buckets whose number grows with the tokens'. So neither a token that
    very many sets share nor a bucket is ever large.
    """
    total = heads.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    buckets = 1 + int(total) // BUCKET
    schema = "bucket int, tokens binary, keys binary, key long, other long, c long"

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, keys, _ in _heads(batches):
            batch, begin, low, high = _starred(tokens, keys)
            n = batch.num_rows
            yield pa.record_batch([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), *batch.columns],
                                  names=["bucket", "tokens", "keys", "key", "other", "c"])
            two = low != high
            token = np.concatenate((tokens[begin], tokens[begin][two]))
            key = np.concatenate((low, high[two]))
            bucket = (_mixed(token) % np.uint64(buckets)).astype(np.int64)
            at = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[at], np.arange(buckets + 1))
            some = np.flatnonzero(cut[1:] > cut[:-1])
            token, key = token[at], key[at]
            m = len(some)
            yield pa.record_batch(
                [pa.array(some.astype(np.int32)), pa.array([token[cut[i]:cut[i + 1]].tobytes() for i in some], type=pa.binary()),
                 pa.array([key[cut[i]:cut[i + 1]].tobytes() for i in some], type=pa.binary()),
                 *(pa.nulls(m, pa.int64()) for _ in range(3))], names=["bucket", "tokens", "keys", "key", "other", "c"])

    def far(table: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), dtype="<u8")
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype="<i8")
        at = np.lexsort((keys, tokens))
        batch, begin, low, high = _starred(tokens[at], keys[at])
        shared = tokens[at][begin][low != high].view(np.int64)
        one, two = pa.nulls(batch.num_rows, pa.int64()), pa.nulls(len(shared), pa.int64())
        return pa.concat_tables([
            pa.table([*batch.columns, one], names=["key", "other", "c", "token"]),
            pa.table([two, two, two, pa.array(shared)], names=["key", "other", "c", "token"])])

    told = heads.select("key", "n", "prefix").mapInArrow(near, schema)  # read twice rather than stored
    met = kept(told.where("bucket is not null").select("bucket", "tokens", "keys").groupBy("bucket").applyInArrow(
        far, "key long, other long, c long, token long"), "far", tasks=tasks)
    pairs = told.where("bucket is null").select("key", "other", "c").unionByName(met.where("token is null").drop("token"))
    return pairs, met.where("token is not null").select("token")


def group_ends(found: DataFrame, label: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of keys of different groups: of each group the ENDS that share most tokens.

    A token leads all its sets to two of them, chosen by a hash that each turn changes. So,
    as with single sets, it yields two pairs for each set, not one for each two of them.
    """
    named = found.join(label, F.col("key") == F.col("node"), "left").select(
        "token", "key", F.coalesce("label", "key").alias("grp"), F.xxhash64("key", F.lit(turn)).alias("by"))
    ends = named.groupBy("token").agg(*[of(F.struct("by", "grp", "key")).alias(name) for of, name in ((F.min, "low"), (F.max, "high"))])
    met = named.join(ends, "token").select("key", "grp", F.explode(F.array("low", "high")).alias("end")).where("grp <> end.grp")
    near = met.groupBy("grp", "key", F.col("end.key").alias("other")).agg(F.count("*").alias("c"))
    order = Window.partitionBy("grp").orderBy(F.desc("c"), "key", "other")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ENDS)
    return near.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()


def filter_of(values: DataFrame) -> np.ndarray:
    """A bitmap of the values' first bits: of fixed size, so it can go to every task."""
    place = F.shiftrightunsigned(F.col(values.columns[0]), 64 - FILTER_BITS)
    parts = values.select(place.alias("p")).groupBy(F.call_function("bitmap_bucket_number", "p").alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("p"))).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) // 8 + 4096, dtype=np.uint8)
    for r in (r for r in parts if r.bucket > 0):
        bits[(r.bucket - 1) * 4096:r.bucket * 4096] |= np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return bits


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of some 64-bit values may be in the filter; Spark's bitmaps count from bit 1."""
    at = (values.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64) - 1
    return (at < 0) | (bits[np.maximum(at, 0) >> 3] >> (np.maximum(at, 0) & 7).astype(np.uint8) & 1).astype(bool)


def postings(heads: DataFrame, shared: DataFrame) -> DataFrame:
    """token, key and room of the prefix tokens that several sets have."""
    bits = heads.sparkSession.sparkContext.broadcast(filter_of(shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, keys, rooms in _heads(batches):
            may = passes(bits.value, tokens)
            yield pa.record_batch([pa.array(tokens[may].view(np.int64)), pa.array(keys[may]), pa.array(rooms[may])], names=["token", "key", "room"])

    return heads.select("key", "n", "prefix").mapInArrow(run, "token long, key long, room long").join(shared, "token").distinct()


def marked(docs: DataFrame, *more: str) -> DataFrame:
    """The texts, each with the mark by which it is known before it is taken to a set again;
    equal marks of different texts do no harm."""
    return docs.select(*more, "text", F.xxhash64("text").alias("mark"))


def full_sets(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """key, n, tokens of the sets of texts with the wanted marks (and few others), made again
    from these texts alone."""
    asked = docs.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            may = passes(asked.value, column(batch, "mark").to_numpy())
            for part in pieces([batch.filter(pa.array(may))], "text"):
                new = {}
                for t in shingles(*hashed(column(part, "text")), k):
                    if len(t) and (key := key_of(t)) not in seen:
                        seen.add(key)
                        new[key] = t
                yield pa.record_batch(
                    [pa.array(list(new), type=pa.int64()), pa.array([len(t) for t in new.values()], type=pa.int64()),
                     pa.array([short(t) for t in new.values()], type=pa.binary())], names=["key", "n", "tokens"])

    return marked(docs).mapInArrow(run, "key long, n long, tokens binary").dropDuplicates(["key"])


def _checked(rows: DataFrame, enough, names: list[str], column_of: str = "tokens") -> DataFrame:
    """The named columns of rows that pass ``enough(sizes, most overlap of both sides)``.

    The overlap is that of two stored sets, or the most that their counts by range allow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = column(batch, f"left_{column_of}"), column(batch, f"right_{column_of}")
            n, m = column(batch, "left_n").to_pylist(), column(batch, "right_n").to_pylist()
            if column_of == "ranges":
                two = [bytes_of(x)[0].view("<u4").reshape(-1, RANGES) for x in (left, right)]
                most = np.minimum(*two).sum(axis=1, dtype=np.int64).tolist()
            else:
                most = [overlap(long(a), long(b)) for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)]
            good = [enough(*x) for x in zip(n, m, most, strict=True)]
            yield batch.filter(pa.array(good, type=pa.bool_())).select(names)

    schema = ", ".join(f"{c} long" for c in names)
    return rows.select(*names, "left_n", "right_n", f"left_{column_of}", f"right_{column_of}").mapInArrow(run, schema)


def _paired(pairs: DataFrame, sets: DataFrame, *what: str) -> DataFrame:
    """Pairs (a, b) with both sets' sizes and stored columns."""
    one = sets.select(F.col("key").alias("a"), F.col("n").alias("left_n"), *(F.col(c).alias(f"left_{c}") for c in what))
    two = sets.select(F.col("key").alias("b"), F.col("n").alias("right_n"), *(F.col(c).alias(f"right_{c}") for c in what))
    return pairs.join(one, "a").join(two, "b")


def _linked_pairs(docs: DataFrame, k: int, pairs: DataFrame, sketches: DataFrame, num: int, den: int, tasks: int, name: str) -> DataFrame:
    """The pairs (a, b) of keys whose sets link: by counts first, then by their tokens."""
    enough = lambda n, m, o: den * o >= num * (n + m - o)
    near = _checked(_paired(pairs, sketches, "ranges", "mark"), enough, ["a", "b", "left_mark", "right_mark"], "ranges")
    near = kept(near, f"{name}-pairs", tasks=tasks)
    wanted = near.select(F.explode(F.array("left_mark", "right_mark")))
    sets = kept(full_sets(docs, k, wanted), f"{name}-sets", tasks=tasks)
    released(docs.sparkSession)
    found = kept(_checked(_paired(near, sets, "tokens"), enough, ["a", "b"]), name, tasks=tasks)
    dropped(near, sets)
    released(docs.sparkSession)
    return found


def links(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n) of all documents, and links (a, b) of keys that connect all groups."""
    tasks = writers(docs)
    rows = kept(prefixes(docs, k, num, den, tasks), "prefixes")
    heads = rows.where(F.col("prefix").isNotNull())
    sketches = heads.select("key", "n", "mark", "ranges").dropDuplicates(["key"])

    # 1. groups: each set with the two sets it shares most ends with
    met, shared = stars(heads, tasks)
    near = met.groupBy("key", "other").agg(F.sum("c").alias("c"))
    order = Window.partitionBy("key").orderBy(F.desc("c"), "other")
    near = near.withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    pairs = near.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
    first = _linked_pairs(docs, k, pairs, sketches, num, den, tasks, "first-links")
    label, written = components(first, "a", "b"), [first]
    released(docs.sparkSession)

    # a large cluster falls into many groups at first: groups are taken for single sets, each
    # compared with some that its tokens lead to, and what links is one group
    found = kept(postings(heads, shared), "postings", tasks=tasks)
    for turn in range(TURNS):
        more = _linked_pairs(docs, k, group_ends(found, label, turn), sketches, num, den, tasks, "contracting-links")
        if more.isEmpty():
            dropped(more)
            break
        first, written = first.unionByName(more), [*written, more]
        last, label = label, components(first, "a", "b")
        dropped(last)
        released(docs.sparkSession)

    # 2. parts of groups, their unions, queries to other groups' parts
    sizes = label.groupBy("label").agg(F.count("*").alias("size"))
    grouped = label.join(sizes, "label").select(
        F.col("node").alias("key"), F.col("label").alias("grp"), "size",
        F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / PART)).alias("part"))
    member = heads.select("key", "n", "mark").dropDuplicates(["key"]).join(grouped, "key", "left").select(
        "key", "n", "mark", F.coalesce("grp", "key").alias("grp"), F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("part", F.lit(0)).alias("part"))
    member = kept(member, "members", tasks=tasks)
    whole = kept(found.join(member.drop("mark"), "key"), "index", tasks=tasks)
    dropped(found, label)
    across = whole.groupBy("token").agg(F.min("grp").alias("g"), F.max("grp").alias("h")).where("g < h").select("token")
    index = kept(whole.join(across, "token"), "across", tasks=tasks)
    dropped(whole)
    of_part = index.groupBy("token", "grp", "size", "part").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("room").alias("room"))
    # the first token that two linked sets share leaves both room for the overlap they need
    need = num * (F.col("q.n") * den + F.greatest(F.col("s.least") * den, F.col("q.n") * num))
    asks = index.alias("q").join(of_part.alias("s"), "token").where(
        (F.struct("q.size", "q.grp") < F.struct("s.size", "s.grp"))
        & (F.col("q.n") * den >= F.col("s.least") * num) & (F.col("s.most") * den >= F.col("q.n") * num)
        & (F.least("q.room", "s.room") * (den * (num + den)) >= need))
    asks = kept(asks.select(
        F.col("q.key").alias("a"), F.col("q.grp").alias("own"), F.col("s.grp").alias("grp"), F.col("s.part").alias("part"), F.col("s.size").alias("size")).distinct(), "asks", tasks=tasks)

    # two groups need one link only: one pair of members of each two is compared first, and
    # what the groups that it joins ask of each other falls away
    dropped(index)
    released(docs.sparkSession)
    members = member.groupBy("grp", "part").agg(F.max("key").alias("b"))
    tries = asks.groupBy("own", "grp").agg(F.min(F.struct("a", "part")).alias("t")).select("grp", "t.*")
    joined = _linked_pairs(docs, k, tries.join(members, ["grp", "part"]).select("a", "b"), sketches, num, den, tasks, "joining-links")
    first, written = first.unionByName(joined), [*written, joined]

    # then every set asks one part of each group of several, and what is joined by that falls
    # away too, before all that is still open is asked
    asked = asks
    for several in (True, False):
        label = components(first, "a", "b")
        named = lambda c: label.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))  # noqa: E731, B023
        asks = asks.join(named("a"), "a", "left").join(named("grp"), "grp", "left")
        whole, asks = asked, kept(asks.where(F.coalesce("a_label", "a") != F.coalesce("grp_label", "grp")).select("a", "grp", "part", "size"), "open-asks", tasks=tasks)
        dropped(whole, label)
        asked = asks
        now = asks.where("size > 1").groupBy("a", "grp").agg(F.min("part").alias("part")) if several else asks.select("a", "grp", "part")
        more = _answered(docs, k, num, den, now, member, sketches, tasks)
        first, written = first.unionByName(more), [*written, more]
        released(docs.sparkSession)
    first = kept(first, "answered-links", tasks=tasks)
    dropped(asked, member, *written)
    return rows.select("doc_id", "key", "n"), first


def _answered(docs: DataFrame, k: int, num: int, den: int, asks: DataFrame, member: DataFrame, sketches: DataFrame, tasks: int) -> DataFrame:
    """Links (a, b) of sets with members of the parts they ask (a, grp, part): parts are
    opened where the bound on the overlap with their union allows it."""
    # a part with one member is that member: its bound is the comparison itself
    asked = member.join(asks.select("grp", "part").distinct(), ["grp", "part"])
    bound = lambda n, m, o: den * o >= num * (n if m < 0 else n + m - o)
    query = sketches.select(F.col("key").alias("a"), F.col("n").alias("left_n"), "mark", F.col("ranges").alias("left_ranges"))
    ranges = asked.select("key", "grp", "part").join(sketches, "key").groupBy("grp", "part").agg(
        F.collect_list("ranges").alias("many"), F.when(F.count("*") == 1, F.max("n")).otherwise(F.lit(-1)).cast("long").alias("right_n")).mapInArrow(
            _unions(lambda many: np.sum([np.frombuffer(x, dtype="<u4") for x in many], axis=0).astype("<u4").tobytes(), "ranges"),
            "grp long, part long, right_n long, right_ranges binary")
    likely = kept(_checked(asks.join(query, "a").join(ranges, ["grp", "part"]), bound, ["a", "grp", "part", "mark"], "ranges"), "likely", tasks=tasks)
    inside = kept(asked.select("key", "grp", "part", "mark").join(likely.select("grp", "part").distinct(), ["grp", "part"]), "inside", tasks=tasks)
    released(docs.sparkSession)

    sets = kept(full_sets(docs, k, likely.select("mark").unionByName(inside.select("mark"))), "asked-sets", tasks=tasks)
    parts = inside.groupBy("grp", "part").agg(F.count("*").alias("members"), F.min("key").alias("b"))
    told = likely.join(parts, ["grp", "part"])
    query = sets.select(F.col("key").alias("a"), F.col("n").alias("left_n"), F.col("tokens").alias("left_tokens"))
    several = inside.join(parts.where("members > 1").select("grp", "part"), ["grp", "part"])
    unions = several.join(sets.select("key", "tokens"), "key").groupBy("grp", "part").agg(
        F.collect_list("tokens").alias("many"), F.lit(-1).cast("long").alias("right_n")).mapInArrow(
            _unions(lambda many: short(np.unique(np.concatenate([long(x) for x in many])) << np.uint64(16)), "tokens"),
            "grp long, part long, right_n long, right_tokens binary")
    opened = _checked(told.where("members > 1").select("a", "grp", "part").join(query, "a").join(unions, ["grp", "part"]), bound, ["a", "grp", "part"])
    compared = opened.join(several.select(F.col("key").alias("b"), "grp", "part"), ["grp", "part"]).select("a", "b")
    compared = kept(compared.unionByName(told.where("members = 1").select("a", "b")), "compared", tasks=tasks)
    enough = lambda n, m, o: den * o >= num * (n + m - o)
    found = kept(_checked(_paired(compared, sets, "tokens"), enough, ["a", "b"]), "more-links", tasks=tasks)
    dropped(likely, inside, sets, compared)
    released(docs.sparkSession)
    return found


def _unions(join, what: str):
    """Batches of parts with their members' stored columns joined to one; a part is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [join(many) for many in column(batch, "many").to_pylist()]
            yield pa.record_batch(
                [column(batch, "grp"), column(batch, "part"), column(batch, "right_n"), pa.array(whole, type=pa.binary())],
                names=["grp", "part", "right_n", f"right_{what}"])

    return run


def linked(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every document.

    Documents link when den * intersection >= num * union of their sets of k-word shingles.
    """
    rows, found = links(docs, k, num, den)
    tasks = writers(rows)
    label = components(found, "a", "b")
    ids = kept(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")), "ids", tasks=tasks)
    whole = ids.join(label, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("label", "key").alias("label"))
    smallest = whole.groupBy("label").agg(F.min("least").alias("component_id"))
    of_key = whole.join(smallest, "label").select("key", "component_id")
    some = rows.where("n > 0").join(of_key, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))).coalesce(tasks)


def one_of_each(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id, null
    last, and of equal ids the first in the table.

    Rows are numbered by their place in the scan, so ``docs`` should be a table. Texts without
    words are linked with nothing and all stay.
    """
    row = next(f"row_{i}" for i in range(len(docs.columns) + 1) if f"row_{i}" not in docs.columns)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = linked(numbered.select(F.col(row).alias("doc_id"), "text"), k, num, den)
    named = numbered.select(F.col(row).alias("row"), "doc_id").join(found.select(F.col("doc_id").alias("row"), "component_id"), "row")
    stays = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return numbered.join(stays.select(F.col("first.row").alias(row)), row, "left_semi").select(*docs.columns).coalesce(writers(docs))


#: ``linked`` with 4 words and a similarity of 0.85, for DuckDB.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT r, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r
), l AS (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS o FROM s x JOIN s y ON x.s = y.s AND x.r <> y.r GROUP BY x.r, y.r)
  JOIN n m ON m.r = a JOIN n k ON k.r = b WHERE 100 * o >= 85 * (m.n + k.n - o)
), reach AS (
  SELECT r AS a, r AS b FROM d
  UNION
  SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
)
SELECT x.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN d x ON x.r = reach.a JOIN d y ON y.r = reach.b LEFT JOIN n ON n.r = reach.a GROUP BY reach.a, x.doc_id
"""
