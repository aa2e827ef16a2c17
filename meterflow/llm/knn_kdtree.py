"""Exact top-k search by inner product over KD-trees, one per shard of the vectors.

A shard's rows are split at the median of their widest dimension until leaves are small;
every node keeps the tight box around its rows. The largest inner product a box allows
bounds all rows in it, so a block of queries visits nodes best bound first, each with the
queries whose k-th score so far is not above its bound. The k-th score that a first shard
yields is carried to all other shards, where it ends most searches early.

Shards and queries meet in lanes: the rows of a lane come to one task as they are, queries
first and then shard by shard, so a task holds a part of the queries and one shard. A query
goes to no more than ``GROUPS`` lanes however many shards there are, and only the counts by
length go to the driver.

Defined results: vectors that are null or hold null or non-finite components take no part,
neither do queries without partners; ties go to the smaller vec_id, null last; of repeated
ids every row takes part and is left out only from its own search; only vectors of the
same length are compared. Components are whole numbers of a long; a vector with one beyond
that takes no part. Scores are compared as whole numbers of any size; one beyond a long is
returned as the nearest long. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import bytes_of, column, kept

SCALE, LEAF, SHARD_ROWS, BLOCK_ROWS = 256, 128, 8192, 512
#: Lanes that the shards of one length are dealt out to at most, bytes of the queries that one
#: lane holds, queries that meet the first shard in one lane, and tasks for all lanes at most.
GROUPS, PART_BYTES, CHUNK_ROWS, TASKS = 64, 64 << 20, 2048, 4096
_LAST, _LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """row, vec_id, size and the components times 256, rounded down, of usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, sizes, out, rows = [], [], [], []
            for k, (i, v) in enumerate(zip(column(batch, "vec_id").to_pylist(), column(batch, "embedding").to_pylist(), strict=True)):
                if v is None or any(x is None for x in v):
                    continue
                x = np.array(v, dtype=float)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(SCALE * x)
                if (np.abs(x) < 2.0**63).all():
                    rows.append(row + k)
                    ids.append(i)
                    sizes.append(len(x))
                    out.append(x.astype("<i8").tobytes())
            row += batch.num_rows
            yield pa.record_batch(
                [pa.array(rows, type=pa.int64()), pa.array(ids, type=pa.int64()), pa.array(sizes, type=pa.int32()), pa.array(out, type=pa.binary())],
                names=["row", "vec_id", "size", "v"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "row long, vec_id long, size int, v binary")


class Tree:
    """A KD-tree in arrays: node boxes, children (-1: leaf) and its range of rows."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, v: np.ndarray):
        order, nodes = np.arange(len(v)), []
        low, high, left, right = [], [], [], []

        def box(a: int, b: int) -> int:
            nodes.append((a, b))
            part = v[order[a:b]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            left.append(-1)
            right.append(-1)
            return len(nodes) - 1

        todo = [box(0, len(v))]
        while todo:
            at = todo.pop()
            a, b = nodes[at]
            wide = int((high[at] - low[at]).argmax()) if v.shape[1] else 0
            if b - a <= LEAF or not v.shape[1] or high[at][wide] == low[at][wide]:
                continue
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(v[order[a:b], wide], middle, kind="introselect")]
            left[at], right[at] = box(a, a + middle), box(a + middle, b)
            todo += [left[at], right[at]]
        self.rows, self.ids, self.v = rows[order], ids[order], v[order]
        self.low, self.high = np.array(low), np.array(high)
        self.left, self.right, self.nodes = left, right, nodes

    def search(self, rows: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Up to k rows at or above its least score for each query: its place in the block, score and vec_id.

        A block of queries goes through the tree together: each goes down to one leaf by the
        better child first, then nodes come best bound first, each with the queries whose k-th
        score so far is within its bound.
        """
        top = max(int(np.abs(self.v).max(initial=0)), 1) * max(int(np.abs(q).max(initial=0)), 1) * max(1, self.v.shape[1])
        kind = next((x for x, most in ((np.float32, 1 << 24), (np.float64, 1 << 53), (np.int64, 1 << 62)) if top < most), object)
        none = _LEAST if kind is np.int64 else -math.inf
        v, qs = self.v.astype(kind), q.astype(kind)
        bounds = np.maximum(qs, 0) @ self.high.astype(kind).T + np.minimum(qs, 0) @ self.low.astype(kind).T
        kth = least.astype(kind)
        kth[least == _LEAST] = none
        tops = np.full((len(q), k), none, dtype=kind)
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def cut() -> None:
            at, score, j = (np.concatenate(x) for x in zip(*best, strict=True))
            order = np.lexsort((self.rows[j], self.ids[j], -score, at))
            at, score, j = at[order], score[order], j[order]
            stays = (np.arange(len(at)) - np.searchsorted(at, at) < k) & (score >= kth[at])
            best[:] = [(at[stays], score[stays], j[stays])]

        def opened(leaf: int, asks: np.ndarray) -> None:
            a, b = self.nodes[leaf]
            for a in range(a, b, LEAF):  # a leaf of equal rows may be long
                part = slice(a, min(b, a + LEAF))
                scores = qs[asks] @ v[part].T
                i, j = np.divmod(np.flatnonzero(scores >= kth[asks][:, None]), scores.shape[1])
                own = self.rows[a + j] == rows[asks[i]]
                scores[i[own], j[own]] = none
                i, j = i[~own], j[~own]
                if not len(i):
                    continue
                best.append((asks[i], scores[i, j], a + j))
                some = np.unique(i)
                several = np.concatenate([tops[asks[some]], scores[some]], axis=1)
                tops[asks[some]] = several = np.partition(several, several.shape[1] - k, axis=1)[:, -k:]
                kth[asks[some]] = np.maximum(kth[asks[some]], several[:, 0])
                if sum(len(x[0]) for x in best) > 8 * LEAF * BLOCK_ROWS:
                    cut()

        left, right, everyone = np.array(self.left), np.array(self.right), np.arange(len(q))
        down = np.zeros(len(q), dtype=int)
        while (inner := left[down] >= 0).any():
            one, other = left[down], right[down]
            down = np.where(inner, np.where(bounds[everyone, one] >= bounds[everyone, other], one, other), down)
        for leaf in np.unique(down):
            asks = np.flatnonzero((down == leaf) & (bounds[:, leaf] >= kth))
            if len(asks):
                opened(leaf, asks)
        heap = [(-bounds[:, 0].max(initial=none), 0, everyone)]
        while heap:
            _, at, asks = heapq.heappop(heap)
            asks = asks[bounds[asks, at] >= kth[asks]]
            if self.left[at] < 0:
                asks = asks[down[asks] != at]
                if len(asks):
                    opened(at, asks)
            elif len(asks):
                for child in (self.left[at], self.right[at]):
                    heapq.heappush(heap, (-bounds[asks, child].max(), child, asks))
        if not best:
            return (np.zeros(0, np.int64),) * 3
        cut()
        at, score, j = best[0]
        if kind is object:
            score = np.array([max(_LEAST, min(_LAST, x)) for x in score], dtype=np.int64)
        return at, score.astype(np.int64), self.ids[j]


def _matrix(vectors: list[pa.Array], size: int) -> np.ndarray:
    return np.concatenate([bytes_of(x)[0] for x in vectors]).view("<i8").reshape(sum(map(len, vectors)), size)


class Lane:
    """The queries of a lane and the k best rows of the shards that they have met, as flat arrays by query."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, least: np.ndarray, q: np.ndarray, k: int):
        self.rows, self.ids, self.least, self.q, self.k = rows, ids, least.copy(), q, k
        self.best = (np.zeros(0, np.int64),) * 3

    def meet(self, tree: Tree) -> None:
        """Searches a shard; the k-th score so far bounds the next one's search."""
        new = [self.best]
        for a in range(0, len(self.q), BLOCK_ROWS):
            b = a + BLOCK_ROWS
            at, score, ids = tree.search(self.rows[a:b], self.q[a:b], self.least[a:b], self.k)
            new.append((a + at, score, ids))
        at, score, ids = (np.concatenate(x) for x in zip(*new, strict=True))
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        self.best = tuple(x[place < self.k] for x in (at, score, ids))
        last = place == self.k - 1
        self.least[at[last]] = np.maximum(self.least[at[last]], score[last])

    def found(self) -> pa.RecordBatch:
        at, score, ids = self.best
        return pa.record_batch(
            [pa.array(self.rows[at]), pa.array(self.ids[at]), pa.array(ids, mask=ids == _LAST), pa.array(score)],
            names=["row", "query_id", "vec_id", "score"])


def _searched(queries: DataFrame, members: DataFrame, lanes: int, k: int) -> DataFrame:
    """query row and id, vec_id and score of the k best that each lane's queries find in its shards."""
    common = ["lane", "shard", "size", "row", "vec_id", "v"]
    met = queries.withColumn("shard", F.lit(-1)).select(*common, "least").unionByName(
        members.select(*common).withColumn("least", F.lit(_LEAST)))
    met = met.repartitionById(min(lanes, TASKS), F.col("lane")).sortWithinPartitions("lane", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, lane = None, [], None

        def whole() -> Iterator[pa.RecordBatch]:
            """Works on the queries or the shard that have come whole; yields a lane that ends."""
            nonlocal lane
            if not parts:
                return
            rows, least = (np.concatenate([column(x, c).to_numpy() for x in parts]) for c in ("row", "least"))
            ids = np.concatenate([column(x, "vec_id").fill_null(_LAST).to_numpy() for x in parts])
            v = _matrix([column(x, "v") for x in parts], column(parts[0], "size")[0].as_py())
            if last[1] < 0:
                if lane:
                    yield lane[1].found()
                lane = last[0], Lane(rows, ids, least, v, k)
            elif lane and lane[0] == last[0]:
                lane[1].meet(Tree(rows, ids, v))

        for batch in batches:
            keys = np.stack([column(batch, c).to_numpy() for c in ("lane", "shard")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if last != tuple(keys[a].tolist()):
                    yield from whole()
                    last, parts = tuple(keys[a].tolist()), []
                parts.append(batch.slice(a, b - a))
        yield from whole()
        if lane:
            yield lane[1].found()

    return met.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id and score: the k best of every query (ids divisible by ``every``)."""
    rows = kept(whole_numbers(vectors), "vectors")
    asks = F.col("vec_id") % every == 0
    sizes = [r for r in rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if(asks).alias("asked")).orderBy("size").collect() if r["asked"]]
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not sizes:
        return empty
    spread = F.xxhash64("row")

    def per_size(numbers: list[int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for r, number in zip(sizes, numbers, strict=True) for x in (r["size"], number)]), F.col("size"))

    def lanes_from(first: list[int], lane: Column) -> Column:
        return (per_size(first) + lane).cast("int")

    def each(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))

    def starts(lanes: list[int]) -> list[int]:
        return list(accumulate(lanes, initial=0))[:-1]

    rows = rows.where(F.col("size").isin([r["size"] for r in sizes]))
    shards = [-(-r["n"] // SHARD_ROWS) for r in sizes]
    members = rows.withColumn("shard", F.pmod(spread, per_size(shards)).cast("int"))
    queries = rows.where(asks)

    chunks = [-(-r["asked"] // CHUNK_ROWS) for r in sizes]
    first = starts(chunks)
    found = kept(_searched(
        queries.withColumn("lane", lanes_from(first, F.pmod(spread, per_size(chunks)))).withColumn("least", F.lit(_LEAST)),
        members.where(F.col("shard") == 0).withColumn("chunk", each(per_size(chunks))).withColumn("lane", lanes_from(first, F.col("chunk"))),
        sum(chunks), k), "first")
    every_one = found
    if max(shards) > 1:
        least = found.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(_LEAST)).alias("least"))
        asked = queries.join(least.hint("merge"), "row", "left").withColumn("least", F.coalesce("least", F.lit(_LEAST)))
        in_group = [max(1, -(-(n - 1) // GROUPS)) for n in shards]
        groups = [-(-(n - 1) // m) for n, m in zip(shards, in_group, strict=True)]
        parts = [max(1, -(-r["asked"] * r["size"] * 8 // PART_BYTES)) for r in sizes]
        lanes = [g * p for g, p in zip(groups, parts, strict=True)]
        first = starts(lanes)
        part = F.pmod(spread, per_size(parts))
        every_one = found.unionByName(_searched(
            asked.where(per_size(groups) > 0).withColumn("group", each(per_size(groups))).withColumn("lane", lanes_from(first, part * per_size(groups) + F.col("group"))),
            members.where(F.col("shard") > 0).withColumn("part", each(per_size(parts)))
            .withColumn("lane", lanes_from(first, F.col("part") * per_size(groups) + F.floor((F.col("shard") - 1) / per_size(in_group)))),
            sum(lanes), k))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return every_one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same for DuckDB.
ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
), t AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS "rank" FROM s
)
SELECT query_id, "rank", vec_id, score FROM t WHERE "rank" <= 5
"""
