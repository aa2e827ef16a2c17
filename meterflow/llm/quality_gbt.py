"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a bounded sample of labelled documents are gathered by Spark tasks, binned
to histograms, and boosted trees are fitted on them; the trees are flattened into arrays
so that a batch of documents walks all of them with a few numpy steps.

Defined results: null and empty texts have all statistics zero and get the score of that
row; repeated rows are scored one by one; without any label every score is 0.5; with one
class only, its share, smoothed. Extra columns of any name are ignored.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import column, filtered, held_out, pieces

#: Labelled rows that the trees are fitted on at most; they are the first by hash of id.
SAMPLE_ROWS = 20_000

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[np.frombuffer(b"#*$%&|<>{}[]\\^~=_@/+", dtype=np.uint8)] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[np.frombuffer(b".,;:!?'\"()-", dtype=np.uint8)] = True
_BYTES = np.arange(256)
_UPPER, _LOWER = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT, _HIGH, _LEAD = (_BYTES >= 48) & (_BYTES <= 57), _BYTES >= 128, (_BYTES & 0xC0) == 0xC0
_SPACE = np.isin(_BYTES, (9, 10, 11, 12, 13, 32))
_ENDS = re.compile(rb"[.!?]+(?=\s|$)")

STATISTICS = (
    "log_words", "mean_word", "sd_word", "distinct_words", "top_word", "same_as_last",
    "distinct_pairs", "short_words", "long_words", "upper_words", "title_words", "words_with_symbol",
    "plain_words", "symbols", "punctuation", "upper", "lower", "digits", "other_letters", "spaces",
    "bar", "bang", "byte_entropy", "lines", "repeated_lines", "mean_line", "sentence_words", "top_three",
)


def statistics(text: bytes) -> list[float]:
    """Figures of a whole text; shares lie in 0 to 1."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    share = counts[counts > 0] / size
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    of = Counter(words)
    top = [c for _, c in of.most_common(3)]
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = sum(map(bytes.__eq__, words, words[1:]))
    alpha = [w.rstrip(b".,;:!?") for w in words]
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = len(_ENDS.findall(text))
    return [
        float(np.log1p(n)), lengths.mean(), lengths.std(), len(of) / n, top[0] / n, same / n,
        pairs / max(1, n - 1), (lengths <= 2).mean(), (lengths >= 15).mean(),
        sum(map(bytes.isupper, words)) / n, sum(map(bytes.istitle, words)) / n,
        1 - sum(w.isalpha() or not w.isascii() for w in alpha) / n,
        sum(map(bytes.isalpha, words)) / n,
        counts[_SYMBOLS].sum() / size, counts[_PUNCTUATION].sum() / size, counts[_UPPER].sum() / size,
        counts[_LOWER].sum() / size, counts[_DIGIT].sum() / size, counts[_HIGH].sum() / size,
        counts[_SPACE].sum() / size, counts[124] / size, counts[33] / size,
        float(-(share * np.log2(share)).sum()), len(lines) / n, 1 - len(set(lines)) / len(lines),
        float(np.log1p(sum(map(len, lines)) / len(lines))), float(np.log1p(n / (1 + ends))), sum(top) / n,
    ]


@dataclasses.dataclass
class Trees:
    """All trees in flat arrays; a leaf points to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of label 1, for each row; every step moves all rows in all trees one level down."""
        if not len(x):
            return np.zeros(0)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        raw = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 50, depth: int = 4, bins: int = 64,
    rate: float = 0.15, least: int = 10, ridge: float = 1.0,
) -> Trees:
    """Boosted trees with logistic loss; splits are searched on histograms of binned values."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: list[tuple[int, float, int, int, float]] = []
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
        width = max(len(c) for c in cuts) + 1
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        raw = np.full(n, base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-6)
            roots.append(len(nodes))
            nodes.append((0, np.inf, roots[-1], roots[-1], 0.0))
            todo = [(roots[-1], np.arange(n), 0)]
            while todo:
                at, rows, level = todo.pop()
                g, h = gradient[rows].sum(), hessian[rows].sum()
                best = None
                if level < depth and len(rows) >= 2 * least:
                    cell = (binned[rows] + np.arange(m) * width).ravel()
                    gs = np.bincount(cell, np.repeat(gradient[rows], m), m * width).reshape(m, width).cumsum(1)[:, :-1]
                    hs = np.bincount(cell, np.repeat(hessian[rows], m), m * width).reshape(m, width).cumsum(1)[:, :-1]
                    ns = np.bincount(cell, minlength=m * width).reshape(m, width).cumsum(1)[:, :-1]
                    gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                    gain[(ns < least) | (len(rows) - ns < least)] = -np.inf
                    k = int(gain.argmax())
                    if gain.flat[k] > 1e-6:
                        best = divmod(k, width - 1)
                if best is None:
                    value = -rate * g / (h + ridge)
                    nodes[at] = (0, np.inf, at, at, float(value))
                    raw[rows] += value
                    continue
                j, b = best
                goes = binned[rows, j] <= b
                left, right = len(nodes), len(nodes) + 1
                nodes[at] = (j, float(cuts[j][b]), left, right, 0.0)
                for child, part in ((left, rows[goes]), (right, rows[~goes])):
                    nodes.append((0, np.inf, child, child, 0.0))
                    todo.append((child, part, level + 1))
    f, t, le, ri, v = (np.array(c) for c in zip(*nodes, strict=True)) if nodes else (np.zeros(0),) * 5
    return Trees(base, np.array(roots, dtype=np.int32), f.astype(np.int32), t.astype(float), le.astype(np.int32),
                 ri.astype(np.int32), v.astype(float), depth)


def matrix(texts: pa.Array) -> np.ndarray:
    rows = [statistics((t or "").encode()) for t in texts.to_pylist()]
    return np.array(rows, dtype=float).reshape(len(rows), len(STATISTICS))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on at most ``sample_rows`` labelled documents that are not held out.

    The sample is chosen among the labels by hash, so it is bounded before it meets the
    documents; only its documents' statistics come to the driver.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
        .dropDuplicates().orderBy(F.xxhash64("id"), "id", "y").limit(sample_rows)
    )
    joined = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id")

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            x = matrix(column(part, "text"))
            yield pa.record_batch(
                [column(part, "id"), column(part, "y"), pa.array(list(x), type=pa.list_(pa.float64()))],
                names=["id", "y", "x"])

    rows = (
        joined.select("id", "y", "text").mapInArrow(figures, "id long, y int, x array<double>")
        .dropDuplicates().orderBy(F.xxhash64("id"), "id", "y", "x").limit(sample_rows).select("y", "x").collect()
    )
    x = np.array([r.x for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r.y for r in rows], dtype=float))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            p = trees.probability(matrix(column(part, "text")))
            yield pa.record_batch(
                [column(part, "doc_id"), column(part, "held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return chosen.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, trees: Trees, least: float = 0.5) -> DataFrame:
    """The documents with a score of at least ``least``, with all their columns."""
    return filtered(docs, "text", lambda texts: trees.probability(matrix(texts)) >= least)
