"""Language identification with error-correcting output codes.

Every language has a codeword of -1 and +1. For each bit a binary classifier over hashed
byte n-grams is learned; a text's predicted bits are compared with all codewords by a
loss that weighs each bit by how well it did on the language, and the nearest codeword
gives the language. A small lead over the second codeword is flagged as ambiguous.

Defined results: ``und`` with score 0 where the text is null or has no letter; ties go to
the language first in order; rows are judged one by one, repeated or not; with no learned
language everything is ``und``. Extra columns of any name are ignored.
"""

from __future__ import annotations

import dataclasses
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import bytes_of, column, filtered, held_out, pieces

#: Bounds of the rows that the classifiers are fitted on.
PER_LANGUAGE, SAMPLE_ROWS = 400, 2_000
#: Share of likelihood by which the best language leads the second, below which it is ambiguous.
LEAD = 0.1
BUCKETS, ORDERS = 1 << 12, (2, 3, 4)
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
for _c in range(97, 123):
    _FOLD[_c] = _FOLD[_c - 32] = _c
_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_LETTER.search(text)) or any(map(str.isalpha, text)))


def features(texts: pa.Array) -> np.ndarray:
    """Square roots of the shares of hashed n-grams, one row per text."""
    flat, offsets = bytes_of(texts)
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS)
    if len(flat):
        t = _FOLD[flat]
        owner = np.repeat(np.arange(n), np.diff(offsets))
        for k in ORDERS:
            if len(t) < k:
                continue
            code = np.full(len(t) - k + 1, 0x9E3779B1 * k & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(k):
                code = (code ^ t[i:len(t) - k + 1 + i]) * np.uint32(0x01000193)
            code = (code ^ (code >> 15)) * np.uint32(0x85EBCA6B)
            inside = owner[:len(code)] == owner[k - 1:]
            cell = owner[:len(code)] * BUCKETS + (code >> 20)
            counts += np.bincount(cell[inside], minlength=n * BUCKETS)
    x = counts.reshape(n, BUCKETS)
    return np.sqrt(x / np.maximum(1, x.sum(axis=1, keepdims=True))).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Rows of -1 and +1: all splits for few languages, else random ones far apart."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 5:
        splits = [[1 if k >> i & 1 else -1 for i in range(n)] for k in range(1, 1 << (n - 1))]
        return np.array(splits).T.astype(float)
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, far = None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        near = ((width - code @ code.T) / 2 + np.eye(n) * width).min()
        if near > far:
            best, far = code, near
    return best


@dataclasses.dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    bit_weights: np.ndarray
    slopes: np.ndarray
    offsets: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Each row's weighed loss against each language's codeword."""
        f = np.clip(x @ self.slopes + self.offsets, -3, 3)
        return (self.bit_weights[None] * np.exp(-f[:, None, :] * self.code[None])).sum(axis=2)

    def blank_loss(self) -> float:
        """Least loss of a text with no n-gram at all; one language alone tells nothing apart."""
        return float(self.losses(np.zeros((1, BUCKETS))).min()) if len(self.languages) > 1 else math.inf

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of likelihood and its lead over the second, per row."""
        if len(self.languages) < 2:
            return np.zeros(len(x), dtype=int), np.ones(len(x)), np.ones(len(x))
        loss = self.losses(x)
        likely = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
        likely /= likely.sum(axis=1, keepdims=True)
        two = np.sort(likely, axis=1)[:, -2:]
        return loss.argmin(axis=1), two[:, 1], two[:, 1] - two[:, 0]


def _ridge(x: np.ndarray, y: np.ndarray, strength: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Least squares for all bits at once, solved among the rows, which are few."""
    middle, mean = x.mean(axis=0), y.mean(axis=0)
    xc = x - middle
    dual = np.linalg.solve(xc @ xc.T + strength * np.eye(len(x)), y - mean)
    slopes = xc.T @ dual
    return slopes, mean - middle @ slopes


def fit(x: np.ndarray, names: list[str]) -> Model:
    """Classifiers of all bits; a bit's weight for a language is its accuracy on rows it didn't learn from."""
    languages = sorted(set(names))
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.ones(code.shape), np.zeros((BUCKETS, 0)), np.zeros(0))
    at = np.array([languages.index(v) for v in names])
    y, right = code[at], np.zeros(code.shape)
    half = np.arange(len(at)) % 2
    for part in (0, 1):
        if len(set(at[half == part])) == len(languages):
            slopes, offset = _ridge(x[half == part], y[half == part])
            hit = np.sign(x[half != part] @ slopes + offset) == y[half != part]
            np.add.at(right, at[half != part], hit)
    weights = (right + 1) / (np.bincount(at, minlength=len(languages))[:, None] + 1)
    weights /= weights.sum(axis=1, keepdims=True)
    return Model(languages, code, weights, *_ridge(x, y))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from a bounded sample of documents with a language that are not held out.

    Every language gives its first ``per_language`` ids by hash; languages take turns up
    to ``sample_rows``, so a rare one isn't crowded out. Ranks are first taken in 64 parts of
    a language, so that a language with most of the rows meets in no single task. Whole
    texts of the sample are used.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    first = Window.partitionBy("y", F.pmod(F.col("h"), F.lit(64))).orderBy("h", "id")
    turn = Window.partitionBy("y").orderBy("h", "id")
    chosen = (
        known.select(F.col("doc_id").alias("id"), F.col("lang").alias("y"), F.xxhash64("doc_id").alias("h"))
        .withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= per_language)
        .withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= per_language)
        .orderBy("turn", "y").limit(sample_rows).select("id", "y").dropDuplicates()
    )
    joined = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("y"), "text").join(F.broadcast(chosen), ["id", "y"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            keep = [has_letter(t) for t in column(part, "text").to_pylist()]
            part = part.filter(pa.array(keep))
            x = features(column(part, "text"))
            yield pa.record_batch(
                [column(part, "id"), column(part, "y"), pa.array([r.tobytes() for r in x.astype(np.float16)], type=pa.binary())],
                names=["id", "y", "x"])

    rows = (
        joined.select("id", "y", "text").mapInArrow(grams, "id long, y string, x binary").dropDuplicates()
        .orderBy(F.xxhash64("id"), "id", "y", "x").limit(sample_rows).select("y", "x").collect()
    )
    x = np.array([np.frombuffer(r.x, dtype=np.float16) for r in rows], dtype=float).reshape(len(rows), BUCKETS)
    return fit(x, [r.y for r in rows])


def judge(texts: pa.Array, model: Model, lead: float) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    if model.languages:
        best, score, margin = model.decode(features(texts))
    else:
        best, score, margin = np.zeros(len(texts), dtype=int), np.zeros(len(texts)), np.zeros(len(texts))
    letters = np.array([has_letter(t) for t in texts.to_pylist()], dtype=bool) & bool(model.languages)
    names = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters, strict=True)]
    return names, np.where(letters, score, 0.0), ~letters | (margin < lead)


def predict(docs: DataFrame, model: Model, lead: float = LEAD) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            names, score, unsure = judge(column(part, "text"), model, lead)
            yield pa.record_batch(
                [column(part, "doc_id"), column(part, "held_out"), pa.array(names, type=pa.string()), pa.array(score), pa.array(unsure)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    chosen = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return chosen.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_known(docs: DataFrame, model: Model, lead: float = 0.0, loss: float = math.inf) -> DataFrame:
    """The documents whose language was found, with all their columns; ``und`` ones go.

    So do those whose language leads the second by less than ``lead``, and those whose loss
    reaches ``loss``: with ``model.blank_loss()``, texts that are no nearer to a learned
    language than an empty one. Where no language could be learned all documents stay.
    """
    if not model.languages:
        return docs

    def known(texts: pa.Array) -> np.ndarray:
        out = []
        for part in pieces([pa.record_batch([texts], names=["t"])], "t"):
            letters = np.array([has_letter(t) for t in part.column(0).to_pylist()], dtype=bool)
            if len(model.languages) > 1:
                x = features(part.column(0))
                letters &= (model.decode(x)[2] >= lead) & (model.losses(x).min(axis=1) < loss)
            out.append(letters)
        return np.concatenate([np.zeros(0, dtype=bool), *out])

    return filtered(docs, "text", known)
