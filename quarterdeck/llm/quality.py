"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its hashed words (logarithms of their counts, scaled to length one),
and a one for the bin of every structure statistic. The score is linear terms plus all pairwise
interactions through factors, by the identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``,
so it takes time linear in the distinct words.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.features import STRUCTURE, held_out, labelled, structure

# Labelled documents to learn from, about; buckets of hashed words; bins of a statistic; factors.
TRAIN_ROWS = 12_000
BUCKETS = 1 << 13
BINS = 10
FACTORS = 8
# Share of a vector's length that words make up: statistics tell more than single words.
WORD_SCALE = 0.5
REMEMBERED = 300_000


class Buckets(dict):
    """The bucket of a word without its case and outer punctuation, remembered for a while."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = bucket = zlib.crc32(word.lower().strip(".,;:!?\"'()").encode()) % BUCKETS
        return bucket


def sparse(text: str, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets and values of a whole text's words, and its structure statistics."""
    words = text.split()
    counts = Counter(words)
    stats = structure(text, words, counts)
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), stats
    at = np.fromiter(map(buckets.__getitem__, counts), np.int64, len(counts))
    total = np.bincount(at, np.fromiter(counts.values(), np.float64, len(counts)))
    held = np.flatnonzero(total)
    value = np.log1p(total[held])
    return held.astype(np.int32), (WORD_SCALE * value / np.linalg.norm(value)).astype(np.float32), stats


@dataclass
class Machine:
    cuts: list[np.ndarray]
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, parts: list[tuple[np.ndarray, np.ndarray, list[float]]]):
        """All features of several documents, one after another, and where each document starts."""
        stats = np.array([p[2] for p in parts])
        width = BINS + 1
        binned = np.stack([np.searchsorted(c, stats[:, j]) for j, c in enumerate(self.cuts)], axis=1)
        binned = BUCKETS + np.arange(len(self.cuts)) * width + binned
        ones = np.full(len(self.cuts), 1 / np.sqrt(len(self.cuts)), np.float32)
        at = np.concatenate([x for p, b in zip(parts, binned, strict=True) for x in (p[0], b)])
        value = np.concatenate([x for p in parts for x in (p[1], ones)])
        starts = np.cumsum([0, *[len(p[0]) + len(ones) for p in parts[:-1]]])
        return at, value, starts

    def raw(self, at: np.ndarray, value: np.ndarray, starts: np.ndarray):
        """Log-odds in linear time, and the sums of the factors that training needs again."""
        vx = self.factors[at] * value[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx**2).sum(axis=1), starts)
        linear = np.add.reduceat(self.linear[at] * value, starts)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums, vx


def fit_machine(
    parts: list[tuple[np.ndarray, np.ndarray, list[float]]], y: np.ndarray,
    epochs: int = 12, least_steps: int = 800, batch: int = 128, rate: float = 0.08, l2: float = 1e-4,
) -> Machine:
    """Adagrad on the logistic loss, over the same shuffles in every run. Small samples are gone
    through more often, until ``least_steps`` batches."""
    rng = np.random.default_rng(0)
    stats = np.array([p[2] for p in parts])
    levels = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = [np.unique(np.quantile(stats[:, j], levels)) for j in range(stats.shape[1])]
    size = BUCKETS + len(cuts) * (BINS + 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    m = Machine(cuts, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.1, (size, FACTORS)))
    seen_linear, seen_factors, seen_bias = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 1e-2
    for _ in range(max(epochs, -(-least_steps * batch // len(parts)))):
        order = rng.permutation(len(parts))
        for i in range(0, len(order), batch):
            chosen = order[i : i + batch]
            at, value, starts = m.rows([parts[j] for j in chosen])
            raw, sums, vx = m.raw(at, value, starts)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[chosen]) / len(chosen)
            row = np.repeat(np.arange(len(chosen)), np.diff([*starts, len(at)]))
            held, where = np.unique(at, return_inverse=True)
            g1 = np.bincount(where, slope[row] * value, len(held)) + l2 * m.linear[held]
            each = (slope[row] * value)[:, None] * (sums[row] - vx)
            g2 = np.stack([np.bincount(where, each[:, f], len(held)) for f in range(FACTORS)], axis=1)
            g2 += l2 * m.factors[held]
            seen_linear[held] += g1**2
            seen_factors[held] += g2**2
            seen_bias += slope.sum() ** 2
            m.linear[held] -= rate * g1 / np.sqrt(seen_linear[held])
            m.factors[held] -= rate * g2 / np.sqrt(seen_factors[held])
            m.bias -= rate * slope.sum() / np.sqrt(seen_bias)
    return m


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for batch in batches:
        parts = [sparse(t or "", buckets) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "label": batch.column("label"),
                "part": pa.array([pickle.dumps(p) for p in parts], pa.binary()),
            }
        )


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, **names: str) -> Machine | float:
    """The machine, learned from about ``rows`` labelled documents outside the held-out fold; the
    driver sees their vectors, not their texts. Without rows of both labels: the share of label 1,
    or a half."""
    sample = labelled(docs, labels, "quality", 3, 1, rows, **names)
    id_type = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(_examples, f"doc_id {id_type}, label int, part binary").collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r.part)))
    y = np.array([r.label for r in got], float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit_machine([pickle.loads(r.part) for r in got], y)


def _scored(model):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, buckets = pickle.loads(model.value), Buckets()
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            if isinstance(m, float):
                score = np.full(len(texts), m)
            else:
                score = np.zeros(len(texts))
                for i in range(0, len(texts), 256):
                    own = [sparse(t or "", buckets) for t in texts[i : i + 256]]
                    score[i : i + 256] = 1 / (1 + np.exp(-np.clip(m.raw(*m.rows(own))[0], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(score, pa.float64())], names=["_row", "_score"]
            )

    return scored


def with_scores(rows: DataFrame, model: Machine | float) -> DataFrame:
    """(``_row``, ``_score``) for (``_row``, ``_text``)."""
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    row = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(_scored(shared), f"_row {row}, _score double")


def quality_report(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Labels are learned only from rows outside the held-out fold (crc32 of the id as text, modulo 3,
    is 1); scores come from the text alone. Null and empty texts have a score too; repeated rows
    score alike; other columns are ignored; no rows give no rows.
    """
    model = fit(docs, labels, doc_id=doc_id, text=text)
    rows = docs.select(F.struct(F.col(doc_id).alias("doc_id")).alias("_row"), F.col(text).alias("_text"))
    return (
        with_scores(rows, model)
        .select(F.col("_row.doc_id").alias("doc_id"), F.col("_score").alias("score"))
        .select(
            "doc_id",
            held_out("doc_id", 3, 1).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
