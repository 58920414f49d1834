"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words and word beginnings that labelled toxic documents hold far more often
than others, beside a short fixed list. One part of the labelled sample gives the lexicon, another
grows the trees, a third calibrates, so none of them judges what it has seen.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.boosting import fit_boosted, fit_isotonic
from quarterdeck.llm.features import STRUCTURE, blocks, held_out, labelled, structure

# Labelled documents to learn from, about; entries of the learned lexicon; words remembered by a task,
# and keys that it counts before it hands the counts on.
TRAIN_ROWS = 20_000
LEXICON = 4_000
REMEMBERED = 300_000
COUNTED = 100_000

# Common insults, and words that address the reader, in the four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid scum trash clown pathetic worthless loser losers disgusting dumb "
    "dummkopf trottel idiotisch abschaum imbécile connard crétin ordure idiota imbécil estúpido basura".split()
)
ADDRESS = frozenset("you your you're u ya du dich dir dein ihr euch tu toi te ton vous votre tú ti usted su".split())

STRONG, WEAK, FIXED, SECOND = 1, 2, 4, 8
LETTERS = re.compile(r"[^\W\d_]+(?:[\d@$*!1|_'-]+[^\W\d_]+)*")
HIDDEN = re.compile(r"[\d@$*!|_-]")
FEATURES = (
    *STRUCTURE, "strong", "weak", "fixed", "strong_distinct", "weak_distinct", "second", "near_second",
    "hidden", "any_strong", "any_fixed", "closest_strong",
)
BEGINNINGS = (4, 5, 6)


def keys(word: str) -> list[str]:
    """The word, and its beginnings where it goes on: ``abcd*``."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]]


class Kinds(dict):
    """The kinds of a word, remembered; forgets everything when it has ``REMEMBERED`` words."""

    def __init__(self, strong: frozenset[str], weak: frozenset[str]) -> None:
        self.strong, self.weak = strong, weak

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        own = keys(word)
        kind = STRONG * any(k in self.strong for k in own) | WEAK * any(k in self.weak for k in own)
        kind |= FIXED * (word in INSULTS) | SECOND * (word in ADDRESS)
        self[word] = kind
        return kind


def dense(text: str, kinds: Kinds) -> list[float]:
    """``FEATURES`` of a whole text; all zero without words."""
    words = text.split()
    out = structure(text, words, Counter(words))
    plain = LETTERS.findall(text.lower())
    n = max(1, len(plain))
    of = np.fromiter(map(kinds.__getitem__, plain), np.uint8, len(plain))
    strong, weak, fixed, second = (np.flatnonzero(of & k) for k in (STRONG, WEAK, FIXED, SECOND))
    hits = np.union1d(strong, fixed)
    near = 0
    if len(hits) and len(second):
        right = np.searchsorted(second, hits)
        gap = np.minimum(
            np.abs(second[np.minimum(right, len(second) - 1)] - hits), np.abs(second[np.maximum(right - 1, 0)] - hits)
        )
        near = int((gap <= 4).sum())
    closest = np.diff(strong).min() if len(strong) > 1 else 0
    hidden = sum(1 for w in set(plain) if HIDDEN.search(w))
    return [
        *out, len(strong) / n, len(weak) / n, len(fixed) / n, len({plain[i] for i in strong}),
        len({plain[i] for i in weak}) / n, len(second) / n, near / n, hidden / n, len(strong), len(fixed),
        1 / closest if closest else 0.0,
    ]


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "key": [k for k, _ in found],
            "label": pa.array([v for _, v in found], pa.int32()),
            "n": pa.array(list(found.values()), pa.int64()),
        }
    )


def _holdings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of this task each key is, by label; a key comes again after ``COUNTED`` others."""
    found: Counter = Counter()
    for batch in batches:
        texts, labels = batch.column("text"), batch.column("label")
        for i, j in blocks(texts):
            rows = zip(texts.slice(i, j - i).to_pylist(), labels.slice(i, j - i).to_pylist(), strict=True)
            for text, label in rows:
                words = set(LETTERS.findall(text.lower()))
                found.update((k, label) for k in {k for w in words for k in keys(w)})
                if len(found) >= COUNTED:
                    yield _counted(found)
                    found.clear()
    if found:
        yield _counted(found)


def learn_lexicon(sample: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Strong and weak keys of (text, label): the ``LEXICON`` that tell most, by the odds ratio of
    holding them, among those in three toxic documents or more."""
    counts = sample.groupBy("label").count().collect()
    ones, zeros = (sum(r["count"] for r in counts if r.label == v) for v in (1, 0))
    held = (
        sample.select("text", "label")
        .mapInArrow(_holdings, "key string, label int, n long")
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"),
        )
        .where("a >= 3")
    )
    odds = F.log(((F.col("a") + 0.25) * (zeros - F.col("b") + 0.5)) / ((ones - F.col("a") + 0.5) * (F.col("b") + 0.25)))
    sure = odds - 1.0 / F.sqrt(F.col("a"))
    best = held.withColumn("sure", sure).where("sure > 1.5").orderBy(F.desc("sure"), "key").limit(LEXICON).collect()
    strong = frozenset(r.key for r in best if r.sure > 3 and r.b * 20 <= r.a)
    return strong, frozenset(r.key for r in best) - strong


def _measure(model):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(*model.value)
        for batch in batches:
            texts = batch.column("text")
            for i, j in blocks(texts):
                values = [dense(t or "", kinds) for t in texts.slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(i, j - i),
                        "label": batch.column("label").slice(i, j - i),
                        "part": batch.column("part").slice(i, j - i),
                        "values": pa.array(values, pa.list_(pa.float64())),
                    }
                )

    return measure


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, **names: str) -> dict:
    """The model: lexicon, trees and calibration. At most about ``rows`` documents are learned from;
    the driver sees their features, not their texts. Without rows of both labels the score is the
    share of label 1, or a half."""
    sample = labelled(docs, labels, "toxic", 4, 2, rows, **names)
    lexicon = learn_lexicon(sample.where("part < 500"))
    spark = docs.sparkSession
    id_type = sample.schema["doc_id"].dataType.simpleString()
    rest = sample.where("part >= 500").mapInArrow(
        _measure(spark.sparkContext.broadcast(lexicon)), f"doc_id {id_type}, label int, part int, values array<double>"
    )
    got = sorted(rest.collect(), key=lambda r: (r.doc_id, r.values))
    model: dict = {"lexicon": lexicon, "trees": None}
    y = np.array([r.label for r in got], float)
    if len(set(y.tolist())) < 2:
        model["prior"] = float(y.mean()) if len(y) else 0.5
        return model
    x = np.array([r["values"] for r in got])
    grow = np.array([r.part < 850 for r in got])
    if len(set(y[grow].tolist())) < 2 or len(set(y[~grow].tolist())) < 2:
        grow = np.ones(len(y), bool)
    model["trees"] = fit_boosted(x[grow], y[grow])
    rest_of = ~grow if not grow.all() else grow
    model["points"] = fit_isotonic(model["trees"].raw(x[rest_of]), y[rest_of])
    return model


def score_texts(texts: list[str | None], model: dict, kinds: Kinds) -> np.ndarray:
    if model["trees"] is None:
        return np.full(len(texts), model["prior"])
    if not texts:
        return np.zeros(0)
    raw = model["trees"].raw(np.array([dense(t or "", kinds) for t in texts]))
    return np.interp(raw, *model["points"])


def _scored(model, text: str | None = None):
    """Scores of the rows in ``_row``, from their column ``text``, or beside them from ``_text``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(model.value)
        kinds = Kinds(*own["lexicon"])
        for batch in batches:
            rows = batch.column("_row")
            texts = batch.column("_text") if text is None else rows.field(text)
            for i, j in blocks(texts):
                score = score_texts(texts.slice(i, j - i).to_pylist(), own, kinds)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(i, j - i), pa.array(score, pa.float64())], names=["_row", "_score"]
                )

    return scored


def with_scores(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """(``_row``, ``_score``): every row as a struct, and the probability that it is toxic. Texts go to
    the Python workers once, inside their rows."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    row = packed.schema["_row"].dataType.simpleString()
    return packed.mapInArrow(_scored(shared, text), f"_row {row}, _score double")


def without_toxic(docs: DataFrame, model: dict, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, unchanged."""
    return with_scores(docs, model, text).where(F.col("_score") < threshold).select("_row.*")


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (doc_id, text).

    Labels are learned only from rows outside the held-out fold (crc32 of the id as text, modulo 4,
    is 2); scores come from the text alone. Null and empty texts have a score too; repeated rows
    score alike; other columns are ignored; no rows give no rows.
    """
    model = fit(docs, labels)
    held = F.col("doc_id")
    narrow = docs.select(held.alias("doc_id"), F.col("text"))
    texts = narrow.select(F.struct("doc_id").alias("_row"), F.col("text").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    row = texts.schema["_row"].dataType.simpleString()
    return (
        texts.mapInArrow(_scored(shared), f"_row {row}, _score double")
        .select(F.col("_row.doc_id").alias("doc_id"), F.col("_score").alias("score"))
        .select(
            "doc_id",
            held_out("doc_id", 4, 2).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
        )
    )
