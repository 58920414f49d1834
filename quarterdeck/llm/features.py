"""Numbers that describe a text, for the classifiers; and the labelled rows they learn from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text that a task has as Python strings at a time, about.
BLOCK = 1 << 21
_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "blank": np.isin(_BYTES, list(b" \t\r\x0b\x0c")),
    "newline": _BYTES == 10,
    "stop": np.isin(_BYTES, list(b".,;:")),
    "shout": np.isin(_BYTES, list(b"!?")),
    "bar": np.isin(_BYTES, list(b"|<>{}[]\\/=_")),
    "symbol": np.isin(_BYTES, list(b"#$%&*@^~+-")),
    "quote": np.isin(_BYTES, list(b"\"'`()")),
    "wide": _BYTES >= 128,
}
STRUCTURE = (
    *_CLASSES,
    "log_bytes", "log_words", "word_bytes", "distinct_words", "top_word", "same_as_before",
    "log_lines", "repeated_lines", "line_bytes", "longest_word",
)


def structure(text: str, words: list[str], counts: dict[str, int]) -> list[float]:
    """``STRUCTURE`` of a whole text; all zero without words. ``counts`` counts ``words``."""
    if not words:
        return [0.0] * len(STRUCTURE)
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    found = np.bincount(data, minlength=256)
    n, w = len(data), len(words)
    lines = text.split("\n")
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [
        *[found[of].sum() / n for of in _CLASSES.values()],
        np.log(n), np.log(w), n / w, len(counts) / w, max(counts.values()) / w, repeats / w,
        np.log(len(lines)), 1 - len(set(lines)) / len(lines), np.log(n / len(lines)), np.log(max(map(len, counts))),
    ]


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where runs of successive texts begin and end: those that begin in the same ``BLOCK`` bytes. A batch
    has 10,000 rows of any length, so a task makes strings of a run of it at a time, not of all."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (size.cumsum() - size) // BLOCK
    bounds = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(size)]
    return ((i, j) for i, j in zip(bounds, bounds[1:]) if i < j)


def held_out(doc_id: str, folds: int, fold: int):
    """Whether a row belongs to the fold that is never learned from; null ids count as empty text."""
    as_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % folds == fold


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, text, label, part): about ``rows`` labelled documents outside the held-out fold, all
    of them if there are fewer, chosen by a hash of the id. ``part`` is a hash in 0..999. Labels
    other than 0 and 1 and null ids are left out; of several labels of one id the largest counts,
    of several texts of one id the smallest, so an id is one row however many rows have it."""
    own = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id, folds, fold))
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    n = own.count()
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, rows / max(n, 1)) * (1 << 30))
    few = F.broadcast(own.where(drawn))  # about ``rows`` short rows
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    once = texts.join(few, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return once.withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1000)).cast("int")
    )
