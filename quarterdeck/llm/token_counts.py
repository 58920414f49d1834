"""Tokens of the sections of documents, by joining the character spans of both.

Every text is encoded once, whole; its tokens' character spans are joined with the spans of its
sections. A token inside a section counts there. One that crosses a boundary is allotted by a rule:

* ``first``: to the section that holds its first character;
* ``most``: to the section that holds most of its characters, the earlier one in a tie;
* ``split``: to each section by the share of its characters there.

Under ``first`` and ``most`` the counts of sections that cover a text add up to its tokens exactly;
under ``split`` they do so but for rounding. Tokens over no section count as outside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.tokenizing import encoder

VOCABULARY = "byte_bpe_50k.json"
RULES = ("first", "most", "split")


def line_sections(text: str) -> np.ndarray:
    """(first, past the last) code point of every line; a line has the ``\\n`` that ends it. A text
    without any character has one empty section."""
    lines = text.split("\n")
    if len(lines) > 1 and not lines[-1]:
        lines.pop()
    ends = np.minimum(np.cumsum([len(line) + 1 for line in lines]), len(text))
    return np.stack([np.concatenate([[0], ends[:-1]]), ends], axis=1)


def attribute(tokens: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens of each section, how many of the section's tokens cross a boundary, and tokens of
    none. ``sections`` are sorted and do not overlap; gaps are allowed."""
    n = len(sections)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not len(tokens) or not n:
        return counts, crossing, float(len(tokens))
    start, stop = tokens[:, 0].astype(np.int64), np.maximum(tokens[:, 1], tokens[:, 0] + 1).astype(np.int64)
    # sections a token overlaps: from the first that ends after its start to the last that begins before its end
    first = np.searchsorted(sections[:, 1], start, side="right")
    last = np.searchsorted(sections[:, 0], stop, side="left") - 1
    many = np.maximum(last - first + 1, 0)
    token = np.repeat(np.arange(len(start)), many)
    section = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    begin = np.maximum(start[token], sections[section, 0])
    share = np.minimum(stop[token], sections[section, 1]) - begin
    kept = share > 0  # an empty section overlaps nothing
    token, section, share, begin = token[kept], section[kept], share[kept], begin[kept]
    inside = share == (stop - start)[token]
    crossing = np.bincount(section[~inside], minlength=n)
    if rule == "split":
        counts = np.bincount(section, share / (stop - start)[token], n)
    else:
        if rule == "first":
            chosen = begin == start[token]
        else:
            order = np.lexsort((section, -share, token))
            chosen = np.zeros(len(token), bool)
            chosen[order[np.flatnonzero(np.diff(token[order], prepend=-1))]] = True
        counts = np.bincount(section[chosen], minlength=n).astype(float)
    return counts, crossing, float(len(tokens) - counts.sum())


def _count(vocabulary: str, rule: str, own_sections: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            rows: list[int] = []
            parts: list[np.ndarray] = []
            texts = batch.column("text").to_pylist()
            given = batch.column("sections").to_pylist() if own_sections else [None] * len(texts)
            texts = [t or "" for t in texts]
            encoded = (own.spans([t])[0] for t in texts)
            for i, (text, at, tokens) in enumerate(zip(texts, given, encoded, strict=True)):
                if own_sections:
                    valid = sorted((s["start"], s["stop"]) for s in at or [] if s and None not in (s["start"], s["stop"]))
                    sections = np.array(valid, np.int64).reshape(-1, 2)
                else:
                    sections = line_sections(text)
                counts, crossing, outside = attribute(tokens, sections, rule)
                n = len(sections)
                whole = np.full(n, float(len(tokens)))
                parts.append(np.column_stack([np.arange(n), sections, counts, crossing, whole, np.full(n, outside)]))
                rows.extend([i] * n)
            table = np.concatenate(parts) if parts else np.zeros((0, 7))
            ints = lambda j: pa.array(table[:, j].astype(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    "section": ints(0),
                    "start": ints(1),
                    "stop": ints(2),
                    "tokens": pa.array(table[:, 3]),
                    "crossing": ints(4),
                    "doc_tokens": ints(5),
                    "outside": pa.array(table[:, 6]),
                }
            )

    return count


def section_tokens(
    docs: DataFrame, sections: str | None = None, rule: str = "first", doc_id: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """A row for each section: ``doc_id, section`` (from 0, by place), ``start, stop`` (code points),
    ``tokens`` allotted to it, how many tokens over it are ``crossing`` a boundary, ``doc_tokens`` and
    ``outside`` (the document's tokens in all, and over no section).

    ``sections`` names a column of array<struct<start, stop>> whose spans do not overlap; without it
    the sections are the lines. Null and empty texts have no tokens and one empty line. Repeated rows
    count each for itself; null spans are skipped; a row without spans gives no row; other columns are
    ignored. No shuffle: a document's tokens never leave its task.
    """
    if rule not in RULES:
        raise ValueError(f"rule has to be one of {RULES}")
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    if sections:
        spans = F.transform(F.col(sections), lambda s: F.struct(s["start"].cast("long").alias("start"), s["stop"].cast("long").alias("stop")))
        columns.append(spans.alias("sections"))
    narrow = docs.select(*columns)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, section long, start long, stop long, tokens double, crossing long, doc_tokens long, outside double"
    )
    return narrow.mapInArrow(_count(vocabulary, rule, sections is not None), schema)
