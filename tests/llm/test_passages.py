"""Repeated passages against marking every window that was seen before."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from oracle import connect, oracle_rows, spark_rows
from quarterdeck.llm import passages
from quarterdeck.llm.passages import repeats_report, without_repeats

SCHEMA = "doc_id long, text string"


def expected(texts: list[bytes], length: int = 100) -> list[tuple]:
    """Of texts in order: bytes, removed bytes, spans, hash of the rest."""
    seen, out = set(), []
    for data in texts:
        edges = np.zeros(len(data) + 1, int)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                edges[p] += 1
                edges[p + length] -= 1
            seen.add(window)
        gone = np.cumsum(edges)[: len(data)] > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def told(df) -> list[tuple]:
    return sorted((r[0] is not None, r[0] or 0, *tuple(r)[1:]) for r in df.collect())


def check(spark, rows, length=100, parts=3):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected([(t or "").encode() for _, t in ordered], length)
    df = without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts), length=length)
    got = [
        (r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], sum(s["stop"] - s["start"] for s in r["removed"]),
         len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in df.collect()
    ]
    assert sorted(got) == sorted((i is not None, i or 0, *w) for (i, _), w in zip(ordered, want, strict=True))


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeé漢", k=rng.randint(1, 6))) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("length", [64, 100, 128])
def test_spliced_texts(spark, seed, length):
    """Passages of about the threshold, cut, shifted and repeated within and between texts."""
    rng = random.Random(seed)
    passages_ = [prose(rng, rng.randint(10, 80)) for _ in range(8)]
    rows = []
    for i in range(60):
        text = prose(rng, rng.randint(0, 30))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages_)
            a = rng.randint(0, len(p) // 2)
            text += p[a : rng.randint(a, len(p))] + prose(rng, rng.randint(0, 10))
        rows.append((i * 7 - 100, text))
    check(spark, rows, length)


def test_periodic_and_short_texts(spark):
    rng = random.Random(3)
    long = prose(rng, 200)
    rows = [
        (1, "a" * 500), (2, "ab" * 300), (3, ("x" * 99 + "y") * 5), (4, ""), (5, None), (6, "a" * 99), (7, "b" * 100),
        (8, "ab" * 50 + "c" + "ab" * 60), (9, "\x00" * 120), (None, long), (10, long), (11, long[1:]), (12, long[:-1] + "!"),
    ]
    check(spark, rows)


def test_blocks_of_long_texts(spark):
    """Texts longer than a block of bytes are cut, which changes nothing."""
    rng = random.Random(4)
    base = prose(rng, 120_000)  # over two blocks
    assert len(base.encode()) > 2 * passages.BLOCK
    rows = [(1, base), (2, prose(rng, 50) + base[1000:400_000]), (3, base[-5000:] + prose(rng, 10))]
    check(spark, rows)


def test_equal_rows_and_repeated_ids(spark):
    rng = random.Random(5)
    text, other = prose(rng, 60), prose(rng, 60)
    df = spark.createDataFrame([(1, text)] * 300 + [(1, other)] * 2 + [(2, text), (2, "short")] + [(None, "short")] * 3, SCHEMA)
    got = told(repeats_report(df.repartition(4)))
    assert len(got) == 307
    size = len(text.encode())
    assert [r[3] for r in got if r[2] == size and r[1] == 1].count(0) == 1  # one of the equal rows stays
    assert [r[3] for r in got if r[1] == 2] == [0, size] or [r[3] for r in got if r[1] == 2] == [size, 0]
    assert all(r[3] == 0 for r in got if r[2] == 5)


def test_many_copies_with_other_surroundings(spark):
    """A passage in every text between words of its own: one place stays, the others go to the byte."""
    rng = random.Random(6)
    passage = prose(rng, 40)
    check(spark, [(i, prose(rng, 15) + passage + prose(rng, 15)) for i in range(400)], parts=8)


def test_empty_table_and_extra_columns(spark):
    assert repeats_report(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "x" * 300)], SCHEMA).selectExpr("'a' AS doc", "'b' AS tie", "2 AS first", "*", "0 AS n", "1 AS x")
    assert told(repeats_report(df))[0][:5] == (True, 1, 300, *expected([b"x" * 300])[0][1:3])


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect())
    want = [(True, i, *w) for (i, _), w in zip(rows, expected([t for _, t in rows]), strict=True)]
    assert told(repeats_report(df)) == want


def test_whole_table_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    columns, want = oracle_rows(connect(sf), passages.ORACLE)
    got = repeats_report(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sorted(columns) == sorted(got.columns) and spark_rows(got) == want


def test_length_is_checked(spark):
    with pytest.raises(ValueError):
        without_repeats(spark.createDataFrame([], SCHEMA), length=50)
