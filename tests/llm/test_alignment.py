"""Cross-tokenizer alignment against comparing every token of one with every token of the other."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quarterdeck.llm import alignment as al

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path(al.BYTE_LEVEL))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path(al.PIECES))
    # byte-level entries: printable bytes as themselves, the others from code point 256 on
    own = [x for x in range(256) if 0x21 <= x <= 0x7E or 0xA1 <= x <= 0xAC or x >= 0xAE]
    of = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(own)))}
    return a, b, of


def brute(text, both):
    """Ids and byte ranges of both; none where the bytes differ."""
    a, b, of = both
    if not text:
        return [], [], [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], [], []
    return ids_a, ids_b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()


def cut_at(a, b):
    """Groups by walking through all ends."""
    common = sorted(set(a) & set(b))
    return [(a.index(e) + 1, b.index(e) + 1) for e in common]


def overlapping(a, b):
    ranges = lambda ends: list(zip([0, *ends[:-1]], ends, strict=True))
    return [(i, j) for i, (s, e) in enumerate(ranges(a)) for j, (t, f) in enumerate(ranges(b)) if max(s, t) < min(e, f)]


def expected(rows, both):
    known, holders = [], Counter()
    for _, text in rows:
        ids_a, ids_b, a, b = brute(text, both)
        pairs = [(ids_a[i], ids_b[j]) for i, j in overlapping(a, b)] if a else []
        known.append((ids_a, ids_b, cut_at(a, b) if a else [], pairs))
        holders.update(set(pairs))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), (ids_a, ids_b, found, pairs) in zip(rows, known, strict=True):
        parts, i, j = [], 0, 0
        for m, n in found:
            parts.append(",".join(map(str, ids_a[i:m])) + "|" + ",".join(map(str, ids_b[j:n])))
            i, j = m, n
        sha = hashlib.sha256(";".join(parts).encode()).hexdigest() if ids_a else ""
        best = sum(holders[p] == most[p[0]] for p in pairs)
        out.append((doc_id, len(ids_a), len(ids_b), len(found), len(pairs), best, sum(holders[p] for p in pairs), sha))
    return Counter(out)


ends = st.sets(st.integers(1, 40), max_size=25).map(lambda s: sorted(s | {41}))


@given(ends, ends)
@settings(max_examples=300, deadline=None, derandomize=True)
def test_cuts_and_links(a, b):
    assert list(zip(*(x.tolist() for x in al.groups(np.array(a), np.array(b))), strict=True)) == cut_at(a, b)
    assert list(zip(*(x.tolist() for x in al.links(np.array(a), np.array(b))), strict=True)) == overlapping(a, b)


def test_cuts_far_from_the_middle():
    """Long intervals without a cut, or with one at an end only."""
    even, odd = np.arange(2, 2000, 2), np.arange(1, 2000, 2)
    for extra in ([], [2], [1996], [2, 1996]):
        a, b = np.append(even, 2001), np.append(np.union1d(odd[1:-1], extra).astype(int), 2001)
        assert list(zip(*(x.tolist() for x in al.groups(a, b)), strict=True)) == cut_at(a.tolist(), b.tolist())
    assert [len(x) for x in al.groups(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]


ODD = [
    (1, None), (2, ""), (3, " "), (None, "Hello world"), (None, "again and again"), (4, "  two  spaces\tand\nlines "),
    (5, "<|endoftext|> <s> </s> <0x41> <unk>"), (6, "漢字 é 😀   ▁ x"), (7, "漢字 é 😀 ½ ﬁ"), (8, "a" * 3000),
    (8, "The same id, another text."), (9, "The same row."), (9, "The same row."), (10, "\x00\x01 ~"), (11, "word " * 5000),
]


@pytest.mark.parametrize("parts", [1, 4])
def test_edge_rows(spark, both, parts):
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("'x' AS block", "1 AS pair", "*", "2 AS totals", "3 AS docs")
    assert Counter(map(tuple, al.align(df.repartition(parts)).collect())) == expected(ODD, both)


def test_empty_table_and_no_tokens(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert al.align(none).count() == 0 and al.pair_counts(none).count() == 0
    got = al.align(spark.createDataFrame([(1, None), (2, "")], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_whole_table(spark, both):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.where("length(text) < 4000").collect()]
    assert Counter(map(tuple, al.align(spark.createDataFrame(rows, SCHEMA)).collect())) == expected(rows, both)


def test_pair_counts_add_up(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    table = al.pair_counts(df).toPandas()
    assert not table.duplicated(["a", "b"]).any() and table["documents"].max() <= df.count()
    assert set(table[table["best"]]["a"]) == set(table["a"])
    most = table.groupby("a")["documents"].transform("max")
    assert (table["best"] == (table["documents"] == most)).all()
