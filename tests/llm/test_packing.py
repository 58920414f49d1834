from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterdeck.llm import packing as pk
from quarterdeck.llm.tokenizing import encoder, load, token_bytes


def covers(pieces, sizes, length):
    """Every id in one piece; sequences gapless, and full or a power of two."""
    by_item, by_sequence = defaultdict(list), defaultdict(list)
    for item, start, n, sequence, offset in pieces:
        by_item[item].append((start, n))
        by_sequence[sequence].append((offset, n))
    for item, size in sizes.items():
        at = 0
        for start, n in sorted(by_item[item]):
            assert start == at and n > 0
            at += n
        assert at == size
    for held in by_sequence.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0
    return by_sequence


@given(st.lists(st.integers(1, 5000), max_size=60))
@settings(max_examples=150, deadline=None, derandomize=True)
def test_pack_covers_and_pads_nothing(sizes):
    by_sequence = covers(pk.pack(sizes), dict(enumerate(sizes)), 1024)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@given(st.lists(st.integers(1, 64), min_size=1, max_size=80))
@settings(max_examples=100, deadline=None, derandomize=True)
def test_tree_is_first_fit(sizes):
    tree, free = pk.FirstFit(64, len(sizes)), []
    for s in sizes:
        want = next((i for i, f in enumerate(free) if f >= s), len(free))
        if want == len(free):
            free.append(64)
        free[want] -= s
        assert tree.put(s) == want


@given(st.text(alphabet="ab \n\t\r\x0b\x1c\x85  é漢😀'st1_.<|endofx>", max_size=60))
@settings(max_examples=400, deadline=None, derandomize=True)
def test_ranks_give_the_ids_of_the_tokenizer(text):
    for plain in (False, True):
        ids = load(pk.VOCABULARY, plain).encode(text, add_special_tokens=False).ids
        assert encoder(pk.VOCABULARY, plain).encode([text])[0].tolist() == ids
    assert b"".join(token_bytes(pk.VOCABULARY)[i] for i in ids).decode() == text


def test_white_space_beyond_the_ranks_expressions():
    text = "a" + " " * 2_000_000 + "b" + "\n" * 1_000_000
    ids = encoder(pk.VOCABULARY).encode([text])[0]
    assert b"".join(token_bytes(pk.VOCABULARY)[i] for i in ids.tolist()).decode() == text


def check(docs):
    """Against ids of the whole texts, encoded in one go."""
    tokenizer = load(pk.VOCABULARY)
    rows = pk.pack_documents(docs).collect()
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0])
    got = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for d, pieces in got.items():
        if len(want[d]) == 1:
            ids = [i for p in sorted(pieces, key=lambda p: p.start) for i in p.ids]
            assert ids == want[d][0] and {p.doc_tokens for p in pieces} == {len(ids)}
        else:
            assert sum(p.length for p in pieces) == sum(map(len, want[d]))
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
    return rows


def test_round_trip(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.mark.parametrize("parts", [1, 5])
def test_edge_rows(spark, parts):
    odd = [(1, None), (2, ""), (None, "a  b\n c"), (None, None), (3, "x" * 5000), (4, "word " * 30000), (3, "again"), (5, "<|endoftext|> 漢 😀")]
    docs = spark.createDataFrame(odd, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1))
    check(docs.repartition(parts))
    assert pk.pack_documents(docs.limit(0)).count() == 0


def test_the_same_pieces_however_rows_arrive(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(docs.where("doc_id < 20")).unionAll(docs.where("doc_id < 5").selectExpr("7L", "'same'"))
    told = [sorted(map(tuple, pk.pack_documents(docs.repartition(n), with_ids=False).collect())) for n in (3, 7)]
    assert told[0] == told[1]


def test_several_groups(spark, monkeypatch):
    monkeypatch.setattr(pk, "GROUP_ROWS", 50)
    rows = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "doc_id"))
    assert len({r.sequence_id >> pk.SEQUENCE_BITS for r in rows}) > 1
