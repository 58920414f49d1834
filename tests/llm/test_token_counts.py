from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterdeck.llm import token_counts as tc
from quarterdeck.llm.tokenizing import encoder, load


def brute(text, sections, rule):
    """Token by token and section by section, on the offsets of the whole text."""
    found = load(tc.VOCABULARY).encode(text, add_special_tokens=False).offsets if text else []
    counts, crossing, outside = [0.0] * len(sections), [0] * len(sections), 0.0
    for a, b in found:
        b = max(b, a + 1)
        over = [(max(0, min(b, e) - max(a, s)), -i) for i, (s, e) in enumerate(sections)]
        hit = [(n, -i) for n, i in over if n > 0]
        for n, i in hit:
            crossing[i] += n < b - a
        if rule == "split":
            for n, i in hit:
                counts[i] += n / (b - a)
            outside += 1 - sum(n for n, _ in hit) / (b - a)
            continue
        if rule == "first":
            own = [i for n, i in hit if sections[i][0] <= a < sections[i][1]]
        else:
            own = [-max(over)[1]] if hit else []
        for i in own:
            counts[i] += 1
        outside += not own
    return counts, crossing, outside, len(found)


@given(
    st.text(alphabet="ab \n\t.é漢😀'1", max_size=50), st.lists(st.integers(0, 55), max_size=10, unique=True), st.sampled_from(tc.RULES)
)
@settings(max_examples=300, deadline=None, derandomize=True)
def test_attribution_matches_brute_force(text, cuts, rule):
    cuts = sorted(cuts)
    sections = list(zip(cuts[::2], cuts[1::2]))
    tokens = encoder(tc.VOCABULARY).spans([text])[0]
    counts, crossing, outside = tc.attribute(tokens, np.array(sections, np.int64).reshape(-1, 2), rule)
    want = brute(text, sections, rule)
    assert np.allclose(counts, want[0]) and crossing.tolist() == want[1] and np.isclose(outside, want[2])


def test_lines_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 4 = 0")
    got = defaultdict(list)
    for r in tc.section_tokens(docs).collect():
        got[r.doc_id].append(r)
    for doc_id, text in docs.select("doc_id", "text").collect():
        rows = sorted(got[doc_id], key=lambda r: r.section)
        sections = [(r.start, r.stop) for r in rows]
        assert "".join(text[a:b] for a, b in sections) == text and len(rows) == len(text.splitlines())
        want = brute(text, sections, "first")
        assert [r.tokens for r in rows] == want[0] and [r.crossing for r in rows] == want[1]
        assert {r.doc_tokens for r in rows} == {want[3]} and {r.outside for r in rows} == {0.0}


@pytest.mark.parametrize("rule", tc.RULES)
def test_edge_rows(spark, rule):
    odd = [
        (1, None, None), (2, "", [(0, 0)]), (None, "one two", [(0, 2), (5, 7)]), (3, "\n\n", [(0, 1), (None, 5), None]),
        (4, "word " * 30000, [(0, 150000)]), (4, "word", [(0, 4)]), (5, "漢字 😀", [(0, 99)]),
    ]
    schema = "doc_id long, text string, sections array<struct<start:int,stop:int>>"
    docs = spark.createDataFrame(odd, schema).withColumn("section", F.lit("clash")).withColumn("tokens", F.lit(1))
    for name in (None, "sections"):
        rows = tc.section_tokens(docs, name, rule).collect()
        total = sum(r.tokens for r in rows)
        assert rows and total > 30000 and all(r.tokens >= 0 for r in rows)
    lines = tc.section_tokens(docs, rule=rule).collect()
    assert sum(r.tokens for r in lines if r.doc_id == 3) == pytest.approx(next(r.doc_tokens for r in lines if r.doc_id == 3))
    assert [(r.start, r.stop, r.tokens) for r in lines if r.doc_id == 1] == [(0, 0, 0.0)]
    assert tc.section_tokens(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tc.section_tokens(docs, rule="last")
