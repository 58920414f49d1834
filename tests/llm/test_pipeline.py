from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp
import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import oracle_rows
from quarterdeck.llm import line_dedup as ld
from quarterdeck.llm import mixing, toxicity
from test_near_dedup import brute
from test_packing import check

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(cp.written(stage(spark, out[-1], D), f"test-{name.replace(' ', '-')}"))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def loaded(df):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r.doc_id, r.text, r.source) for r in df.collect()])
    return con


def test_stages_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "near dedup", "mixing", "packing"]
    assert all(df.schema.simpleString() == stages[0].schema.simpleString() for df in stages[:-1])


def test_toxic_documents_go_and_the_rest_is_untouched(spark, stages):
    docs, clean, *_ = stages
    labels = spark.read.parquet(f"{D}/labels.parquet")
    model = toxicity.fit(docs, labels)
    kinds = toxicity.Kinds(*model["lexicon"])
    want = Counter()
    for r in docs.select(*sorted(docs.columns)).collect():
        if toxicity.score_texts([r.text], model, kinds)[0] < 0.3:
            want[tuple(r)] += 1
    assert rows(clean) == want


def test_lines(stages):
    _, before, after, *_ = stages
    want = oracle_rows(loaded(before), ld.ORACLE)[1]
    got = Counter()
    for r, s in after.select("doc_id", F.sha2(F.col("text").cast("binary"), 256)).collect():
        got[r, s] += 1
    assert got == Counter((w[0], w[1]) for w in want.elements())  # columns in order of their names


def test_one_of_each_group_stays(stages):
    before, after = stages[2], stages[3]
    groups = brute([(r.doc_id, r.text) for r in before.collect()], 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, c, kept in groups if kept)
    assert not rows(after) - rows(before)


def test_mix(stages):
    before, after = stages[3], stages[4]
    columns, want = oracle_rows(loaded(before), mixing.ORACLE)
    at = sorted(columns)
    copies = {w[at.index("doc_id")]: w[at.index("copies")] for w in want.elements()}
    assert Counter(r.doc_id for r in after.collect()) == {d: c for d, c in copies.items() if c}


def test_packed(spark, stages):
    pieces, docs = stages[5], stages[4]
    assert pieces.agg(F.sum("length")).first()[0] == sum(r.length for r in check(docs))


def test_run_is_the_stages(spark, stages):
    got = cp.run(spark, D)
    assert got.columns == stages[5].columns
    key = ("doc_id", "doc_tokens")
    assert rows(got.select(*key).distinct()) == rows(stages[5].select(*key).distinct())
    assert got.agg(F.sum("length")).first()[0] == stages[5].agg(F.sum("length")).first()[0]
