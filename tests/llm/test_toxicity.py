from __future__ import annotations

import pickle
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import features
from quarterdeck.llm import toxicity as tox
from quarterdeck.llm.features import blocks, labelled
from quarterdeck.llm.boosting import fit_boosted, fit_isotonic


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, tox.toxicity_report(docs, labels).collect()


def test_held_out_accuracy_and_contract(scored):
    docs, labels, rows = scored
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    caught = [r.predicted for r in held if truth[r.doc_id] == 1]
    clean = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert np.mean(caught) > 0.7 and np.mean(clean) < 0.05


def test_held_out_labels_do_not_matter(spark, scored):
    docs, labels, rows = scored
    turned = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert sorted(tox.toxicity_report(docs, turned).collect()) == sorted(rows)


def test_edge_rows(spark, scored):
    _, labels, _ = scored
    odd = spark.createDataFrame(
        [(None, None, 1), (1, "", 2), (1, "", 2), (2, "you idiot " * 20000, 3), (3, "\n\t ", 4), (4, "1d10t @#! Ж", 5)],
        "doc_id long, text string, score int",
    ).withColumn("_text", F.lit("clash"))
    model = {"lexicon": (frozenset(["idiot"]), frozenset()), "trees": None, "prior": 0.25}
    assert tox.with_scores(odd, model).count() == 6
    assert tox.without_toxic(odd, model).columns == odd.columns
    got = tox.toxicity_report(odd, labels.limit(0)).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.5}
    assert tox.toxicity_report(odd.limit(0), labels).count() == 0


def test_features_see_hits_near_the_reader():
    kinds = tox.Kinds(frozenset(["abcd*"]), frozenset())
    got = dict(zip(tox.FEATURES, tox.dense("You abcdef. Far away from it all the abcdxyz sits", kinds), strict=True))
    assert got["strong_distinct"] == 2 and got["near_second"] == 0.1 and got["second"] == 0.1
    assert tox.dense("", kinds) == [0.0] * len(tox.FEATURES)


def test_trees_and_isotonic_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit_boosted(x[:2000], y[:2000])
    raw = model.raw(x[2000:])
    assert ((raw > 0) == y[2000:]).mean() > 0.95
    xs, ys = fit_isotonic(raw, y[2000:])
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all() and ys[0] < 0.1 and ys[-1] > 0.9


def test_the_sample_is_bounded_by_rows(spark):
    """A third of all rows with one labelled id."""
    docs = spark.range(30_000).selectExpr("if(id % 3 = 0, 1, id) AS doc_id", "concat('text ', id) AS text", "id AS label")
    labels = spark.range(30_000).selectExpr("id AS doc_id", "int(id % 2) AS toxic").unionAll(spark.range(9).selectExpr("1L", "1"))
    got = labelled(docs, labels, "toxic", 4, 2, 500)
    assert 300 < got.count() < 700
    every = labelled(docs, labels, "toxic", 4, 2, 10**9)
    assert every.where("doc_id = 1").select("text", "label").collect() == [("text 0", 1)]
    assert every.count() == every.select("doc_id").distinct().count()


def test_a_task_takes_a_batch_in_runs_of_bounded_size(monkeypatch):
    """A batch of texts of any length is scored run by run, and its texts are in it once, in their rows."""
    monkeypatch.setattr(features, "BLOCK", 10_000)
    texts = ["", "you idiot " * 300, None, "a b", "x" * 25_000, *["word " * 400] * 40, ""]
    rows = pa.StructArray.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "body"])
    whole = pa.RecordBatch.from_arrays([pa.concat_arrays([rows, rows])], names=["_row"]).slice(len(rows))
    model = {"lexicon": (frozenset(["idiot"]), frozenset()), "trees": None, "prior": 0.25}
    got = list(tox._scored(SimpleNamespace(value=pickle.dumps(model)), "body")([whole]))
    assert [r["_row"]["body"] for b in got for r in b.to_pylist()] == texts
    assert len(got) > 9 and max(sum(len(r["_row"]["body"] or "") for r in b.to_pylist()[:-1]) for b in got) <= 10_000
    assert list(blocks(pa.array([], pa.string()))) == [] and list(blocks(pa.array([None, ""], pa.string()))) == [(0, 2)]


def test_counts_of_a_task_are_handed_on_in_parts(monkeypatch):
    texts, labels = [f"word{chr(97 + i % 26) * 3}{chr(97 + i // 26)} all Other" for i in range(300)], [i % 2 for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels, pa.int32())], names=["text", "label"])
    (one,) = tox._holdings([batch])
    monkeypatch.setattr(tox, "COUNTED", 50)
    parts = list(tox._holdings([batch]))
    assert len(parts) > 5 and max(b.num_rows for b in parts) < 50 + 20
    total: Counter = Counter()
    for r in (r for b in parts for r in b.to_pylist()):
        total[r["key"], r["label"]] += r["n"]
    assert total == {(r["key"], r["label"]): r["n"] for r in one.to_pylist()}
