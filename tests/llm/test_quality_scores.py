from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import quality as q


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, q.quality_report(docs, labels).collect()


def test_held_out_accuracy_and_contract(scored):
    docs, labels, rows = scored
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = [r.predicted for r in held if truth[r.doc_id] == 1]
    bad = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.3


def test_held_out_labels_do_not_matter(spark, scored):
    docs, labels, rows = scored
    turned = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert sorted(q.quality_report(docs, turned).collect()) == sorted(rows)


def test_edge_rows(spark, scored):
    _, labels, _ = scored
    odd = spark.createDataFrame(
        [(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 20000, 3), (3, "\n\t ", 4), (4, "Ж @#!", 5)],
        "doc_id long, text string, score int",
    ).withColumn("_text", F.lit("clash"))
    got = q.quality_report(odd, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in q.quality_report(odd, labels.limit(0)).collect()} == {0.5}
    assert q.quality_report(odd.limit(0), labels).count() == 0


def test_linear_time_score_equals_all_pairs():
    rng = np.random.default_rng(1)
    parts = [q.sparse(t, q.Buckets()) for t in ("a b c a", "", "one two three | four!")]
    size = q.BUCKETS + len(q.STRUCTURE) * (q.BINS + 1)
    cuts = [np.array([0.1, 0.5])] * len(q.STRUCTURE)
    m = q.Machine(cuts, 0.3, rng.normal(size=size), rng.normal(size=(size, q.FACTORS)))
    at, value, starts = m.rows(parts)
    raw = m.raw(at, value, starts)[0]
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(at)], strict=True)):
        i, x = at[a:b], value[a:b].astype(float)
        want = 0.3 + m.linear[i] @ x
        want += sum(m.factors[i[p]] @ m.factors[i[r]] * x[p] * x[r] for p in range(len(i)) for r in range(p))
        assert abs(want - raw[k]) < 1e-6
