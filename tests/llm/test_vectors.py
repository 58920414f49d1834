from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import vectors as v


def brute(rows, every=100, k=10):
    """All distances in double precision."""
    ok = {i: np.array(e, float) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)}
    out = {}
    for q in ok:
        if q % every == 0:
            near = sorted((float(np.sqrt(((ok[i] - ok[q]) ** 2).sum())), i) for i in ok if i != q and len(ok[i]) == len(ok[q]))
            out[q] = [(i, d) for d, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def recall(got, want):
    pairs = [(got.get(q, []), w) for q, w in want.items()]
    return sum(len({i for i, _ in g} & {i for i, _ in w}) for g, w in pairs) / sum(len(w) for _, w in pairs)


def test_recall_and_exact_scores(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    monkeypatch.setattr(v, "SHARD_ROWS", 700)  # several shards
    got, want = found(v.neighbours(df, every=20)), brute(rows, every=20)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    exact = {q: dict(w) for q, w in brute(rows, every=20, k=len(rows)).items()}
    assert all(abs(exact[q][i] - d) < 1e-12 for q, g in got.items() for i, d in g)
    assert all(g == sorted(g, key=lambda x: (x[1], x[0])) for g in got.values())


def test_small_tables_are_exact(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(60)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found(v.neighbours(df, every=7)), brute(rows, every=7)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in g] for q, g in want.items()}


def test_a_third_of_equal_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, want = found(v.neighbours(df)), brute(rows)
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]] == [0, *range(3, 30, 3)]
    assert recall(got, want) >= 0.95


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [2.0, 0.0]), (8, [0.0, 0.0, 1.0]), (-100, [0.0, 1.0]), (200, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>").withColumn("graph", F.lit("clash")).withColumn("rank", F.lit(9))
    got, want = found(v.neighbours(df)), brute(odd)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in g] for q, g in want.items()}
    assert v.neighbours(df.limit(0)).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert v.neighbours(one).count() == 0


def scaled(offset, scale):
    rng = np.random.default_rng(8)
    return [(i, ((rng.normal(size=16) + offset) * scale).tolist()) for i in range(2500)]


@pytest.mark.parametrize(("offset", "scale"), [(5000.0, 1.0), (1e4, 1.0), (1e6, 1.0), (0.0, 1e20), (0.0, 1e39), (0.0, 1e-30), (1e4, 1e30), (0.0, 1e-200), (0.0, 1e200)])
def test_offsets_and_scales_lose_nothing(spark, monkeypatch, offset, scale):
    monkeypatch.setattr(v, "SHARD_ROWS", 1000)
    rows = scaled(offset, scale)
    got = found(v.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    unit = {i: np.array(e) / scale for i, e in rows}
    want = {q: sorted((float(np.sqrt(((x - unit[q]) ** 2).sum())), i) for i, x in unit.items() if i != q)[:10] for q in range(0, 2500, 100)}
    assert {q: len(g) for q, g in got.items()} == dict.fromkeys(want, 10)
    assert recall(got, {q: [(i, d) for d, i in w] for q, w in want.items()}) >= 0.95
    assert all(math.isclose(d, float(np.sqrt(((unit[i] - unit[q]) ** 2).sum())) * scale, rel_tol=1e-9) for q, g in got.items() for i, d in g)


def test_far_clusters_keep_their_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=8) + (i % 3) * 1e6).tolist()) for i in range(1800)]
    got = found(v.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert recall(got, brute(rows)) >= 0.95


def test_queries_in_blocks_change_nothing(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = found(v.neighbours(df, every=10))
    monkeypatch.setattr(v, "QUERY_BLOCK", 7)
    monkeypatch.setattr(v, "SEARCHED", 3)
    assert found(v.neighbours(df, every=10)) == want
