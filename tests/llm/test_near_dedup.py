from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import near_dedup as nd
from quarterdeck.llm.components import components
from quarterdeck.llm.shingles import minhashes, shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent=85):
    """Links by the sets themselves, found through every shared shingle; components by search."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    near = defaultdict(set)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += 1
        near[i] = {j for j, c in common.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)}
    same = defaultdict(set)
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            same[d].add(i)
    out, seen = [None] * len(rows), set()
    for i, (d, _) in enumerate(rows):
        if not sets[i]:
            out[i] = d
        if not sets[i] or i in seen:
            continue
        reach, todo = {i}, [i]
        while todo:
            j = todo.pop()
            new = (near[j] | same[rows[j][0]]) - reach
            reach |= new
            todo += new
        seen |= reach
        ids = [rows[j][0] for j in reach]
        for j in reach:
            out[j] = None if None in ids else min(ids)
    return sorted(((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, out, strict=True)), key=str)


def report(df):
    return sorted((tuple(r) for r in nd.near_report(df).collect()), key=str)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    assert report(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def copies(rng, many, words=200, changes=2):
    """An original and copies with own changes: near it, less so to one another."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(many):
        own = list(base)
        for at in rng.sample(range(words), changes):
            own[at] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(own))
    return out


def test_large_group_around_one_original(spark):
    rng = random.Random(5)
    texts = copies(rng, 700, changes=3) + copies(rng, 40) + copies(rng, 2) + [t for t in copies(rng, 30, words=60, changes=1)]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 1000))
    got = report(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert got == brute(rows)


def test_regions_dealt_into_parts_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 16)
    rng = random.Random(6)
    rows = list(enumerate(copies(rng, 300, changes=1)))
    assert report(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_edge_rows(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    odd = [
        (5, None), (6, ""), (6, ""), (7, " \t\n"), (8, "a b"), (9, "A\tB\n"), (3, "b a"), (None, "q r s"), (None, "lonely words here"),
        (12, base), (11, base.upper()), (10, base + " é"), (13, base + " É"), (14, "long " * 40000), (15, "x" * 20000), (16, "a b"),
        (20, "same id one"), (20, "same id two"),
    ]
    docs = spark.createDataFrame(odd, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("digest", F.lit(1))
    assert report(docs) == brute(odd)
    kept = nd.without_near_copies(docs)
    assert kept.columns == docs.columns and {r.n for r in kept.collect()} == {"clash"}
    assert nd.near_report(docs.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    rng = random.Random(7)
    names = rng.sample(range(10**6), 300)
    edges = [(a, b) for a, b in zip(names, names[1:]) if rng.random() < 0.97] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want, run = {}, [names[0]]
    joined = set(edges)
    for a, b in [*zip(names, names[1:]), (names[-1], None)]:
        if (a, b) in joined:
            run.append(b)
            continue
        if len(run) > 1:
            want |= {x: min(run) for x in run}
        run = [b]
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hashes_stand_for_words():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 60, n)) for n in (0, 1, 4, 5, 6, 80, 900)] + [None, "  ", "É é A a", "\xa0 b"]
    for text, got in zip(texts, shingle_sets(texts), strict=True):
        assert len(got) == len(shingles(text))
    sets = [np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64)) for _ in range(2)]
    joint = np.unique(np.concatenate([sets[0][:300], sets[1][:60]]))
    sig = minhashes([sets[0], joint], 2048)
    real = len(np.intersect1d(sets[0], joint)) / len(np.union1d(sets[0], joint))
    assert abs((sig[0] == sig[1]).mean() - real) < 0.04


def changed(rng, text, changes=3):
    own = text.split()
    for at in rng.sample(range(len(own)), changes):
        own[at] = f"x{rng.randrange(10**9)}"
    return " ".join(own)


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("seed,percent,changes", [(1, 85, 3), (2, 85, 3), (3, 80, 4)])
def test_star_of_thousands(spark, seed, percent, changes):
    """Every copy is near the original and, mostly, near no other."""
    texts = copies(random.Random(seed), 5000, changes=changes)
    assert all(100 * alike(texts[0], t) >= percent for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    assert {r.component_id for r in nd.near_report(docs, percent=percent).collect()} == {0}


def test_copies_of_copies(spark):
    """A child is near its parent only, which neither leads a region nor need stand beside it."""
    rng = random.Random(8)
    texts = copies(rng, 1500, changes=3)
    texts += [changed(rng, t) for t in texts[1:1001]]
    assert all(alike(texts[i], texts[i + 1500]) >= 0.85 for i in range(1, 1001))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    assert [r.doc_id for r in nd.near_report(docs).collect() if r.component_id] == []


def test_alike_but_unlinked_texts_are_told_apart_by_sketch(spark):
    """Copies at about 0.73 to one another, without their original: few of all pairs reach the texts."""
    texts = copies(random.Random(11), 600, changes=3)[1:]
    assert 0.65 < alike(texts[0], texts[1]) < 0.83
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.selectExpr("struct(doc_id, text) AS _row").mapInArrow(nd._signed(5, "text"), "_row struct<doc_id:long,text:string>, n long, digest binary, sig binary, sketch binary")
    classes = nd.written(rows.selectExpr("digest", "_row.doc_id AS id", "sig", "sketch", "n AS size"), "classes")
    place = nd.placed(classes)
    own = classes.selectExpr("digest", "id AS component")
    many = nd.rest(place, classes.select("digest", "sketch", "size"), own, 85, None).count()
    assert many < 0.04 * 600 * 599 / 2
    assert nd.candidates(place, 85).count() <= nd.TREES * nd.NEIGHBOURS * 600


def test_crowded_regions_are_dealt_out_by_deeper_prefixes(spark, monkeypatch):
    monkeypatch.setattr(nd, "CROWD", 20)
    rng = random.Random(12)
    rows = list(enumerate(copies(rng, 200, changes=1) + copies(rng, 3)))
    assert report(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_only_classes_that_share_a_region_are_placed_and_each_set_of_them_is_compared_once(spark, monkeypatch):
    """Two texts alike but not linked share several regions, five hundred others none."""
    seen = {}

    def written(df, name):
        out = nd_written(df, name)
        seen.setdefault(name, out.count())
        return out

    nd_written = nd.written
    monkeypatch.setattr(nd, "written", written)
    rng = random.Random(13)
    texts = [t for _ in range(500) for t in copies(rng, 0)] + copies(rng, 2, changes=3)[1:]
    assert 0.65 < alike(*texts[-2:]) < 0.83
    rows = list(enumerate(texts))
    assert report(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert seen["places"] == 2 * nd.TREES
    assert seen["members"] >= 4 and seen["open"] == 1


def test_values_and_sketches_are_written_for_classes_that_may_share_a_region_only(spark, monkeypatch):
    """What is written of every text has its size, not the sizes of a signature and a sketch as well."""
    rows, size = {}, {}

    def written(df, name):
        out = nd_written(df, name)
        rows.setdefault(name, out.count())
        size.setdefault(name, sum(Path(f.removeprefix("file:")).stat().st_size for f in out.inputFiles()))
        return out

    nd_written = nd.written
    monkeypatch.setattr(nd, "written", written)
    rng = random.Random(14)
    docs = list(enumerate([t for _ in range(2000) for t in copies(rng, 0, words=20)] + 3 * copies(rng, 1, changes=1)))
    assert report(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)) == brute(docs)
    assert rows["near"] == 2
    assert size["signed"] < 600 * len(docs)


@pytest.mark.parametrize("keys", [100, 40_000])
def test_a_filter_passes_every_key_and_few_others(spark, keys):
    rng = np.random.default_rng(15)
    names = [x.tobytes() for x in rng.integers(0, 2**64, (2 * keys, 2), dtype=np.uint64)]
    wanted = nd.written(spark.createDataFrame([(bytearray(x),) for x in names[:keys]], "digest binary"), "wanted")
    held = nd.filter_of(wanted)
    batch = pa.RecordBatch.from_pydict({"digest": pa.array(names + names[:50], pa.binary()), "text": [str(i) for i in range(2 * keys + 50)]})
    (got,) = nd._picked(held)([batch])
    assert got.column("digest").to_pylist()[:keys] == names[:keys]
    assert got.column("text").to_pylist()[:keys] == [str(i) for i in range(keys)]
    assert got.num_rows <= 1.01 * keys
    many = nd.written(spark.range(keys).select(F.xxhash64("id").alias("region")), "shared")
    look = nd._looked_up(nd.filter_of(many))
    assert look(pa.array([r.region for r in many.collect()], pa.int64())).all()


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "filter_of", lambda keys: spark.sparkContext.broadcast(zlib.compress(b"\xff" * nd.SEGMENT)))
    rng = random.Random(16)
    rows = list(enumerate(copies(rng, 60) + [t for _ in range(60) for t in copies(rng, 0)] + 2 * copies(rng, 2))) + [(500, None), (501, "")]
    assert report(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_sketches_estimate_likeness():
    rng = np.random.default_rng(4)
    for size in (20, 400, 20_000):
        x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: int(0.9 * size)], rng.integers(0, 2**63, size // 10, dtype=np.uint64)]))
        a, b = (np.frombuffer(nd.sketch(s), np.uint8) for s in (x, y))
        filled = ((a != 0) | (b != 0)).sum()
        real = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs(((a == b) & (a != 0)).sum() / filled - real) < 4 * np.sqrt(real * (1 - real) / filled) + 0.01
        assert nd.sketch(x) == nd.sketch(x.copy())
