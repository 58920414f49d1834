from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import connect, oracle_rows, spark_rows
from quarterdeck.llm import line_dedup as ld

COLUMNS = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def report(docs):
    return spark_rows(ld.line_report(docs).select(COLUMNS))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_matches_oracle(spark, sf):
    d = f"/root/testdata/sf{sf}"
    assert report(spark.read.parquet(f"{d}/documents.parquet")) == oracle_rows(connect(d), ld.ORACLE)[1]


LINE = "a Line of more than twenty characters"
EDGES = [
    (1, LINE), (2, f"  {LINE.upper()}\t\r\nshort"), (3, f"x\n{LINE}\n{LINE}\v\ny"), (None, LINE), (None, f"\n{LINE}\n"),
    (4, " " + LINE), (5, None), (6, ""), (7, "\n\n"), (7, "\n\n"), (8, "é" * 20 + "\n" + "É" * 20), (9, "é" * 20), (10, "é" * 20),
    (11, "é" * 19), (12, "é" * 19), (13, "é" * 19), (14, "z" * 25 + "\n" + "z" * 25), (15, "z" * 25), (16, "word " * 30000),
]


def test_edge_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", EDGES)
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("_gone", F.lit(1)).withColumn("key", F.lit("k"))
    assert report(docs) == oracle_rows(con, ld.ORACLE)[1]
    kept = ld.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert {r.key for r in got} == {"k"} and next(r.text for r in got if r.doc_id == 1) == ""
    assert next(r.text for r in got if r.doc_id == 4) == EDGES[5][1]  # the largest id keeps it


def test_empty(spark):
    assert ld.line_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_same_over_many_partitions_and_a_tiny_filter(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = report(docs)
    assert report(docs.repartition(23)) == want
    monkeypatch.setattr(ld, "MOST_BITS", 1 << 16)  # nearly everything is a suspect
    assert report(docs) == want


def test_second_filter_holds_what_two_tasks_share(spark):
    rows = [(i, f"only here, line number {i} of the set") for i in range(500)] + [(900, "this one is in two documents")] + [(i, "x") for i in range(600, 700)] + [(901, "this one is in two documents")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    blob, bits = ld.seen_twice(docs, "text", 20)
    joint = np.frombuffer(ld.zlib.decompress(blob), np.uint8)
    h = np.array([ld.xxhash.xxh3_64_intdigest(ld.line_key(t.encode())) for _, t in rows], np.uint64)
    hit = ld._has(joint, ld._probes(h, bits))
    assert hit[500] and hit[-1] and hit[:500].sum() < 5
