"""What is kept over runs against the same from scratch: best years, newest rows, manifests, run history."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck import refresh
from quarterdeck.operators import (
    append_runs,
    best_of_totals,
    best_year,
    differing_rows,
    drifted,
    manifest,
    merge_manifest,
    merged_totals,
    out_of_bounds,
    partial_totals,
    run_numbers,
)
from quarterdeck.refresh import BestYears, NewestRows
from quarterdeck.sources import read_as_of, snapshots
from quarterdeck.streaming import upsert_available

FACTS = "series_id string, series_title string, year int, period string, value decimal(10,2)"


def facts(rng, n):
    from decimal import Decimal

    pick = rng.choice
    return [
        (
            pick(["a", "b", "c", "d", None]), pick(["t", "u", None]), pick([2019, 2020, 2021, None]),
            pick(["Q01", "Q02", "Q04", "Q05", "M01", None]), pick([None, Decimal("1.25"), Decimal("2.50"), Decimal("-1.25")]),
        )
        for _ in range(n)
    ]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_best_years_by_batches(spark, tmp_path, seed):
    """Facts come, go and are corrected in later batches; every batch's state equals the answer from scratch."""
    rng = random.Random(seed)
    kept = BestYears(spark, str(tmp_path / "kept"), buckets=4)
    present: list[tuple] = []
    for batch in range(1, 5):
        new = facts(rng, 12 if batch < 4 else 0)
        gone = rng.sample(present, len(present) // 3) if batch < 4 else list(present)[: len(present) // 2]
        for row in gone:
            present.remove(row)
        present += new
        change = spark.createDataFrame([(*r, 1) for r in new] + [(*r, -1) for r in gone], FACTS + ", weight int")
        touched = kept.refresh(change, batch, "weight")
        if batch == 2:  # the batch again
            kept.refresh(change, batch, "weight")
        want = rows(best_year(spark.createDataFrame(present, FACTS)))
        assert rows(kept.current()) == want
        with_facts = {r[0] for r in new + gone if r[3] in ("Q01", "Q02", "Q04", "Q05")}
        assert {r.series_id for r in touched.collect()} == with_facts
    assert BestYears(spark, str(tmp_path / "kept"), buckets=4).current().count() == len(want)


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    kept = BestYears(spark, str(tmp_path / "kept"), buckets=8)
    first = spark.range(400).selectExpr(
        "concat('s', id % 50) AS series_id", "'t' AS series_title", "2000 + cast(id % 4 AS int) AS year", "'Q01' AS period", "cast(id AS decimal(10,2)) AS value"
    )
    kept.refresh(first, 1)
    kept.refresh(first.where("series_id = 's7'").limit(3), 2)
    assert len(list((tmp_path / "kept" / "totals" / "batch=2").glob("bucket=*"))) == 1
    assert len(list((tmp_path / "kept" / "totals" / "batch=1").glob("bucket=*"))) == 8


@pytest.mark.parametrize("few", [0, 100_000])
def test_a_batch_of_any_size_gives_the_series_it_touches(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(refresh, "FEW_ROWS", few)
    kept = BestYears(spark, str(tmp_path / "kept"), buckets=2)
    first = [("a", "t", 2000, "Q01", Decimal(1)), ("a", "u", 2000, "Q01", Decimal(1)), (None, "t", 2001, "Q05", Decimal(2)), ("c", "t", 2002, "Q02", Decimal(3))]
    kept.refresh(spark.createDataFrame(first, FACTS), 1)
    back = [(*first[0], -1), (*first[1], -1), (None, "t", 2003, "Q01", Decimal(1), 1)]
    touched = kept.refresh(spark.createDataFrame(back, FACTS + ", weight int"), 2, "weight")
    assert rows(touched) == sorted([("a", None, None, None, False), (None, "t", 2003, Decimal("1.00"), True)], key=repr)
    assert rows(kept.current()) == rows(best_year(spark.createDataFrame([first[2], first[3], back[2][:5]], FACTS)))
    assert kept.current()._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_totals_merge_in_any_order(spark):
    rng = random.Random(9)
    parts = [spark.createDataFrame(facts(rng, 30), FACTS) for _ in range(3)]
    one = best_of_totals(merged_totals(partial_totals(parts[0]).unionByName(partial_totals(parts[2])).unionByName(partial_totals(parts[1]))))
    whole = best_year(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    assert rows(one) == rows(whole)


ROWS = T.StructType().add("k", "long").add("at", "integer").add("v", "string")


def test_newest_rows(spark, tmp_path):
    kept = NewestRows(spark, str(tmp_path / "t"), ROWS, "k", "at", buckets=4)
    assert kept.rows().count() == 0 and kept.ledger().count() == 0
    first = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (None, 1, "n"), (3, None, "z")], ROWS)
    assert kept.apply(first, 0)
    assert rows(kept.rows()) == sorted([(1, 7, "b"), (2, 1, "c"), (None, 1, "n"), (3, None, "z")], key=repr)
    assert not kept.apply(spark.createDataFrame([(1, 9, "never")], ROWS), 0)
    assert kept.apply(spark.createDataFrame([(1, 6, "late"), (3, 1, "y"), (4, 4, "new")], ROWS), 1)
    assert kept.apply(spark.createDataFrame([], ROWS), 2)
    assert rows(kept.rows()) == sorted([(1, 7, "b"), (2, 1, "c"), (None, 1, "n"), (3, 1, "y"), (4, 4, "new")], key=repr)
    assert sorted((r.batch, r.rows) for r in kept.ledger().collect()) == [(0, 4), (1, 3), (2, 0)]


def test_a_batch_that_died_before_its_ledger_line_is_applied_again(spark, tmp_path, monkeypatch):
    kept = NewestRows(spark, str(tmp_path / "t"), ROWS, "k", "at", buckets=2)
    kept.apply(spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], ROWS), 0)
    batch = spark.createDataFrame([(1, 6, "c"), (3, 1, "d")], ROWS)
    ledger = kept.ledger()
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1).write), "mode", dying_at_the_ledger(type(spark.range(1).write).mode))
        with pytest.raises(SystemExit):
            kept.apply(batch, 1)
    assert rows(kept.rows()) == [(1, 6, "c"), (2, 5, "b"), (3, 1, "d")] and ledger.count() == 1
    assert kept.apply(batch, 1)
    assert rows(kept.rows()) == [(1, 6, "c"), (2, 5, "b"), (3, 1, "d")] and kept.ledger().count() == 2


def dying_at_the_ledger(mode):
    def guarded(writer, how):
        if "applied" not in str(writer._df.columns) and writer._df.columns == ["batch", "rows", "buckets"]:
            raise SystemExit
        return mode(writer, how)

    return guarded


def test_stream_into_newest_rows(spark, tmp_path):
    kept = NewestRows(spark, str(tmp_path / "t"), ROWS, "k", "at", buckets=4)
    landed, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    spark.createDataFrame([(i % 7, i, str(i)) for i in range(50)], ROWS).repartition(4).write.parquet(landed)
    upsert_available(spark, landed, kept, checkpoint, files_per_batch=2)
    spark.createDataFrame([(0, 5, "late"), (8, 1, "new")], ROWS).coalesce(1).write.mode("append").parquet(landed)
    got = rows(upsert_available(spark, landed, kept, checkpoint, files_per_batch=2))
    assert got == sorted([*((i % 7, i, str(i)) for i in range(43, 50)), (8, 1, "new")], key=repr)
    assert kept.ledger().count() == 3


DAY = date(2024, 1, 1)


@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 6)), max_size=14), st.randoms(use_true_random=False), st.integers(0, 3)
)
@settings(max_examples=12, deadline=None, derandomize=True)
def test_manifest_merged_by_day_equals_the_recount(spark, seen, rng, first):
    days = sorted({d for _, d in seen})
    rng.shuffle(days)
    df = lambda which: spark.createDataFrame([(n, DAY + timedelta(d)) for n, d in seen if d in which], "filename string, seen_on date")
    done, late = days[:first], days[first:]
    kept = manifest(df(done))
    for day in late[:3]:
        runs = spark.createDataFrame([(DAY + timedelta(d),) for d in done], "day date")
        merged = merge_manifest(kept, df([day]), DAY + timedelta(day), runs)
        kept = spark.createDataFrame(merged.collect(), merged.schema)
        done = [*done, day]
    assert rows(kept) == rows(manifest(df(done)).select(*kept.columns))


def test_reading_as_of_a_day_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "raw")
    days = spark.createDataFrame([(i, date(2024, 1, 1 + 3 * (i // 2))) for i in range(8)], "v int, ingest_date date")
    days.repartition("ingest_date").write.partitionBy("ingest_date").parquet(path)
    assert sorted((str(r.day), r.files) for r in snapshots(spark, path).collect())[0] == ("2024-01-01", 1)
    for day, want in ((None, [6, 7]), (date(2024, 1, 6), [2, 3]), (date(2024, 1, 7), [4, 5]), (date(2023, 1, 1), [])):
        df = read_as_of(spark, path, day)
        assert sorted(r.v for r in df.collect()) == want
    (tmp_path / "raw" / "ingest_date=2024-01-10" / "part-broken.parquet").write_text("no parquet")
    df = read_as_of(spark, path, date(2024, 1, 5), T.StructType.fromDDL("v int"))
    assert sorted(r.v for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan.toString()


def test_run_history(spark, tmp_path):
    path = str(tmp_path / "ledger")
    counts = [10, 12, 11, 30, 12, 3]
    data = [(i, j < n // 2, float(j)) for i, n in enumerate(counts) for j in range(n)]
    df = spark.createDataFrame(data, "day int, good boolean, v double")
    numbers = run_numbers(df, "day", {"good": "good"}, "d", "v")
    append_runs(numbers.where("run < 4"), path)
    append_runs(numbers.where("run >= 3"), path)  # run 3 is logged again
    ledger = spark.read.schema(numbers.schema).parquet(path)
    assert ledger.count() == 12
    told = {(r.check, r.run): (r.number, r.lower, r.upper, r.outside) for r in out_of_bounds(ledger, least=3).collect()}
    assert told["rows", 2] == (11, None, None, False)
    assert told["rows", 3] == (30, 10.0, 12.0, True) and told["rows", 4] == (12, 10.0, 30.0, False)
    assert told["rows", 5] == (3, 10.0, 30.0, True)
    wide = {(r.check, r.run): r.outside for r in out_of_bounds(ledger, slack=2.0, least=3).collect()}
    assert not any(wide.values())
    moved = {r.run: r.outside for r in drifted(ledger).collect()}
    assert moved[0] is False and moved[3] is True and moved[4] is False


def test_differing_rows(spark):
    left = spark.range(1000).selectExpr("id AS k", "concat('v', id % 7) AS `a b`")
    right = left.where("k <> 5").unionAll(left.where("k = 9")).unionAll(left.where("k = 9")).selectExpr("k", "if(k = 77, null, `a b`) AS other")
    got = {(r.k, r["a b"]): r.surplus for r in differing_rows(left, right, "k", 64).collect()}
    assert got == {(5, "v5"): 1, (9, "v2"): -2, (77, "v0"): 1, (77, None): -1}
    same = differing_rows(left, left.orderBy(F.rand(1)), "k", 64)
    assert same.count() == 0
