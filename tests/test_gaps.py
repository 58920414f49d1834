"""Previous point and coverage gaps, also across block borders."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterdeck.operators import coverage_gaps, coverage_gaps_by_key, trend, with_previous
from quarterdeck.operators import gaps as gaps_module


def test_hole_shows_as_distance(spark):
    rows = [(y, y * 10) for y in (2013, 2014, 2019, 2021)]
    df = spark.createDataFrame(rows, "year int, population long")
    got = coverage_gaps(df)
    assert got.columns == ["year", "population", "year_gap"]
    assert sorted(tuple(r) for r in got.collect()) == [
        (2013, 20130, None),
        (2014, 20140, 1),
        (2019, 20190, 5),
        (2021, 20210, 2),
    ]


def test_null_point_has_no_gap_and_gives_none(spark):
    df = spark.createDataFrame([(None, 1), (2013, 2), (2015, 3)], "year int, population long")
    assert {r.population: r.year_gap for r in coverage_gaps(df).collect()} == {1: None, 2: None, 3: 2}


def test_wide_integers_are_refused(spark):
    with pytest.raises(TypeError, match="bigint"):
        coverage_gaps(spark.createDataFrame([(1, 1)], "year long, population long"))


@settings(max_examples=12, derandomize=True, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(-30, 30)), unique=True, max_size=25
    )
)
def test_blocks_do_not_change_the_answer(spark, monkeypatch, points):
    monkeypatch.setattr(gaps_module, "BLOCK", 4)
    df = spark.createDataFrame(points, "k string, year int")
    expected = {}
    for k in {k for k, _ in points}:
        years = sorted(y for key, y in points if key == k)
        expected |= {(k, y): p for y, p in zip(years, [None, *years], strict=False)}
    got = {
        (r.k, r.year): r.previous.year if r.previous else None
        for r in with_previous(df, "year", keys="k").collect()
    }
    assert got == expected


def test_extreme_points(spark):
    low, high = -(2**31), 2**31 - 1
    df = spark.createDataFrame([(low,), (0,), (high,)], "year int")
    got = {r.year: r.previous and r.previous.year for r in with_previous(df, "year").collect()}
    assert got == {low: None, 0: low, high: 0}


def test_days_by_key_from_repeated_rows(spark):
    days = {"u": (1, 1, 4), "v": (9, None)}
    rows = [(u, d and date(2024, 1, d)) for u, ds in days.items() for d in ds]
    df = spark.createDataFrame(rows, "user string, day date")
    got = sorted(tuple(r) for r in coverage_gaps_by_key(df, "user", "day").collect())
    assert got == [
        ("u", date(2024, 1, 1), None),
        ("u", date(2024, 1, 4), 3),
        ("v", date(2024, 1, 9), None),
    ]


def test_trend_skips_unknown_values(spark):
    df = spark.createDataFrame(
        [(2012, 1), (2013, 5), (2014, None), (2015, 9), (2019, 100)], "year int, population long"
    )
    got = [tuple(r) for r in trend(df, start=2013, end=2018).collect()]
    assert got == [(2013, 5, None), (2015, 9, 4)]


def test_no_window_over_the_whole_table(spark):
    df = spark.createDataFrame([(2013, 1)], "year int, population long")
    text = coverage_gaps(df)._jdf.queryExecution().executedPlan().toString()
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    # The one gather is the look across blocks, above the per-block aggregate.
    assert len(single) == 1
