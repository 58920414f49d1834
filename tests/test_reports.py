"""Report queries."""

from __future__ import annotations

from quarterdeck.operators import (
    Lookup,
    best_table,
    left_lookup,
    only_in,
    title_totals,
    top_k,
    two_way_difference,
)

BEST = [
    ("S1", "Mines", 2020, 5.0),
    ("S1", "Mines", 2021, 5.0),
    ("S2", "Mines", 2020, 7.5),
    ("S3", "Farms", 2019, 1234567.891),
    ("S4", "", 2018, None),
]
SCHEMA = "series_id string, series_title string, year int, yearly_sum double"


def test_top_k_breaks_ties_as_told_and_puts_nulls_last(spark):
    df = spark.createDataFrame(BEST, SCHEMA)
    got = top_k(df, k=3, tie_break=("series_id", "year")).collect()
    assert [(r.series_id, r.year) for r in got] == [("S3", 2019), ("S2", 2020), ("S1", 2020)]
    assert [r.series_id for r in top_k(df, k=99, tie_break="year").collect()][-1] == "S4"


def test_best_table_shows_formatted_numbers(spark):
    got = best_table(spark.createDataFrame(BEST, SCHEMA), tie_break=("series_id", "year")).collect()
    assert [r.year_display for r in got] == ["2019", "2020", "2020", "2021", "2018"]
    assert [r.yearly_sum_display for r in got] == ["1,234,567.89", "7.50", "5.00", "5.00", None]


def test_series_and_tied_years_under_one_title_add_up(spark):
    got = title_totals(top_k(spark.createDataFrame(BEST, SCHEMA), k=4, tie_break="year"))
    assert [tuple(r) for r in got.collect()] == [("Farms", 1234567.891), ("Mines", 17.5)]


def test_difference_counts_repeats(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "y")], "a int, b string")
    assert tuple(two_way_difference(left, right).first()) == (2, 1)
    assert sorted(tuple(r) for r in only_in(left, right).collect()) == [(1, None), (2, "x")]
    assert tuple(two_way_difference(left, left).first()) == (0, 0)
    none = left.where("false")
    assert tuple(two_way_difference(none, none).first()) == (0, 0)


def test_single_lookup_ignores_blanks_on_both_sides(spark):
    df = spark.createDataFrame([("A ", 1), ("B", 2), (None, 3)], "code string, v int")
    table = spark.createDataFrame([(" A", "Farms")], "code string, name string")
    got = left_lookup(df, Lookup(table, "code", "name"))
    assert got.columns == ["code", "v", "name"]
    assert sorted((r.v, r.name) for r in got.collect()) == [(1, "Farms"), (2, None), (3, None)]
