"""Rules, their metrics, and dataset checks."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.operators import (
    Rule,
    RuleViolation,
    check,
    dedupe_by_key,
    enforce,
    observed,
    observed_metrics,
    rule_metrics,
    schema_drift,
    stale_sources,
    volume_freshness,
)

RULES = [
    Rule("key", "k IS NOT NULL", "drop"),
    Rule("positive", "v > 0", "warn"),
    Rule("small", "v < 100", "fail"),
]
ROWS = [("a", 1), ("b", None), (None, 5), ("c", -1)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "k string, v int")


def test_drop_filters_and_warn_does_not(df):
    kept, _ = check(df, RULES[:2], "d")
    assert sorted(r.k for r in kept.collect()) == ["a", "b", "c"]
    got = [tuple(r) for r in rule_metrics(df, RULES, "d").collect()]
    assert got == [
        ("d", "key", "drop", 4, 3, 1, 1),
        ("d", "positive", "warn", 4, 2, 2, 0),
        ("d", "small", "fail", 4, 3, 1, 0),
    ]


def test_blank_key_passes_the_null_rule(spark):
    blank = spark.createDataFrame([("  ", 1)], "k string, v int")
    assert check(blank, RULES, "d")[0].count() == 1


def test_fail_raises_and_names_the_rule(df):
    with pytest.raises(RuleViolation, match="d.small: 1 of 4 rows"):
        enforce(rule_metrics(df, RULES, "d"))
    with pytest.raises(RuleViolation, match="d.small: 1 of 4 rows"):
        check(df, RULES, "d")
    enforce(rule_metrics(df, RULES[:2], "d"))


def test_counts_of_one_pass_equal_the_metrics(df, tmp_path):
    kept, counts = observed(df, RULES, "d")
    kept.write.parquet(str(tmp_path / "out"))
    assert observed_metrics(counts.get, RULES, "d") == [
        tuple(r) for r in rule_metrics(df, RULES, "d").collect()
    ]


def test_metrics_of_an_empty_frame(df):
    got = rule_metrics(df.where("false"), RULES, "d").collect()
    assert [(r.rule, r.rows, r.failed) for r in got] == [(r.name, 0, 0) for r in RULES]


def test_unknown_action():
    with pytest.raises(ValueError, match="ignore"):
        Rule("r", "true", "ignore")


def test_volume_and_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 5),)], "ts timestamp")
    bound = F.lit("2024-01-05").cast("timestamp")
    got = volume_freshness(df, "ts", "d", 3, bound).first()
    assert (got.rows, got.volume_ok, got.fresh_ok) == (2, False, True)
    assert volume_freshness(df, "ts", "d", 1, bound, max_rows=2).first().volume_ok
    assert not volume_freshness(df, "ts", "d", 1, bound, max_rows=1).first().volume_ok
    empty = volume_freshness(df.where("false"), "ts", "d", 0, bound).first()
    assert (empty.rows, empty.newest, empty.volume_ok, empty.fresh_ok) == (0, None, True, False)


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None)], "a int, b string, extra string")
    expected = T.StructType.fromDDL("a long, b string, c double")
    got = {r.column: (r.status, r["values"]) for r in schema_drift(df, expected).collect()}
    assert got == {"a": ("retyped", 2), "b": ("ok", None), "c": ("missing", None), "extra": ("unexpected", 0)}
    every = schema_drift(df, expected, ("ok", "missing", "unexpected", "retyped")).collect()
    assert {r.column: r["values"] for r in every} == {"a": 2, "b": 1, "c": 0, "extra": 0}


def test_dotted_names(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (1, "y", 3.0)], "`a.b` int, `c d` string, `e``f` double")
    drift = schema_drift(df, T.StructType.fromDDL("`a.b` long")).collect()
    assert {r.column: r["values"] for r in drift} == {"a.b": 2, "c d": 2, "e`f": 2}
    assert [tuple(r) for r in dedupe_by_key(df, "a.b", "c d").collect()] == [(1, "y", 3.0)]


def test_stale_sources(spark):
    required = spark.createDataFrame([("m",), ("m",), ("s",)], "filename string")
    gone = spark.createDataFrame([("m",), ("z",), ("m",)], "filename string")
    assert [r.filename for r in stale_sources(required, gone).collect()] == ["m"]
