"""Every registered query against its oracle, on the given tables and on a copy in which one
key of each table holds a third of the rows; and what the plans must not contain."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle import connect, oracle_rows, spark_rows
from quarterdeck.operators import series
from quarterdeck.plans.catalogue import QUERIES
from quarterdeck.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


# The key columns of a table and the values that a third of its rows get.
HOT = {
    "lineitem": {"l_orderkey": 1, "l_linenumber": 1, "l_partkey": 25, "l_suppkey": 3, "l_returnflag": "A"},
    "orders": {"o_custkey": 1, "o_orderstatus": "F"},
    "events": {"user_id": 5, "event_type": "error"},
    "customer": {"c_nationkey": 7},
    "part": {"p_brand": "Brand#1", "p_type": "ECONOMY"},
    "supplier": {"s_nationkey": 1},
    "pages": {"html": '<a href="/same">x</a><a HREF="/dir/"></a><a href="?C=N">'},
    "nation": {},
    "region": {},
}


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("hot")
    for name, values in HOT.items():
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        lucky = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
        kinds = dict(df.dtypes)
        df = df.withColumns(
            {c: F.when(lucky, F.lit(v).cast(kinds[c])).otherwise(F.col(c)) for c, v in values.items()}
        )
        (root / "one").mkdir(exist_ok=True)
        df.toPandas().to_parquet(root / "one" / f"{name}.parquet", coerce_timestamps="us")
    return str(root / "one")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def compare(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = oracle_rows(connect(sf_dir), ORACLES[name])
    assert sorted(df.columns) == sorted(columns)
    assert spark_rows(df) == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_oracle(spark, name):
    compare(spark, name, SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_oracle_with_hot_keys(spark, hot_dir, name):
    compare(spark, name, hot_dir)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


# Queries that write before they return; the plans of the others are the whole of them.
EAGER = {"medallion_flow", "stream_ingest", "json_records", "twins_diff", "best_year_incremental", "stream_upsert", "layout_skipping", "landing_guards"}
LAZY = sorted(set(QUERIES) - EAGER)


def _adding(original):
    """period_totals with the annual code counted as one more quarter."""

    def totals(facts, quarters, annual, *rest):
        return original(facts, (*quarters, annual), annual, *rest)

    return totals


RULED = ("best_year", "best_year_single", "period_rule_audit", "equivalence_diff", "twins_diff", "medallion_flow")


@pytest.mark.parametrize("name", RULED)
def test_adding_the_annual_code_to_quarters_is_seen(spark, monkeypatch, name):
    monkeypatch.setattr(series, "period_totals", _adding(series.period_totals))
    with pytest.raises(AssertionError):
        compare(spark, name, SF)


def test_audit_and_resolution_shuffle_little(spark):
    count = lambda name: QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert count("period_rule_audit") <= 2


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_in_plans(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "MapInPandas" not in text
