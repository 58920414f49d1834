"""Typing, trimming, de-duplication, lookups and titles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions import (
    clean_names,
    display_integer,
    display_number,
    rename_columns,
    series_title,
)
from quarterdeck.operators import (
    Lookup,
    broadcast_if_small,
    clean_facts,
    dedupe_by_key,
    frequent_codes,
    label_facts,
    left_lookup,
    lookup_resolution,
    reference_years,
    salted_lookup,
    two_way_difference,
    typed_clean,
    unique_codes,
)


def test_names(spark):
    df = spark.createDataFrame([("a", "b")], "`series_id    ` string, `   value` string")
    assert clean_names(df).columns == ["series_id", "value"]
    assert rename_columns(clean_names(df), {"value": "v", "none": "x"}).columns == ["series_id", "v"]


def test_display(spark):
    got = spark.range(1).select(
        display_number(F.lit(1234567.5)).alias("a"),
        display_number(F.lit(1234567.5), 0).alias("b"),
        display_integer(F.lit(2021)).alias("c"),
    )
    assert tuple(got.first()) == ("1,234,567.50", "1,234,568", "2021")


def test_bad_text_becomes_null(spark):
    rows = [(" 12 ", " 1.005 "), ("-", "-"), (None, "x")]
    df = spark.createDataFrame(rows, "year string, value string")
    got = typed_clean(df, ("year", "value"), {"year": "int", "value": "double"}, {"value": 2})
    assert [tuple(r) for r in got.collect()] == [(12, 1.01), (None, None), (None, None)]


def test_clean_facts_trims_casts_and_keeps_one_row(spark):
    raw = spark.createDataFrame(
        [
            ("S1  ", "2020", " Q01", "  1.005", "x"),
            ("S1", " 2020", "Q01", "0.5", "y"),
            ("S1", "2020", "Q02", "-", "z"),
        ],
        "series_id string, year string, period string, value string, footnote string",
    )
    got = sorted(tuple(r) for r in clean_facts(raw).collect())
    assert got == [("S1", 2020, "Q01", 1.01, "x"), ("S1", 2020, "Q02", None, "z")]


def test_dedupe_is_repeatable_and_null_keys_are_one_key(spark):
    rows = [(1, "b"), (1, "a"), (1, None), (None, "d"), (None, "c"), (2, None)]
    df = spark.createDataFrame(rows, "k int, v string")
    for parts in (1, 5):
        got = dedupe_by_key(df.repartition(parts), "k")
        assert {r.k: r.v for r in got.collect()} == {1: "b", 2: None, None: "d"}
    first = dedupe_by_key(df, "k", order=[F.asc_nulls_last("v")])
    assert {r.k: r.v for r in first.collect()} == {1: "a", 2: None, None: "c"}


def test_both_ways_to_dedupe_agree(spark):
    df = spark.range(500).select(
        (F.pmod(F.xxhash64("id"), F.lit(60))).alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 5).alias("a"),
        F.array((F.col("id") % 7).cast("string")).alias("b"),
        F.col("id").alias("c"),
    )
    one = dedupe_by_key(df, "k", ("b", "a"))
    same = [F.desc_nulls_last("b"), F.desc_nulls_last("a")]
    two = dedupe_by_key(df, "k", ("b", "a"), order=same)
    assert one.columns == two.columns == df.columns
    assert one.count() == df.select("k").distinct().count()
    assert tuple(two_way_difference(one, two).first()) == (0, 0)


def test_dedupe_with_a_map_or_with_keys_only(spark):
    rows = [(1, {"a": 1}, 2), (1, {"a": 2}, 3)]
    df = spark.createDataFrame(rows, "k int, m map<string,int>, v int")
    assert [r.v for r in dedupe_by_key(df, "k").collect()] == [3]
    assert dedupe_by_key(df.select("k"), "k").count() == 1


def test_dedupe_drops_copies_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") / 400).cast("int").alias("k"), "id")
    text = dedupe_by_key(df, "k", order=[F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    wide = df.withColumn("t", F.col("id").cast("string"))
    text = dedupe_by_key(wide, "k")._jdf.queryExecution().executedPlan().toString()
    assert text.index("[max(") < text.index("Exchange") < text.index("[partial_max(")


def test_title_skips_nulls_and_is_never_null(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    got = [r[0] for r in df.select(series_title(["x", "y", "z"])).collect()]
    assert got == ["a, c", ""]


def test_labels(spark):
    facts = spark.createDataFrame(
        [("S1", 1.0), ("S2", 2.0), ("S3", 3.0), (None, 4.0)], "series_id string, value double"
    )
    series = spark.createDataFrame(
        [("S1 ", "A ", "1"), ("S2", "B", "9")], "series_id string, sector_code string, class_code string"
    )
    sector = spark.createDataFrame([(" A", "Farms"), ("B ", "Mines")], "sector_code string, sector_name string")
    cls = spark.createDataFrame([("1", "Workers")], "class_code string, class_text string")
    got = label_facts(
        facts,
        series,
        [Lookup(sector, "sector_code", "sector_name"), Lookup(cls, "class_code", "class_text")],
    )
    assert got.columns == [
        "series_id", "value", "sector_code", "class_code", "sector_name", "class_text", "series_title",
    ]
    assert sorted((r.value, r.sector_name, r.class_text, r.series_title) for r in got.collect()) == [
        (1.0, "Farms", "Workers", "Farms, Workers"),
        (2.0, "Mines", None, "Mines"),
        (3.0, None, None, ""),
        (4.0, None, None, ""),
    ]
    missing = {r.label: (r.rows, r.missing) for r in lookup_resolution(got, ["sector_name", "class_text"]).collect()}
    assert missing == {"sector_name": (4, 2), "class_text": (4, 3)}


def test_a_lookup_may_carry_the_code_of_the_next(spark):
    facts = spark.createDataFrame([(" S1",)], "series_id string")
    series = spark.createDataFrame([("S1", "7 ")], "series_id string, nation string")
    nations = spark.createDataFrame([("7", "Chile", " 1 ")], "nation string, name string, region string")
    regions = spark.createDataFrame([("1", "America")], "region string, region_name string")
    got = label_facts(
        facts,
        series,
        [Lookup(nations, "nation", ("name", "region")), Lookup(regions, "region", "region_name")],
        title_of=("region_name", "name"),
    )
    assert got.first().series_title == "America, Chile"


def test_codes_that_differ_in_padding_do_not_multiply_facts(spark):
    facts = spark.createDataFrame([("S1", "x"), (" S1 ", "y"), ("S2", "z")], "series_id string, f string")
    series = spark.createDataFrame([("S1", "A"), ("S1 ", "A "), ("S2", "B")], "series_id string, code string")
    twice = spark.createDataFrame([("A", "one"), ("A ", "two"), (" A", "one")], "code string, label string")
    got = label_facts(facts, series, [Lookup(twice, "code", "label")])
    assert sorted((r.f, r.label) for r in got.collect()) == [("x", "two"), ("y", "two"), ("z", None)]
    assert sorted((r.code, r.label) for r in left_lookup(series, Lookup(twice, "code", "label")).collect()) == [("A", "two")] * 2 + [("B", None)]


def test_codes_that_disagree_can_stop_the_job(spark):
    facts = spark.createDataFrame([("A",)], "code string")
    agree = spark.createDataFrame([("A", "one"), (" A", "one"), ("B", None), ("B ", None)], "code string, label string")
    assert left_lookup(facts, Lookup(agree, "code", "label", "raise")).count() == 1
    differ = agree.unionAll(spark.createDataFrame([("A  ", "two")], agree.schema))
    with pytest.raises(Exception, match="disagree for code A"):
        left_lookup(facts, Lookup(differ, "code", "label", "raise")).collect()
    with pytest.raises(ValueError):
        unique_codes(agree, "code", "any")


def test_salting_frequent_codes(spark):
    facts = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN ' hot' WHEN id % 3 = 1 THEN NULL ELSE concat('c', id % 5000) END AS code", "id"
    )
    assert frequent_codes(facts, "code", 0.1) == [" hot"]
    table = spark.createDataFrame([("hot", "H"), ("hot ", "H"), (" hot", "G")] + [(f"c{i}", f"l{i}") for i in range(4000)], "code string, label string")
    lookup = Lookup(table, "code", "label")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = salted_lookup(facts, lookup, salts=16, share=0.1)
        assert salted.columns == ["code", "id", "label"]
        assert salted.exceptAll(left_lookup(facts, lookup)).isEmpty() and salted.count() == facts.count()
        assert salted.where("label = 'H'").count() == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_broadcast_only_when_measured_small(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    small, wide = spark.range(10), spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert hinted(broadcast_if_small(small))
    assert not hinted(broadcast_if_small(small, max_rows=9))
    assert not hinted(broadcast_if_small(wide, max_bytes=999))


def test_reference_years(spark):
    records = spark.createDataFrame(
        [("US", "2013", "5"), ("US", "2013", "5"), ("US", "2014", "7"), ("CA", "2014", "1")],
        "nation string, year string, population string",
    )
    got = reference_years(records, {"nation": "US"})
    assert got.dtypes == [("year", "int"), ("population", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == [(2013, 5), (2014, 7)]


def test_facts_dealt_out_by_series_are_the_same_and_meet_their_series_where_they_are(spark):
    rows = [(f" S{i % 40 if i % 2 else 0} ", str(2000 + i % 5), f"Q0{i % 4 + 1}", str(i), "f") for i in range(2000)]
    rows += [(None, "2000", "Q01", "1", "f"), (None, "2000", "Q01", "2", "f")]
    raw = spark.createDataFrame(rows, "series_id string, year string, period string, value string, footnote string")
    dealt = clean_facts(raw, parts=5)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, clean_facts(raw).collect()))
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    # S0 has half of the rows and is made unique before the rest is dealt out
    assert dealt._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
    series = spark.createDataFrame([("S1", "c1"), ("S2 ", "c2")], "series_id string, code string").hint("merge")
    lookup = Lookup(spark.createDataFrame([("c1", "one")], "code string, text string").hint("broadcast"), "code", "text")
    facts = clean_facts(raw, parts=16)
    labelled = label_facts(facts, series, [lookup], trimmed=True)
    text = labelled._jdf.queryExecution().executedPlan().toString()
    again = label_facts(facts, series, [lookup])._jdf.queryExecution().executedPlan().toString()
    # the series come to the facts' 16 parts; facts trimmed once more would be dealt out again
    assert "SortMergeJoin" in text and "16), ENSURE_REQUIREMENTS" in text and "16), ENSURE_REQUIREMENTS" not in again
    assert sorted(map(repr, labelled.collect())) == sorted(map(repr, label_facts(clean_facts(raw), series, [lookup]).collect()))
