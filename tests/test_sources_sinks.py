"""Readers, rescue, tables, the layered flow and streaming ingestion."""

from __future__ import annotations

import json
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck import sinks, sources
from quarterdeck.operators import (
    Rule,
    RuleViolation,
    dedupe_by_key,
    period_totals,
    two_way_difference,
)
from quarterdeck.plans import layers, sql_twins
from quarterdeck.plans.layers import DELIMITED_FILES, DOCUMENT_FILE, Flow, Questions
from quarterdeck.sinks import clustered, current_version, ensure_schema, publish, publish_query, versions
from quarterdeck.functions import interleaved
from quarterdeck.sources import file_headers, file_ranges, files_touched, read_by_header, read_with_rescue
from quarterdeck.streaming import ingest_available
from quarterdeck.workspace import Settings, named_parameter, scratch_path


def test_padded_delimited(spark, tmp_path):
    (tmp_path / "f").write_text("series_id   \tyear\t    value\nS1   \t2020\t   1.5\nS2\t\t-\n")
    df = sources.read_delimited(spark, str(tmp_path / "f"))
    assert df.dtypes == [("series_id", "string"), ("year", "string"), ("value", "string")]
    assert [tuple(r) for r in df.collect()] == [("S1   ", "2020", "   1.5"), ("S2", None, "-")]


def test_rescue_keeps_every_line(spark, tmp_path):
    (tmp_path / "f").write_text("id\tv\n 1 \t 2.5 \n2\tbad\n3\n4\t1\textra\n")
    schema = T.StructType.fromDDL("id int, v double")
    df = sources.read_with_rescue(spark, str(tmp_path / "f"), schema)
    assert [tuple(r) for r in df.collect()] == [
        (1, 2.5, None),
        (2, None, "2\tbad"),
        (3, None, "3"),
        (4, 1.0, "4\t1\textra"),
    ]
    # Counting needs no field at all, yet must still see the bad lines.
    assert df.where(F.col(sources.RESCUED).isNotNull()).count() == 3


RECORDS = [
    {"Nation ID": "07042XX", "Nation": "United States", "Year": 2013, "Population": 5},
    {"Nation ID": "07042XX", "Nation": "United States", "Year": 2014, "Population": 6},
]
DOCUMENT = {"annotations": {"source": "x"}, "data": RECORDS, "columns": ["a"], "page": {"limit": 0}}
NAMES = {"Nation ID": "nation_id", "Nation": "nation", "Year": "year", "Population": "population"}


@pytest.mark.parametrize("indent, multi_line", [(None, False), (2, True)])
def test_document_records(spark, tmp_path, indent, multi_line):
    (tmp_path / "d.json").write_text(json.dumps(DOCUMENT, indent=indent))
    documents = sources.read_documents(spark, str(tmp_path / "d.json"), multi_line=multi_line)
    got = sources.explode_records(documents, "data", {**NAMES, "Other": "other"})
    assert sorted(got.columns) == ["nation", "nation_id", "population", "year"]
    assert sorted(r.year for r in got.collect()) == [2013, 2014]


def test_pretty_document_needs_multi_line(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(DOCUMENT, indent=2))
    assert sources.read_documents(spark, str(tmp_path / "d.json")).columns == ["_corrupt_record"]


def test_empty_arrays_give_no_rows(spark):
    df = spark.createDataFrame([([],), (None,)], "data array<struct<a:int>>")
    assert sources.explode_records(df).count() == 0


def test_named_parameters(spark):
    spark.conf.set("spark.quarterdeck.gold", "answers")
    spark.conf.set("spark.quarterdeck.silver", "")
    try:
        assert named_parameter(spark, "gold", "gold") == "answers"
        settings = Settings.from_session(spark)
        assert (settings.gold, settings.silver, settings.bronze) == ("answers", "silver", "bronze")
    finally:
        spark.conf.unset("spark.quarterdeck.gold")
        spark.conf.unset("spark.quarterdeck.silver")


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(base) and one != two


def test_publish_is_idempotent_and_described(spark, tmp_path):
    ensure_schema(spark, "pub", str(tmp_path / "pub"))
    ensure_schema(spark, "pub", str(tmp_path / "pub"))
    df = spark.range(5).withColumn("k", F.lit("it's"))
    for _ in range(2):
        table = publish(df, "pub.t", "it's a table", {"quality": "gold"}, cluster_by="id")
        assert table.count() == 5
    assert spark.catalog.getTable("pub.t").description == "it's a table"
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES pub.t").collect()}
    assert properties["quality"] == "gold"
    view = publish_query(spark, "pub.v", "SELECT max(id) AS m FROM {t}", {"t": table}, "largest")
    assert view.first().m == 4


def test_clustering_splits_a_hot_key(spark):
    rows = 30_000
    key = F.when(F.col("id") < rows * 0.6, 0).otherwise(F.col("id"))
    df = spark.range(rows).select(key.alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = clustered(df, "k").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == rows and max(sizes) < rows * 0.25


def test_buckets_save_the_shuffle_of_a_grouping(spark, tmp_path):
    ensure_schema(spark, "buck", str(tmp_path / "buck"))
    df = spark.range(200).select(
        (F.col("id") % 10).cast("string").alias("series_id"),
        (F.col("id") / 10).cast("int").alias("year"),
        F.lit("Q01").alias("period"),
        F.col("id").cast("double").alias("value"),
    )
    table = publish(df, "buck.t", bucket_by=("series_id", "year"), buckets=4)
    totals = period_totals(table, title=None)
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    assert totals.count() == 200
    assert len(list((tmp_path / "buck").glob("t__v*/*.parquet"))) == 4


def test_sorting_after_dedupe_is_free(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("string"))
    kept = dedupe_by_key(df, "k").sortWithinPartitions("k")
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == 2 and text.count("Exchange") == 1


def test_stream_ingest_takes_each_file_once(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    schema = spark.range(1).schema
    spark.range(10).coalesce(1).write.parquet(source)
    assert ingest_available(spark, source, target, marks, schema).count() == 10
    spark.range(10, 13).coalesce(1).write.mode("append").parquet(source)
    assert ingest_available(spark, source, target, marks, schema).count() == 13
    assert ingest_available(spark, source, target, marks, schema).count() == 13


def test_stream_ingest_of_padded_text(spark, tmp_path):
    source, target, marks = (tmp_path / n for n in ("in", "out", "marks"))
    source.mkdir()
    for n in (1, 2):
        (source / f"f{n}.txt").write_text(f"series_id  \t  value\nS{n}  \t 1\n")
    (source / "notes.md").write_text("not data")
    got = ingest_available(
        spark,
        str(source),
        str(target),
        str(marks),
        T.StructType.fromDDL("series_id string, value string"),
        "csv",
        files="*.txt",
        files_per_batch=1,
        options={"sep": "\t", "header": "true"},
    )
    assert sorted(tuple(r) for r in got.collect()) == [("S1  ", " 1"), ("S2  ", " 1")]


# --- the layered flow ----------------------------------------------------------------

FILES = {
    "data": [
        "series_id        \tyear\tperiod\t       value\tfootnote_codes",
        "FLOW0000042      \t2013\tQ01\t         0.5\t",
        "FLOW0000042      \t2013\tQ02\t         0.7\t",
        "FLOW0000042      \t2013\tQ05\t        99.0\t",
        "FLOW0000042      \t2020\tQ01\t        -7.0\tR",
        "FLOW0000042      \t2020\tQ01\t        -7.0\tR",
        "FLOW0000007      \t2014\tQ05\t         3.0\t",
        "FLOW0000007      \t2015\tQ05\t         3.0\t",
        "\t2015\tQ05\t         8.0\t",
    ],
    "series": [
        "series_id        \tsector_code\tclass_code\tmeasure_code\tduration_code\tseasonal",
        "FLOW0000042      \t4711\t6\t03 \t2\tS",
    ],
    "sector": ["sector_code\tsector_name", "4711 \tFoundries"],
    "class": ["class_code\tclass_text", "6\tCrews"],
    "measure": ["measure_code\tmeasure_text", "03\tShifts"],
    "duration": ["duration_code\tduration_text", "9\tIndex"],
}


def land(root, files, records):
    (root / "landing/series").mkdir(parents=True)
    (root / "landing/population").mkdir()
    for name, lines in files.items():
        (root / "landing/series" / DELIMITED_FILES[name]).write_text("\n".join(lines) + "\n")
    (root / "landing/population" / DOCUMENT_FILE).write_text(json.dumps({"data": records}))


def record(year, population, nation="United States"):
    return {"Nation ID": "07042XX", "Nation": nation, "Year": year, "Population": population}


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("flow")
    years = {2013: 10, 2014: 20, 2015: 30, 2021: 40, None: 50}
    records = [record(y, p) for y, p in years.items()] + [record(2013, 1, "Elsewhere")]
    land(root, FILES, records)
    settings = Settings(f"{root}/landing", "t_bronze", "t_silver", "t_gold")
    run = Flow(spark, settings, Questions(series_id="FLOW0000042"), str(root))
    metrics = run.run()
    return spark, run, metrics


def test_flow_labels(flow):
    spark, _, _ = flow
    silver = spark.read.table("t_silver.facts")
    assert silver.count() == 6
    titles = {r.series_id: r.series_title for r in silver.collect()}
    assert titles == {"FLOW0000042": "Foundries, Crews, Shifts", "FLOW0000007": ""}


def test_flow_answers(flow):
    spark, _, _ = flow
    stats = spark.read.table("t_gold.pop_stats").first()
    assert (stats.mean_population, stats.stddev_population) == (20.0, 10.0)
    best = sorted((r.series_id, r.year, r.yearly_sum) for r in spark.read.table("t_gold.best_year").collect())
    assert best == [("FLOW0000007", 2014, 3.0), ("FLOW0000007", 2015, 3.0), ("FLOW0000042", 2013, 1.2)]
    values = sorted(tuple(r) for r in spark.read.table("t_gold.value_pop").collect())
    assert values == [("FLOW0000042", 2013, "Q01", 0.5, 10), ("FLOW0000042", 2020, "Q01", -7.0, None)]


def test_flow_metrics(flow):
    _, _, metrics = flow
    got = {r.rule: (r.rows, r.failed, r.dropped) for r in metrics.collect()}
    assert got == {
        "non_null_series_id": (8, 1, 1),
        "non_null_year": (6, 1, 1),
        "no_year_gap": (4, 1, 0),
    }


def test_flow_rerun_converges(flow):
    spark, run, _ = flow
    before = spark.read.table("t_gold.best_year").collect()
    run.run()
    assert sorted(before) == sorted(spark.read.table("t_gold.best_year").collect())


def test_flow_against_sql(flow):
    spark, _, _ = flow
    twin = sql_twins.best_year_sql(spark.read.table("t_silver.facts"))
    assert tuple(two_way_difference(spark.read.table("t_gold.best_year"), twin).first()) == (0, 0)


def test_flow_over_empty_facts_and_reference(spark, tmp_path):
    land(tmp_path, {name: lines[:1] for name, lines in FILES.items()}, [record(None, 1)])
    settings = Settings(f"{tmp_path}/landing", "e_bronze", "e_silver", "e_gold")
    fields = "`Nation ID`: string, Nation: string, Year: int, Population: bigint"
    schema = f"data array<struct<{fields}>>"
    metrics = Flow(spark, settings, Questions(series_id="FLOW0000042"), str(tmp_path), schema).run()
    assert {r.rule: (r.rows, r.failed) for r in metrics.collect()} == {
        "non_null_series_id": (0, 0),
        "non_null_year": (1, 1),
        "no_year_gap": (0, 0),
    }
    assert spark.read.table("e_gold.best_year").count() == 0
    assert tuple(spark.read.table("e_gold.pop_stats").first()) == (None, None)


def test_flow_stops_on_a_fatal_rule_before_publishing(spark, tmp_path, monkeypatch):
    land(tmp_path, FILES, [record(2013, 1)])
    settings = Settings(f"{tmp_path}/landing", "f_bronze", "f_silver", "f_gold")
    strict = (Rule("key_present", "series_id IS NOT NULL", "fail"),)
    monkeypatch.setattr(layers, "FACT_RULES", strict)
    with pytest.raises(RuleViolation, match="data.key_present: 1 of 8 rows"):
        Flow(spark, settings, Questions(series_id="FLOW0000042"), str(tmp_path)).run()
    assert not spark.catalog.tableExists("f_bronze.raw_data")
    assert not spark.catalog.tableExists("f_silver.facts")


def test_a_failing_rewrite_keeps_the_old_rows(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS rewrites")
    publish(spark.range(3).toDF("n"), "rewrites.t", "first")
    bad = spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('broken') ELSE id END AS n")
    with pytest.raises(Exception, match="broken"):
        publish(bad, "rewrites.t", "second")
    assert spark.read.table("rewrites.t").count() == 3
    assert [t.name for t in spark.catalog.listTables("rewrites") if "__v" not in t.name] == ["t"]
    assert len(versions(spark, "rewrites.t")) == 1
    again = publish(spark.read.table("rewrites.t").selectExpr("n + 1 AS n"), "rewrites.t", "third")
    assert sorted(r.n for r in again.collect()) == [1, 2, 3]
    assert "third" in str(spark.sql("DESCRIBE TABLE EXTENDED rewrites.t").collect())


def test_a_crash_between_writing_and_switching_keeps_the_old_rows(spark, monkeypatch):
    spark.sql("CREATE SCHEMA IF NOT EXISTS crashes")
    publish(spark.range(3).toDF("n"), "crashes.t", "first", {"quality": "gold"})
    shown = current_version(spark, "crashes.t")

    def dies(*_):
        raise SystemExit

    with monkeypatch.context() as m:
        m.setattr(sinks, "switch", dies)
        with pytest.raises(SystemExit):
            publish(spark.range(9).toDF("n"), "crashes.t", "second")
    assert spark.read.table("crashes.t").count() == 3 and current_version(spark, "crashes.t") == shown
    assert len(versions(spark, "crashes.t")) == 2  # what the dead run left
    publish(spark.range(5).toDF("n"), "crashes.t", "third", {"quality": "silver"})
    assert spark.read.table("crashes.t").count() == 5
    assert versions(spark, "crashes.t") == [shown, current_version(spark, "crashes.t")]
    told = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES crashes.t").collect()}
    assert told["quality"] == "silver" and "third" in str(spark.sql("DESCRIBE TABLE EXTENDED crashes.t").collect())


def test_readers_never_miss_the_table_while_it_is_replaced(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS loops")
    publish(spark.range(10).selectExpr("0 AS round", "id"), "loops.t")
    done, seen, failed = threading.Event(), [], []

    def read():
        while not done.is_set():
            try:
                row = spark.sql("SELECT min(round) AS a, max(round) AS b, count(*) AS n FROM loops.t").first()
                seen.append((row.a, row.b, row.n))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for i in range(1, 6):
        publish(spark.range(10 + i).selectExpr(f"{i} AS round", "id"), "loops.t")
    done.set()
    for r in readers:
        r.join()
    assert not failed and seen and all(a == b and n == 10 + a for a, b, n in seen)
    assert len(versions(spark, "loops.t")) == 2


def test_a_plain_table_becomes_a_version(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS plain")
    spark.range(4).write.saveAsTable("plain.t")
    assert current_version(spark, "plain.t") is None
    publish(spark.read.table("plain.t").selectExpr("id + 1 AS id"), "plain.t")
    assert sorted(r.id for r in spark.read.table("plain.t").collect()) == [1, 2, 3, 4]
    assert len(versions(spark, "plain.t")) == 2


def lay(tmp_path, **files):
    for name, lines in files.items():
        (tmp_path / f"{name}.tsv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def by_header(spark, path, ddl):
    df = read_by_header(spark, path, T.StructType.fromDDL(ddl))
    assert df.schema["_rescued"].dataType == T.VariantType()
    rows = df.selectExpr("* EXCEPT (_rescued)", "to_json(_rescued) AS kept").collect()
    return sorted(((*tuple(r)[:-1], json.loads(r.kept) if r.kept else None) for r in rows), key=repr)


def test_columns_are_found_by_each_files_header(spark, tmp_path):
    path = lay(
        tmp_path,
        a=["id  \t v", "1\t10", "2 \tx", "", "3\t"],
        b=["v\tid\tnote", "40\t4\thello", "50\t5\t", "60\t6\tn\textra\t\tmore"],
        c=["other\tid", "o\t7", "8"],
        d=["id\tid\tv", "9\tagain\t90"],
        e=["id\tv"],
    )
    assert by_header(spark, path, "id long, v int") == sorted(
        [
            (1, 10, None), (2, None, {"v": "x"}), (3, None, None),
            (4, 40, {"note": "hello"}), (5, 50, None), (6, 60, {"note": "n", "#4": "extra", "#6": "more"}),
            (7, None, {"other": "o"}), (None, None, {"other": "8", "#fields": "1"}),
            (9, 90, {"id#2": "again"}),
        ],
        key=repr,
    )


def test_files_cut_into_blocks_have_one_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = lay(tmp_path / "in", a=["v\tid", *(f"{i}\t{i + 1}" for i in range(20_000))], b=["id\tv", *(f"{i + 1}\t{i}" for i in range(20_000))])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_by_header(spark, path, T.StructType.fromDDL("id long, v long"))
        assert df.rdd.getNumPartitions() > 2
        assert df.where("id = v + 1 AND _rescued IS NULL").count() == df.count() == 40_000
        assert file_headers(spark, path).count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rescue_finds_fields_by_name(spark, tmp_path):
    path = lay(tmp_path, a=["v\tid\tmore", "30\t3\tm", "x\t4\tm"])
    df = read_with_rescue(spark, path, T.StructType.fromDDL("id long, v int, absent string"))
    assert sorted(map(tuple, df.collect())) == [(3, 30, None, None), (4, None, None, "x\t4\tm")]
    with pytest.raises(ValueError, match="has none of the columns"):
        read_with_rescue(spark, path, T.StructType.fromDDL("nothing int"))


def test_bits_take_turns(spark):
    df = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01), (5, 3)], "a int, b int")
    got = [r[0] for r in df.select(interleaved([F.col("a"), F.col("b")], 3)).collect()]
    assert got == [0b0101, 0b1010, 0b0110, 0b011011]
    with pytest.raises(ValueError):
        interleaved([F.col("a")] * 5, 16)


def test_a_curve_is_narrow_in_every_key(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "id % 100 AS a", "date_add(date'2020-01-01', cast(hash(id) % 300 AS int)) AS d", "concat('s', id % 37) AS s", "if(id % 50 = 0, null, id) AS x"
    )
    for name, options in {"curve": {"curve_by": ("a", "d")}, "plain": {"cluster_by": ("a", "d")}}.items():
        clustered(df, ("a", "d"), curve=name == "curve", files=16).write.parquet(str(tmp_path / name))
        ranges = file_ranges(spark.read.parquet(str(tmp_path / name)), ("a", "d"))
        touched = {c: files_touched(ranges, c, v).first() for c, v in (("a", 50), ("d", date(2020, 1, 1)))}
        assert touched["a"].files == 16 and touched["a"].touched < 9
        assert (touched["d"].touched < 9) == (name == "curve")
        ensure_schema(spark, "curves", str(tmp_path / "curves"))
        assert publish(df, f"curves.{name}", **options).exceptAll(df).isEmpty()
    assert clustered(df, ("s", "x"), curve=True).count() == 20_000
    assert clustered(df.limit(0), ("a", "x"), curve=True).count() == 0


def test_flow_keeps_a_history_of_its_rules(spark, tmp_path):
    settings = Settings(f"{tmp_path}/landing", "h_bronze", "h_silver", "h_gold")
    land(tmp_path, FILES, [record(2013, 1)])
    run = Flow(spark, settings, Questions(series_id="FLOW0000042"), str(tmp_path), history=str(tmp_path / "history"))
    for number in (1, 2, 2):
        run.run(number)
    assert run.unusual(least=1).count() == 0
    (tmp_path / "landing/population" / DOCUMENT_FILE).write_text(json.dumps({"data": [record(y, 1) for y in range(2000, 2009)] + [record(None, 1)]}))
    run.run(3)
    told = {(r.dataset, r.check): (r.run, r.number, r.upper) for r in run.unusual(least=2).collect()}
    assert told["raw_population", "rows"] == (3, 10, 1.1) and told["raw_population", "non_null_year"] == (3, 1, 0.0)
    assert set(told) == {("raw_population", "rows"), ("raw_population", "non_null_year"), ("population_coverage", "rows")}
