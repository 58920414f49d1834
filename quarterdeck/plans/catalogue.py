"""Every operator as a query over the given tables.

The tables play these roles:

* facts: line items, unaggregated. A series is a part under one return flag. Flags N and A
  report quarters and, for every third line, the annual code beside them, often in the same title
  and year; flag R reports under the annual code only. The title is made of flag and status, is
  shared by many series and varies within one. It is grouped by its code, the status, and spelled
  out on the answer: text stays out of the shuffles.
* annual reference: orders per year; one form of it lacks 1998, a year that was never published.
* landing zone: links of the pages; the https site is the listing, the http site what has
  been landed from its predecessor.
* snapshots and files seen: events, a file being a user's stream of one event type.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck import operators as ops
from quarterdeck import sources
from quarterdeck.functions import series_title
from quarterdeck.plans import sql_twins
from quarterdeck.plans.layers import DELIMITED_FILES, DOCUMENT_FILE, Flow, Questions
from quarterdeck.refresh import BestYears, NewestRows
from quarterdeck.sinks import clustered, ensure_schema, publish, publish_query
from quarterdeck.streaming import ingest_available, upsert_available
from quarterdeck.workspace import CONF_PREFIX, Settings, parts_for, scratch_path, written

SERIES = ("l_partkey", "l_returnflag")
TITLE_CODE = "l_linestatus"
ANNUAL_ONLY, ANNUAL_EVERY = "R", 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)").alias(name)


def _day(name: str) -> Column:
    """Dates leave the catalogue as ISO text, which every client reads alike."""
    return F.col(name).cast("string").alias(name)


def facts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    annual = (F.col("l_returnflag") == ANNUAL_ONLY) | (F.col("l_linenumber") % ANNUAL_EVERY == 0)
    return table(spark, sf_dir, "lineitem").select(
        *SERIES,
        TITLE_CODE,
        F.year("l_shipdate").alias("year"),
        F.when(annual, F.lit(ops.ANNUAL))
        .otherwise(F.elt(F.quarter("l_shipdate"), *(F.lit(q) for q in ops.QUARTERS)))
        .alias("period"),
        F.col("l_quantity").alias("value"),
        *more,
    )


def _titled(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "series_title",
        series_title(
            [F.concat(F.lit("Flag "), "l_returnflag"), F.concat(F.lit("status "), TITLE_CODE)]
        ),
    )


def _answer(best: DataFrame) -> DataFrame:
    return _titled(best).select(*SERIES, "series_title", "year", _money("yearly_sum"))


def fact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts with one value per part, year and period."""
    return (
        facts(spark, sf_dir)
        .groupBy("l_partkey", "year", "period")
        .agg(F.sum("value").cast("decimal(18,2)").alias("value"))
    )


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("population"))
    )


def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference with a hole."""
    return yearly_orders(spark, sf_dir).where(F.col("year") != 1998)


def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answer(ops.best_year(facts(spark, sf_dir), series=SERIES, title=TITLE_CODE))


# --- time-series answers -------------------------------------------------------------


def best_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winners(spark, sf_dir)


def best_year_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    twin = sql_twins.best_year_sql(_titled(facts(spark, sf_dir)), SERIES)
    return twin.withColumn("yearly_sum", _money("yearly_sum"))


def best_year_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answer(ops.best_year_single(facts(spark, sf_dir), series=SERIES, title=TITLE_CODE))


def period_rule_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.period_rule_audit(facts(spark, sf_dir), series=SERIES, title=TITLE_CODE)


def equivalence_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.two_way_difference(winners(spark, sf_dir), best_year_sql(spark, sf_dir))


def twins_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three answers as published SELECTs against the operators: rows that only one side has."""
    run = scratch_path(spark, "twins")
    schema = f"twins_{run.rsplit('-', 1)[-1]}"
    ensure_schema(spark, schema, run)
    reference, totals = published_orders(spark, sf_dir), fact_totals(spark, sf_dir)
    selects = {
        "best_year": (
            sql_twins.best_year_select(SERIES),
            {},
            {"facts": sql_twins.by_series(_titled(facts(spark, sf_dir)), SERIES)},
            ops.best_year(_titled(facts(spark, sf_dir)), series=SERIES),
        ),
        "range_stats": (
            sql_twins.RANGE_STATS,
            {"start": 1996, "end": 2000},
            {"reference": reference},
            ops.range_stats(reference, 1996, 2000),
        ),
        "keyed_value": (
            sql_twins.keyed_value_select(["l_partkey"]),
            {"l_partkey": 25, "period": ops.ANNUAL},
            {"facts": totals, "reference": reference},
            ops.keyed_value_with_reference(totals, reference, {"l_partkey": 25}, ops.ANNUAL),
        ),
    }
    out = None
    for name, (select, args, inputs, answer) in selects.items():
        published = publish_query(spark, f"{schema}.{name}", select, inputs, f"{name} by a SELECT", args=args)
        line = ops.two_way_difference(answer, published).select(F.lit(name).alias("answer"), "only_left", "only_right")
        out = line if out is None else out.unionAll(line)
    return out


def best_year_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer out of three batches. In the first, some values are too large, in the second some
    years too late; the third takes those facts back and brings the right ones, and comes twice."""
    lines = facts(spark, sf_dir, "l_orderkey", "l_linenumber").withColumn("value", _money("value"))
    fourth = F.col("l_orderkey") % 4
    inflated = (fourth == 1) & (F.col("l_linenumber") == 1)
    late = (fourth == 0) & (F.col("l_linenumber") == 2)
    told = lines.withColumns(
        {
            "value": F.when(inflated, F.col("value") + 7).otherwise(F.col("value")).cast("decimal(18,2)"),
            "year": F.when(late, F.col("year") + 1).otherwise(F.col("year")),
        }
    )
    wrong = inflated | late
    corrections = told.where(wrong).withColumn("weight", F.lit(-1)).unionByName(lines.where(wrong).withColumn("weight", F.lit(1)))
    kept = BestYears(spark, scratch_path(spark, "best-years"), SERIES, TITLE_CODE, buckets=16)
    kept.refresh(told.where(fourth != 0), 1)
    kept.refresh(told.where(fourth == 0), 2)
    for _ in range(2):
        kept.refresh(corrections, 3, "weight")
    return _answer(kept.current())


def range_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = ops.range_stats(yearly_orders(spark, sf_dir), 1996, 2000)
    return stats.select(*(_money(c) for c in stats.columns))


def keyed_value_with_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part's annual values; 1998 has no reference and stays with a null."""
    return ops.keyed_value_with_reference(
        fact_totals(spark, sf_dir),
        published_orders(spark, sf_dir),
        {"l_partkey": 25},
        ops.ANNUAL,
    )


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.coverage_gaps(published_orders(spark, sf_dir))


def coverage_gaps_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return ops.coverage_gaps_by_key(days, "user_id", "day").withColumn("day", _day("day"))


# --- cleaning and labels -------------------------------------------------------------


def reference_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts arrive per status as text, the way raw records do; one status is the
    nation asked for."""
    records = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("nation"), F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).cast("string").alias("population"))
        .withColumn("year", F.col("year").cast("string"))
    )
    return ops.reference_years(records, {"nation": "F"})


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    unique = ops.dedupe_by_key(lines, ("l_orderkey", "l_linenumber"), "l_shipdate")
    return unique.withColumns(
        {"l_shipdate": F.to_date("l_shipdate").cast("string"), "l_quantity": _money("l_quantity")}
    )


def typed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as padded text, a dash standing for sizes of five and below."""
    raw = table(spark, sf_dir, "part").select(
        F.format_string("  %d ", "p_partkey").alias("p_partkey"),
        F.concat(F.lit(" "), "p_brand", F.lit("   ")).alias("p_brand"),
        F.when(F.col("p_size") <= 5, F.lit(" - "))
        .otherwise(F.concat(F.lit("  "), F.col("p_size").cast("string")))
        .alias("p_size"),
        F.concat(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("4 ")).alias(
            "p_retailprice"
        ),
    )
    clean = ops.typed_clean(
        raw,
        trim=raw.columns,
        types={"p_partkey": "bigint", "p_size": "int", "p_retailprice": "decimal(20,3)"},
        round_to={"p_retailprice": 2},
    )
    return clean.withColumn("p_retailprice", _money("p_retailprice"))


LABELS = ("r_name", "n_name", "brand_text", "type_text")


def _by_supplier(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the region and nation of their supplier. One region is unknown to its lookup."""
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    return ops.label_facts(
        lines,
        suppliers,
        [
            ops.Lookup(nation, "s_nationkey", ("n_name", "n_regionkey")),
            ops.Lookup(region.where(F.col("r_name") != "ASIA"), "n_regionkey", "r_name"),
        ],
        "l_suppkey",
    ).drop("series_title")


def _by_part(lines: DataFrame, spark: SparkSession, sf_dir: str, title_of: tuple[str, ...]) -> DataFrame:
    """Lines with the brand and type of their part, whose codes are padded on one side."""
    part = table(spark, sf_dir, "part")
    parts = part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("brand_code"),
        F.col("p_type").alias("type_code"),
    )
    brands = part.select(
        F.col("p_brand").alias("brand_code"),
        F.concat(F.lit("Brand "), F.substring_index("p_brand", "#", -1)).alias("brand_text"),
    ).distinct()
    types = part.select(
        F.concat("p_type", F.lit(" ")).alias("type_code"), F.lower("p_type").alias("type_text")
    ).distinct()

    return ops.label_facts(
        lines,
        parts,
        [
            ops.Lookup(ops.broadcast_if_small(brands), "brand_code", "brand_text"),
            ops.Lookup(ops.broadcast_if_small(types), "type_code", "type_text"),
        ],
        "l_partkey",
        title_of=title_of,
    )


def labelled_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"
    )
    unique = ops.dedupe_by_key(lines, ("l_orderkey", "l_linenumber"))
    by_supplier = _by_supplier(unique, spark, sf_dir)
    labelled = _by_part(by_supplier, spark, sf_dir, LABELS).select(*lines.columns, *LABELS, "series_title")
    return labelled.withColumn("l_quantity", _money("l_quantity"))


def lookup_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are counted per code first, so that only the few codes are joined."""
    lines = table(spark, sf_dir, "lineitem")
    count = F.count(F.lit(1)).alias("lines")
    suppliers = _by_supplier(lines.groupBy("l_suppkey").agg(count), spark, sf_dir)
    parts = _by_part(lines.groupBy("l_partkey").agg(count), spark, sf_dir, LABELS[2:])
    return ops.lookup_resolution(suppliers, LABELS[:2], "lines").unionAll(
        ops.lookup_resolution(parts, LABELS[2:], "lines")
    )


def guarded_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and quantities per supplier name. Half of the lines stand under one code; the lookup has every
    code twice, padded in another way, and a row with a smaller name beside each."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("S1")).otherwise(F.concat(F.lit(" S"), "l_suppkey")).alias("code"), "l_quantity"
    )
    supplier = table(spark, sf_dir, "supplier")
    code = F.concat(F.lit("S"), "s_suppkey")
    spellings = F.array(
        F.struct(F.concat(code, F.lit("  ")).alias("code"), F.col("s_name").alias("label")),
        F.struct(F.concat(F.lit(" "), code).alias("code"), F.col("s_name").alias("label")),
        F.struct(code.alias("code"), F.lit("").alias("label")),
    )
    labelled = ops.salted_lookup(lines, ops.Lookup(supplier.select(F.inline(spellings)), "code", "label"))
    return labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(_money("l_quantity")).cast("decimal(18,2)").alias("quantity")
    )


# --- sources -------------------------------------------------------------------------


def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, suppliers and nations landed as padded text under padded headers, and
    read back as one table set."""
    root = scratch_path(spark, "delimited")
    shapes = {
        "customer": ("c_custkey", "c_name"),
        "supplier": ("s_suppkey", "s_name"),
        "nation": ("n_nationkey", "n_name"),
    }
    for name, (key, text) in shapes.items():
        padded = table(spark, sf_dir, name).select(
            F.format_string("%d   ", key).alias(f"{key}      "),
            F.concat(F.lit("   "), text).alias(f"   {text}"),
        )
        sources.write_delimited(padded, f"{root}/tab.{name}")
    read = sources.read_delimited_set(spark, root, {n: f"tab.{n}" for n in shapes})
    out = None
    for name, (key, text) in shapes.items():
        rows = ops.typed_clean(read[name], trim=(key, text), types={key: "bigint"}).select(
            F.lit(name).alias("source"), F.col(key).alias("code"), F.col(text).alias("label")
        )
        out = rows if out is None else out.unionAll(rows)
    return out


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per customer with two records; none for a negative balance, where the
    array is empty."""
    path = scratch_path(spark, "documents")

    def record(measure: str, amount: Column) -> Column:
        return F.struct(
            F.col("c_custkey").alias("Customer ID"),
            F.lit(measure).alias("Measure"),
            amount.cast("decimal(18,2)").alias("Amount"),
        )

    records = F.array(record("balance", F.col("c_acctbal")), record("nation", F.col("c_nationkey")))
    none = F.filter(records, lambda _: F.lit(False))
    documents = table(spark, sf_dir, "customer").select(
        F.struct(F.col("c_mktsegment").alias("segment")).alias("annotations"),
        F.when(F.col("c_acctbal") < 0, none).otherwise(records).alias("data"),
        F.lit(1).alias("page"),
    )
    documents.write.json(path)
    schema = "data array<struct<`Customer ID`: bigint, Measure: string, Amount: decimal(18,2)>>"
    return sources.explode_records(
        sources.read_documents(spark, path, schema),
        "data",
        {"Customer ID": "customer_id", "Measure": "measure", "Amount": "amount", "Absent": "absent"},
    )


def rescue_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as text in which every error event says n/a instead of a value."""
    path = scratch_path(spark, "malformed")
    lines = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
        .alias("value"),
    )
    sources.write_delimited(lines, path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, value decimal(18,2)")
    return sources.read_with_rescue(spark, path, schema).withColumnRenamed(
        sources.RESCUED, "rescued"
    )


def header_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed in files of three layouts: other orders, a column more, one less, and balances
    below zero that say overdrawn."""
    root = scratch_path(spark, "layouts")
    customer = table(spark, sf_dir, "customer")
    balance = F.when(F.col("c_acctbal") < 0, F.lit("overdrawn")).otherwise(_money("c_acctbal").cast("string"))
    told = customer.withColumn("c_acctbal", balance)
    layouts = (
        ("c_custkey", "c_name", "c_acctbal"),
        ("c_acctbal", "c_mktsegment", "c_custkey", "c_name"),
        ("c_name", "c_custkey"),
    )
    for i, names in enumerate(layouts):
        sources.write_delimited(told.where(F.col("c_custkey") % len(layouts) == i).select(*names), f"{root}/{i}")
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal decimal(18,2)")
    read = sources.read_by_header(spark, f"{root}/*", schema)
    return read.withColumn(sources.RESCUED, F.to_json(sources.RESCUED)).withColumnRenamed(sources.RESCUED, "rescued")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = T.StructType.fromDDL(
        "c_custkey bigint, c_name string, c_nationkey bigint, c_phone string, c_acctbal double"
    )
    return ops.schema_drift(table(spark, sf_dir, "customer"), expected)


# --- quality -------------------------------------------------------------------------

CUSTOMER_RULES = (
    ops.Rule("non_null_segment", "nullif(c_mktsegment, 'MACHINERY') IS NOT NULL", "drop"),
    ops.Rule("balance_not_negative", "nullif(c_nationkey, 7) >= 0 AND c_acctbal >= 0", "drop"),
    ops.Rule("known_nation", "c_nationkey BETWEEN 0 AND 24", "fail"),
)


def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = ops.check(table(spark, sf_dir, "customer"), CUSTOMER_RULES, "customer")
    return kept.withColumn("c_acctbal", _money("c_acctbal"))


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows at which a run with the stricter rule would stop, and those that would be dropped."""
    strict = (*CUSTOMER_RULES, ops.Rule("home_market", "c_nationkey < 20", "fail"))
    broken = ops.violations(table(spark, sf_dir, "customer"), strict)
    return broken.select("c_custkey", F.array_join("violated", ",").alias("violated"))


def expect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = ops.rule_metrics(table(spark, sf_dir, "customer"), CUSTOMER_RULES, "customer")
    coverage = ops.rule_metrics(
        coverage_gaps(spark, sf_dir),
        [ops.Rule("no_year_gap", "year_gap IS NULL OR year_gap = 1", "warn")],
        "coverage",
    )
    return customers.unionAll(coverage)


def volume_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    bound = F.lit("2024-02-01").cast("date")
    report = ops.volume_freshness(events, "day", "events", 1, bound)
    return report.withColumn("newest", _day("newest"))


# --- landing zone --------------------------------------------------------------------


def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.listing_links(table(spark, sf_dir, "pages"))


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of all pages, found once: whether the listing or the landing zone has them, and
    whether a page has them first."""
    links = ops.listing_links(table(spark, sf_dir, "pages"), keys="url")
    listed = F.col("url").startswith("https:")
    return links.select(
        "filename", listed.alias("listed"), (~listed).alias("held"), (F.col("position") == 0).alias("first")
    )


def _reconciled(spark: SparkSession, sf_dir: str, retain: bool = True) -> DataFrame:
    sides = _sides(spark, sf_dir)
    ops.require_listing(sides.where("listed"))
    return ops.reconcile_sides(sides, retain)


def landing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir)


def landing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.landing_summary(_reconciled(spark, sf_dir, retain=False))


def stale_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required: the first link of every page. The links are found once and written, a row per name."""
    known = _sides(spark, sf_dir).groupBy("filename").agg(
        *(F.bool_or(c).alias(c) for c in ("listed", "held", "first"))
    )
    known = written(known, "sides")
    gone = ops.unpublished(known.where("listed"), known.where("held"))
    return ops.stale_sources(known.where("first"), gone)


def landing_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards of a landing run say: of a listing without links and of the whole one, of failed
    items (named in a table), and what that table says of itself."""
    sides = written(_sides(spark, sf_dir), "sides")
    run = scratch_path(spark, "guards")
    schema = f"guards_{run.rsplit('-', 1)[-1]}"
    ensure_schema(spark, schema, run)
    told: list[tuple[str, str]] = []
    for name, listing in (("no listing", sides.where("listed AND filename IS NULL")), ("listing", sides.where("listed"))):
        try:
            ops.require_listing(listing)
            told.append((name, "passed"))
        except ops.EmptyListing:
            told.append((name, "stopped"))
    outcomes = sides.where("listed").groupBy("filename").agg((F.length(F.first("filename")) % 5 == 0).alias("failed"))

    def publish_failures(failures: DataFrame) -> str:
        publish(failures, f"{schema}.failures", "Files that failed", {"quality": "landing"})
        return f"{schema}.failures"

    try:
        ops.raise_on_failures(outcomes, publish=publish_failures)
    except ops.FailedItems as e:
        told.append(("failures", str(e).replace(schema, "guards")))
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.failures").collect()}
    tags = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema}.failures").collect()}
    told += [("comment", about["Comment"]), ("quality", tags["quality"])]
    rows = spark.createDataFrame(told, "guard string, outcome string")
    named = spark.read.table(f"{schema}.failures").select(F.lit("failed").alias("guard"), F.col("filename").alias("outcome"))
    return rows.unionAll(named)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetching every listed file once: names of a length divisible by five fail, those one longer
    have no known outcome."""
    sides = _sides(spark, sf_dir)
    fifth = F.length("filename") % 5
    outcomes = sides.where("listed").select("filename").distinct().select(
        "filename", F.when(fifth != 1, fifth == 0).alias("failed")
    )
    return ops.run_summary(outcomes, ops.reconcile_sides(sides, retain=False))


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("seen_on")
    )


def manifest_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = ops.manifest(_sightings(spark, sf_dir), ("user_id", "event_type"))
    return seen.withColumns({c: _day(c) for c in ("first_seen", "last_seen", "retired_on")})


def manifest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same manifest, kept over runs: the first, the middle and the last day are merged into the
    manifest of all others, one by one and not in their order."""
    seen = _sightings(spark, sf_dir)
    names = ("user_id", "event_type")
    days = sorted(r.seen_on for r in seen.select("seen_on").distinct().collect())  # a date for each day
    late = list(dict.fromkeys([days[len(days) // 2], days[-1], days[0]])) if days else []
    done = [d for d in days if d not in late]
    kept = written(ops.manifest(seen.where(~F.col("seen_on").isin(late)), names), "manifest")
    for day in late:
        runs = spark.createDataFrame([(d,) for d in done], "day date")
        kept = written(ops.merge_manifest(kept, seen.where(F.col("seen_on") == F.lit(day)), day, runs, names), "manifest")
        done.append(day)
    return kept.withColumns({c: _day(c) for c in ("first_seen", "last_seen", "retired_on")})


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in a folder for each week; read as they were known on a day between two of them."""
    path = scratch_path(spark, "snapshots")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", _money("value"), F.to_date(F.date_trunc("week", "ts")).alias("ingest_date")
    )
    events.write.partitionBy("ingest_date").parquet(path)
    known = sources.read_as_of(spark, path, date(2024, 1, 20), events.drop("ingest_date").schema)
    return known.withColumn("ingest_date", _day("ingest_date"))


def runs_out_of_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's events as a run: rows and broken rules against the least and most of the days before.
    The last day is logged again, as a repeated run is."""
    path = scratch_path(spark, "ledger")
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    checks = {"no_error": "event_type <> 'error'", "value_below_150": "value < 150"}
    numbers = ops.run_numbers(events, "day", checks, "events", "value")
    ops.append_runs(numbers, path)
    ops.append_runs(numbers.where(F.col("run") == numbers.agg(F.max("run")).scalar()), path)
    judged = ops.out_of_bounds(spark.read.schema(numbers.schema).parquet(path))
    return judged.withColumn("run", _day("run"))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", _money("value"), F.to_date("ts").alias("ingest_date")
    )
    return ops.latest_snapshot(events).withColumn("ingest_date", _day("ingest_date"))


# --- reports -------------------------------------------------------------------------

TIE_BREAK = (*SERIES, "series_title", "year")


def report_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_k(winners(spark, sf_dir), k=10, tie_break=TIE_BREAK)


def report_best_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.best_table(winners(spark, sf_dir), tie_break=TIE_BREAK)


def report_title_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = ops.title_totals(report_top10(spark, sf_dir))
    return totals.withColumn("yearly_sum", _money("yearly_sum"))


def report_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.trend(yearly_orders(spark, sf_dir), start=1996, end=2000)


def report_value_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed answer as a chart takes it."""
    keyed = keyed_value_with_reference(spark, sf_dir)
    return keyed.select("year", "value", "population").orderBy("year")


def highest_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.highest(winners(spark, sf_dir))


def result_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.result_profile(winners(spark, sf_dir), SERIES)


def planted_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against a copy that lacks some, has others twice and some with another balance."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", _money("c_acctbal"))
    key = F.col("c_custkey")
    changed = F.when(key % 89 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).cast("decimal(18,2)")
    copy = customer.where(key % 97 != 0).withColumn("c_acctbal", changed)
    copy = copy.unionAll(copy.where(key % 83 == 0))
    return ops.differing_rows(customer, copy, "c_custkey")


# --- flows ---------------------------------------------------------------------------


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream")
    landed = ingest_available(
        spark,
        sf_dir + "/{events}.parquet",  # a glob, which may match a file or a folder of files
        f"{root}/events",
        f"{root}/checkpoint",
        table(spark, sf_dir, "events").schema,
    )
    return landed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value"),
    )


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of every user and type, brought in by two runs of a stream over files that land
    between them. After that the first batch is delivered again."""
    root = scratch_path(spark, "upsert")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", _money("value"))
    kept = NewestRows(spark, f"{root}/newest", events.schema, ("user_id", "event_type"), ("ts", "event_id"), buckets=16)
    for half in range(2):
        own = events.where(F.col("event_id") % 2 == half)
        own.repartition(3).write.mode("append").parquet(f"{root}/landed")
        rows = upsert_available(spark, f"{root}/landed", kept, f"{root}/checkpoint", files_per_batch=2)
    assert not kept.apply(events, 0)
    return rows.drop("ts")


def _land_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The raw shape of the flow out of the given tables. Facts: quantity per part, year and
    quarter, once per line status, so that the natural key repeats. Parts of the first type report
    their yearly total under the annual code only; of the others, every third part reports the
    average of its quarters beside them, and the next one reports every other year like the first
    type. Codes: brand, type, size and colour of the part."""
    part = table(spark, sf_dir, "part")
    colour = F.substring_index("p_name", " ", 1)
    lines = table(spark, sf_dir, "lineitem")
    parts = parts_for(lines.count())
    keys = ("p_partkey", "y", "q", "l_linestatus")
    quantities = (
        lines.select(
            F.col("l_partkey").alias("p_partkey"),
            F.year("l_shipdate").alias("y"),
            F.quarter("l_shipdate").alias("q"),
            "l_linestatus",
            "l_quantity",
        )
        .repartition(parts, *keys)
        .groupBy(*keys)
        .agg(F.sum("l_quantity").alias("v"))
        .repartition(parts, "p_partkey")
        .join(part.select("p_partkey", "p_type"), "p_partkey", "left")
    )
    third = F.col("p_partkey") % 3
    yearly = F.coalesce(F.col("p_type") == "ECONOMY", F.lit(False)) | ((third == 1) & (F.col("y") % 2 == 0))
    in_quarter = F.struct(F.elt("q", *(F.lit(q) for q in ops.QUARTERS)).alias("p"), F.col("v"))
    in_year = F.struct(F.lit(ops.ANNUAL).alias("p"), F.when(yearly, F.col("v")).otherwise(F.col("v") / 4).alias("v"))
    reported = F.array_compact(F.array(F.when(~yearly, in_quarter), F.when(yearly | (third == 0), in_year)))
    data = (
        quantities.select("p_partkey", "y", "l_linestatus", F.inline(reported))
        .groupBy("p_partkey", "y", "p", "l_linestatus")
        .agg(F.sum("v").cast("decimal(18,2)").alias("v"))
    )
    shaped = {
        "data": data.select(
            F.format_string("PART%d   ", "p_partkey").alias("series_id        "),
            F.col("y").cast("string").alias("year"),
            F.col("p").alias("period"),
            F.format_string("%12s", F.col("v").cast("string")).alias("       value"),
            F.col("l_linestatus").alias("footnote_codes"),
        ),
        "series": part.select(
            F.format_string("PART%d  ", "p_partkey").alias("series_id   "),
            F.concat("p_brand", F.lit("  ")).alias("sector_code"),
            F.col("p_type").alias("class_code"),
            F.format_string("%d ", "p_size").alias("measure_code"),
            colour.alias("duration_code"),
            F.lit("S").alias("seasonal"),
        ),
        "sector": part.select(
            F.col("p_brand").alias("sector_code"), F.upper("p_brand").alias("sector_name")
        ).distinct(),
        "class": part.select(
            F.col("p_type").alias("class_code"), F.lower("p_type").alias("class_text")
        ).distinct(),
        "measure": part.select(
            F.col("p_size").cast("string").alias("measure_code"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("measure_text"),
        ).distinct(),
        "duration": part.select(
            colour.alias("duration_code"), F.upper(colour).alias("duration_text")
        ).distinct(),
    }
    for name, df in shaped.items():
        sources.write_delimited(df, f"{root}/series/{DELIMITED_FILES[name]}")
    records = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("Nation"), F.year("o_orderdate").alias("y"))
        .agg(F.count(F.lit(1)).alias("Population"))
        .select(
            F.array(
                F.struct(
                    F.col("Nation").alias("Nation ID"),
                    "Nation",
                    F.when(F.col("y") != 1998, F.col("y")).alias("Year"),
                    "Population",
                )
            ).alias("data"),
            F.struct(F.lit("counts").alias("source")).alias("annotations"),
        )
    )
    records.write.json(f"{root}/population/{DOCUMENT_FILE}")


def medallion_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files through all layers; the gold answers as one tidy table."""
    root = scratch_path(spark, "flow")
    run = root.rsplit("-", 1)[-1]
    _land_files(spark, sf_dir, f"{root}/landing")
    names = {"landing": f"{root}/landing", **{layer: f"{layer}_{run}" for layer in ("bronze", "silver", "gold")}}
    for name, value in names.items():
        spark.conf.set(CONF_PREFIX + name, value)
    settings = Settings.from_session(spark)
    for name in names:
        spark.conf.unset(CONF_PREFIX + name)
    asked = Questions(nation="F", start=1996, end=2000, series_id="PART25", period="Q01")
    Flow(spark, settings, asked, locations=root).run()

    def answer(name: str, measure: str) -> DataFrame:
        df = sources.read_table(spark, name, settings.gold)
        columns = {"series_id": "string", "series_title": "string", "year": "int"}
        return df.select(
            F.lit(f"{name}.{measure}").alias("answer"),
            *(
                (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                for c, t in columns.items()
            ),
            F.col(measure).cast("decimal(18,2)").alias("amount"),
        )

    return (
        answer("pop_stats", "mean_population")
        .unionAll(answer("pop_stats", "stddev_population"))
        .unionAll(answer("best_year", "yearly_sum"))
        .unionAll(answer("value_pop", "value"))
        .unionAll(answer("value_pop", "population"))
    )


def layout_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines laid out by part and year, sorted and along a curve, 16 files each: whether a filter on either
    skips a quarter of the files at least, and the rows it finds."""
    root = scratch_path(spark, "layout")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"), "l_quantity")
    keys = ("l_partkey", "year")
    for layout in ("sorted", "curve"):
        clustered(lines, keys, curve=layout == "curve", files=16).write.parquet(f"{root}/{layout}")
    out = None
    for column, value in (("l_partkey", 25), ("year", 1995)):
        read = {layout: spark.read.schema(lines.schema).parquet(f"{root}/{layout}") for layout in ("sorted", "curve")}
        line = read["curve"].where(F.col(column) == value).agg(F.count(F.lit(1)).alias("rows"))
        for layout, df in read.items():
            touched = sources.files_touched(sources.file_ranges(df, keys), column, value)
            told = touched.first()  # two numbers
            line = line.withColumn(f"{layout}_skips", F.lit(4 * told.touched <= 3 * told.files))
        line = line.select(F.lit(column).alias("filter"), "rows", "sorted_skips", "curve_skips")
        out = line if out is None else out.unionAll(line)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        best_year,
        best_year_sql,
        best_year_single,
        best_year_incremental,
        period_rule_audit,
        equivalence_diff,
        twins_diff,
        planted_differences,
        range_stats,
        reference_years,
        keyed_value_with_reference,
        coverage_gaps,
        coverage_gaps_by_key,
        dedupe_by_key,
        typed_clean,
        labelled_facts,
        lookup_resolution,
        guarded_lookup,
        delimited_roundtrip,
        json_records,
        rescue_malformed,
        header_rescue,
        schema_drift,
        expect_drop,
        rule_violations,
        expect_metrics,
        volume_freshness,
        runs_out_of_bounds,
        listing_links,
        landing_reconcile,
        landing_summary,
        stale_sources,
        landing_guards,
        run_summary,
        manifest_seen,
        manifest_runs,
        latest_snapshot,
        snapshot_as_of,
        report_top10,
        report_best_table,
        report_title_totals,
        report_trend,
        report_value_by_year,
        highest_series,
        result_profile,
        stream_ingest,
        stream_upsert,
        layout_skipping,
        medallion_flow,
    )
}
