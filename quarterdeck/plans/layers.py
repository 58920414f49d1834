"""The layered flow: landed files -> bronze -> silver -> gold.

Plain function composition. Every layer is written before the next one reads it, so a run
that loses executors recomputes at most one layer, and no plan spans the whole flow.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import (
    Lookup,
    Rule,
    append_runs,
    best_year,
    clean_facts,
    coverage_gaps,
    enforce,
    keyed_value_with_reference,
    label_facts,
    observed,
    observed_metrics,
    out_of_bounds,
    range_stats,
    reference_years,
    rule_metrics,
)
from quarterdeck.operators.quality import METRICS_SCHEMA
from quarterdeck.plans.sql_twins import by_series
from quarterdeck.sinks import ensure_schema, publish
from quarterdeck.sources import (
    explode_records,
    read_delimited,
    read_documents,
    read_table,
)
from quarterdeck.workspace import Settings, parts_for

# The published file names of the productivity series, and the record field
# names of the population documents.
DELIMITED_FILES = {
    "data": "pr.data.0.Current",
    "series": "pr.series",
    "sector": "pr.sector",
    "class": "pr.class",
    "measure": "pr.measure",
    "duration": "pr.duration",
}
DOCUMENT_FILE = "population.json"
RECORD_NAMES = {
    "Nation ID": "nation_id",
    "Nation": "nation",
    "Year": "year",
    "Population": "population",
}

LABELS = {
    "sector": ("sector_code", "sector_name"),
    "class": ("class_code", "class_text"),
    "measure": ("measure_code", "measure_text"),
    "duration": ("duration_code", "duration_text"),
}

HISTORY_SCHEMA = "dataset string, rows long, check string, number long, run long"

FACT_RULES = (Rule("non_null_series_id", "series_id IS NOT NULL", "drop"),)
RECORD_RULES = (Rule("non_null_year", "year IS NOT NULL", "drop"),)
COVERAGE_RULES = (Rule("no_year_gap", "year_gap IS NULL OR year_gap = 1", "warn"),)


@dataclass(frozen=True)
class Questions:
    """What the gold layer is asked."""

    nation: str = "United States"
    start: int = 2013
    end: int = 2018
    series_id: str = "PRS30006032"
    period: str = "Q01"


class Flow:
    """One run over one landing zone. `run` builds all layers in order."""

    def __init__(
        self,
        spark: SparkSession,
        settings: Settings,
        questions: Questions = Questions(),
        locations: str | None = None,
        document_schema: str | None = None,
        history: str | None = None,
    ) -> None:
        """``locations`` is the folder to create the schemas in, the warehouse by default.
        ``document_schema`` saves the pass that infers the fields of the documents. ``history`` is the
        path of a ledger to which every run adds its rule outcomes, see `unusual`."""
        self.spark, self.settings, self.questions = spark, settings, questions
        self.document_schema = document_schema
        self.history = history
        self.metrics: list[tuple] = []
        for schema in (settings.bronze, settings.silver, settings.gold):
            ensure_schema(spark, schema, f"{locations}/{schema}" if locations else None)

    def _write(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        comment: str,
        rules: tuple[Rule, ...] = (),
        sort_by: tuple[str, ...] = (),
    ) -> DataFrame:
        schema = getattr(self.settings, layer)
        counts = None
        if rules:
            fatal = [rule for rule in rules if rule.action == "fail"]
            if fatal:
                enforce(rule_metrics(df, fatal, name))
            df, counts = observed(df, rules, name)
        table = publish(df, f"{schema}.{name}", comment, {"quality": layer}, sort_by=sort_by)
        if counts is not None:
            self.metrics += observed_metrics(counts.get, rules, name)
        return table

    def _read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, name, getattr(self.settings, layer))

    def _together(self, *writes: Callable[[], DataFrame]) -> None:
        """Submit writes that do not read each other, so that small tables do not wait for
        the large one."""
        with ThreadPoolExecutor(len(writes)) as pool:
            for done in [pool.submit(write) for write in writes]:
                done.result()

    def _raw_file(self, name: str) -> DataFrame:
        file = DELIMITED_FILES[name]
        df = read_delimited(self.spark, f"{self.settings.landing}/series/{file}")
        rules = FACT_RULES if name == "data" else ()
        return self._write("bronze", f"raw_{name}", df, f"Landed file {file}", rules)

    def _raw_population(self) -> DataFrame:
        path = f"{self.settings.landing}/population/{DOCUMENT_FILE}"
        documents = read_documents(self.spark, path, self.document_schema)
        records = explode_records(documents, "data", RECORD_NAMES)
        comment = "Landed population records"
        return self._write("bronze", "raw_population", records, comment, RECORD_RULES)

    def bronze(self) -> None:
        self._together(
            self._raw_population, *(partial(self._raw_file, name) for name in DELIMITED_FILES)
        )

    def _facts(self) -> DataFrame:
        codes = [code for code, _ in LABELS.values()]
        series = self._read("bronze", "raw_series").select("series_id", *codes, "seasonal")
        lookups = [
            Lookup(self._read("bronze", f"raw_{name}"), code, text)
            for name, (code, text) in LABELS.items()
        ]
        raw = self._read("bronze", "raw_data")
        facts = clean_facts(raw, parts=parts_for(raw.count()))
        return self._write(
            "silver",
            "facts",
            label_facts(facts, series, lookups, trimmed=True),
            "Typed, unique facts with the labels of their series",
            sort_by=("series_id", "year", "period"),
        )

    def _population(self) -> DataFrame:
        records = self._read("bronze", "raw_population")
        years = reference_years(records, {"nation": self.questions.nation})
        years = self._write(
            "silver", "population", years, "Population by year; years may be missing"
        )
        return self._write(
            "silver",
            "population_coverage",
            coverage_gaps(years),
            "Distance of each year to the previous one present; other than 1 is a hole",
            COVERAGE_RULES,
        )

    def silver(self) -> None:
        self._together(self._facts, self._population)

    def _stats(self) -> DataFrame:
        ask = self.questions
        return self._write(
            "gold",
            "pop_stats",
            range_stats(self._read("silver", "population"), ask.start, ask.end),
            f"Mean and sample deviation of the population {ask.start}-{ask.end}",
        )

    def _best_year(self) -> DataFrame:
        return self._write(
            "gold",
            "best_year",
            best_year(by_series(self._read("silver", "facts"))),
            "Best year per series; quarters, or the annual code where there are none; ties kept",
        )

    def _value_pop(self) -> DataFrame:
        ask = self.questions
        values = keyed_value_with_reference(
            self._read("silver", "facts"),
            self._read("silver", "population"),
            {"series_id": ask.series_id},
            ask.period,
        )
        comment = f"{ask.series_id} {ask.period} by year with the population where known"
        return self._write("gold", "value_pop", values, comment)

    def gold(self) -> None:
        self._together(self._stats, self._best_year, self._value_pop)

    def run(self, number: int | None = None) -> DataFrame:
        """Build all layers; returns the rule metrics of the run, also kept as a table. With a ``history`` they
        are added to it under the run's ``number``; the same number again replaces its lines."""
        self.metrics.clear()
        self.bronze()
        self.silver()
        self.gold()
        log = self.spark.createDataFrame(self.metrics, METRICS_SCHEMA)
        if self.history and number is not None:
            seen = F.lit(number).cast("long").alias("run")
            rows = log.select("dataset", seen, "rows", F.lit("rows").alias("check"), F.col("rows").alias("number")).distinct()
            broken = log.select("dataset", seen, "rows", F.col("rule").alias("check"), F.col("failed").alias("number"))
            append_runs(rows.unionAll(broken), self.history)
        return self._write("silver", "rule_metrics", log, "Rule outcomes of the last run")

    def unusual(self, slack: float = 0.1, least: int = 5) -> DataFrame:
        """The outcomes of runs in the history that lie outside those of the runs before them by more than
        the share ``slack``; a run with fewer than ``least`` runs before it is not judged."""
        ledger = self.spark.read.schema(HISTORY_SCHEMA).parquet(self.history)
        return out_of_bounds(ledger, slack=slack, least=least).where("outside")
