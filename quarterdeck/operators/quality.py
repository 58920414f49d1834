"""Named row rules with an action, and checks on whole datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import quoted

ACTIONS = ("drop", "warn", "fail")


class RuleViolation(RuntimeError):
    """A rule with the action "fail" was broken."""


@dataclass(frozen=True)
class Rule:
    """``predicate`` (SQL text or a column) should be true on every row. A null outcome
    counts as broken. "drop" removes such rows, "warn" only counts them, "fail" stops."""

    name: str
    predicate: str | Column
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"{self.name}: unknown action {self.action!r}")

    def holds(self) -> Column:
        test = F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate
        return F.coalesce(test, F.lit(False))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows on which every "drop" rule holds. Other rules are not looked at: `check` acts on
    "fail" rules too."""
    for rule in rules:
        if rule.action == "drop":
            df = df.where(rule.holds())
    return df


def rule_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: rows seen, passed, failed and dropped. One aggregation for all."""

    def line(rule: Rule) -> Column:
        broken = F.count_if(~rule.holds())
        return F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(rule.holds()).alias("passed"),
            broken.alias("failed"),
            (broken if rule.action == "drop" else F.lit(0).cast("bigint")).alias("dropped"),
        )

    counts = df.agg(F.array(*(line(rule) for rule in rules)).alias("metrics"))
    return counts.select(F.inline("metrics"))


def check(df: DataFrame, rules: Sequence[Rule], dataset: str) -> tuple[DataFrame, DataFrame]:
    """The kept rows and the metrics, both lazy. Rules with the action "fail" are tried at once, in
    one pass, and raise `RuleViolation` where a row breaks one."""
    fatal = [rule for rule in rules if rule.action == "fail"]
    if fatal:
        enforce(rule_metrics(df, fatal, dataset))
    return keep_valid(df, rules), rule_metrics(df, rules, dataset)


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break any rule, each with the names of those it breaks, in one pass."""
    broken = F.array_compact(F.array(*(F.when(~r.holds(), F.lit(r.name)) for r in rules)))
    return df.withColumn("violated", broken).where(F.size("violated") > 0)


def observed(df: DataFrame, rules: Sequence[Rule], dataset: str) -> tuple[DataFrame, Observation]:
    """The kept rows, with the counts gathered by the job that consumes them rather than by
    a second pass. Write the frame without a further shuffle: Spark counts each task of a
    final stage once, whereas a repeated map stage would be counted again."""
    counts = Observation(dataset)
    watched = df.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(~rule.holds()).alias(rule.name) for rule in rules),
    )
    return keep_valid(watched, rules), counts


def observed_metrics(
    counts: Mapping[str, int], rules: Sequence[Rule], dataset: str
) -> list[tuple[str, str, str, int, int, int, int]]:
    """Observed counts in the shape of `rule_metrics`, one tuple per rule."""
    rows = counts["rows"]
    return [
        (
            dataset,
            r.name,
            r.action,
            rows,
            rows - counts[r.name],
            counts[r.name],
            counts[r.name] if r.action == "drop" else 0,
        )
        for r in rules
    ]


METRICS_SCHEMA = (
    "dataset string, rule string, action string, "
    "rows bigint, passed bigint, failed bigint, dropped bigint"
)


def enforce(metrics: DataFrame) -> None:
    """Raise if a rule with the action "fail" was broken. The metrics have one row per
    rule, so this is all that reaches the driver."""
    broken = metrics.where((F.col("action") == "fail") & (F.col("failed") > 0)).collect()
    if broken:
        raise RuleViolation(
            "; ".join(f"{r['dataset']}.{r['rule']}: {r['failed']} of {r['rows']} rows" for r in broken)
        )


def volume_freshness(
    df: DataFrame,
    stamp: str,
    dataset: str,
    min_rows: int,
    not_before: Column,
    max_rows: int | None = None,
) -> DataFrame:
    """Row count and newest ``stamp`` against their bounds, which are inclusive; one row.
    An empty dataset is not fresh."""
    enough = F.col("rows") >= min_rows
    if max_rows is not None:
        enough = enough & (F.col("rows") <= max_rows)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(stamp).alias("newest")).select(
        F.lit(dataset).alias("dataset"),
        "rows",
        "newest",
        enough.alias("volume_ok"),
        F.coalesce(F.col("newest") >= not_before, F.lit(False)).alias("fresh_ok"),
    )


def schema_drift(
    df: DataFrame, expected: T.StructType, count: Sequence[str] = ("unexpected", "retyped")
) -> DataFrame:
    """One row per expected or actual column: its two types, a status ("ok", "missing",
    "unexpected", "retyped") and how many rows carry a value in it, which tells a harmless
    new column from one that matters. Only columns whose status is in ``count`` are read and
    counted; the others have a null there."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in wanted:
            return "unexpected"
        return "ok" if actual[name] == wanted[name] else "retyped"

    def line(name: str) -> Column:
        counted = status(name) in count
        present = F.count(F.col(quoted(name))) if counted and name in actual else F.lit(0 if counted else None)
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(wanted.get(name)).cast("string").alias("expected_type"),
            F.lit(actual.get(name)).cast("string").alias("actual_type"),
            F.lit(status(name)).alias("status"),
            present.cast("bigint").alias("values"),
        )

    names = [*wanted, *(n for n in actual if n not in wanted)]
    report = df.agg(F.count(F.lit(1)), F.array(*(line(n) for n in names)).alias("report"))
    return report.select(F.inline("report"))


def stale_sources(required: DataFrame, unpublished: DataFrame, name: str = "filename") -> DataFrame:
    """Required files that the source no longer publishes, each once."""
    gone = unpublished.select(name).distinct()
    return required.select(name).distinct().join(gone, name, "left_semi")
