"""Questions about a period-coded time series: rows of (series, year, period, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns_of

# Codes of the published period domain. The fifth code is the annual
# average of the year, not a fifth quarter.
QUARTERS = ("Q01", "Q02", "Q03", "Q04")
ANNUAL = "Q05"

# The three ways to total a year that `period_rule_audit` compares.
FALLBACK = "fallback"
ALL_PERIODS = "all_periods"
QUARTERS_ONLY = "quarters_only"


def range_stats(
    df: DataFrame,
    start: int = 2013,
    end: int = 2018,
    measure: str = "population",
    year: str = "year",
    sample: bool = True,
) -> DataFrame:
    """Mean and standard deviation of ``measure`` over the years ``start``..``end``, both
    included. Always one row; nulls when no year matches, and a null deviation of the
    sample form when only one does."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    return df.where(F.col(year).between(start, end)).agg(
        F.round(F.avg(measure), 2).alias(f"mean_{measure}"),
        F.round(deviation(measure), 2).alias(f"stddev_{measure}"),
    )


def period_totals(
    facts: DataFrame,
    quarters: Sequence[str] = QUARTERS,
    annual: str = ANNUAL,
    series: str | Sequence[str] = "series_id",
    title: str | Sequence[str] | None = "series_title",
    year: str = "year",
    period: str = "period",
    value: str = "value",
) -> DataFrame:
    """One row per series, title and year: the quarters' total, the annual total, and
    whether the year has any quarter. Rows under other codes contribute nothing.

    This is the only step that sees raw facts. Its partial aggregate runs before the
    shuffle, so a series that holds a large share of the facts leaves each map task as a
    handful of rows.
    """
    names = [*columns_of(series), *columns_of(title), year]
    is_quarter = F.col(period).isin(list(quarters))
    return (
        facts.where(is_quarter | (F.col(period) == annual))
        .select(*names, is_quarter.alias("__quarter"), F.col(value).alias("__value"))
        .groupBy(*names)
        .agg(
            F.sum(F.when(F.col("__quarter"), F.col("__value"))).alias("quarter_total"),
            F.sum(F.when(~F.col("__quarter"), F.col("__value"))).alias("annual_total"),
            F.bool_or("__quarter").alias("has_quarter"),
        )
    )


def _fallback_total() -> Column:
    return F.when(F.col("has_quarter"), F.col("quarter_total")).otherwise(F.col("annual_total"))


def _best_first(total: str) -> list[Column]:
    """Years with quarters outrank every annual-only year of the same series, which is the
    per-series rule "quarters if there are any, else the annual code"; then the larger
    rounded total, nulls last."""
    return [F.desc("has_quarter"), F.desc_nulls_last(total)]


def best_year(
    facts: DataFrame,
    quarters: Sequence[str] = QUARTERS,
    annual: str = ANNUAL,
    series: str | Sequence[str] = "series_id",
    title: str | Sequence[str] | None = "series_title",
    year: str = "year",
    period: str = "period",
    value: str = "value",
) -> DataFrame:
    """The year with the largest total, per series; all years of a tie are kept.

    A series that has any quarter is totalled over its quarters alone. One that has none
    falls back to the annual code. Totals compete after rounding to two decimals.

    The existence test is an ordering term of the ranking, not a window over the facts.
    A single ``rank() = 1`` remains, which Spark also applies inside each partition before
    it shuffles: only the leaders of each partition travel.
    """
    keys, titles = columns_of(series), columns_of(title)
    ranking = Window.partitionBy(*keys).orderBy(*_best_first("yearly_sum"))
    return (
        period_totals(facts, quarters, annual, keys, titles, year, period, value)
        .withColumn("yearly_sum", F.round(_fallback_total(), 2))
        .withColumn("place", F.rank().over(ranking))
        .where(F.col("place") == 1)
        .select(*keys, *titles, year, "yearly_sum")
    )


def best_year_single(
    facts: DataFrame,
    quarters: Sequence[str] = QUARTERS,
    annual: str = ANNUAL,
    series: str | Sequence[str] = "series_id",
    title: str | Sequence[str] | None = "series_title",
    year: str = "year",
    period: str = "period",
    value: str = "value",
) -> DataFrame:
    """As `best_year`, but one row per series: of tied years the earliest, then the first
    title."""
    keys, titles = columns_of(series), columns_of(title)
    ranking = Window.partitionBy(*keys).orderBy(
        *_best_first("yearly_sum"),
        F.asc_nulls_last(year),
        *(F.asc_nulls_last(t) for t in titles),
    )
    return (
        period_totals(facts, quarters, annual, keys, titles, year, period, value)
        .withColumn("yearly_sum", F.round(_fallback_total(), 2))
        .withColumn("place", F.row_number().over(ranking))
        .where(F.col("place") == 1)
        .select(*keys, *titles, year, "yearly_sum")
    )


def period_rule_audit(
    facts: DataFrame,
    quarters: Sequence[str] = QUARTERS,
    annual: str = ANNUAL,
    series: str | Sequence[str] = "series_id",
    title: str | Sequence[str] | None = "series_title",
    year: str = "year",
    period: str = "period",
    value: str = "value",
) -> DataFrame:
    """How the choice of period rule moves the answer, one row per rule: series with a
    winner, series whose winning years differ from the fallback rule's, and series that
    have no winner at all under the rule.

    All rules are judged in one pass over the same totals, in windows over the series alone, and
    the comparison groups by the series too, so both use one shuffle. Only the totals and the
    three result rows are shuffled besides.
    """
    keys, titles = columns_of(series), columns_of(title)
    totals = period_totals(facts, quarters, annual, keys, titles, year, period, value)
    quarter, yearly = F.col("quarter_total"), F.col("annual_total")
    both = F.coalesce(quarter + yearly, quarter, yearly).cast(
        totals.schema["quarter_total"].dataType
    )
    own = Window.partitionBy(*keys)
    quarterly = F.bool_or("has_quarter").over(own)
    competing = {  # rule -> whether the year competes, and its total
        FALLBACK: (F.col("has_quarter") == F.col("quarterly"), _fallback_total()),
        ALL_PERIODS: (F.lit(True), both),
        QUARTERS_ONLY: (F.col("has_quarter"), quarter),
    }
    rules = tuple(competing)
    judged = totals.withColumn("quarterly", quarterly).select(
        *keys,
        *(F.when(joins, F.round(total, 2)).alias(f"{r}_total") for r, (joins, total) in competing.items()),
        *(joins.alias(f"{r}_joins") for r, (joins, _) in competing.items()),
    )
    # where no total of a series is known, all of its years are tied
    won = judged.select(
        *keys,
        *(
            (F.col(f"{r}_joins") & F.col(f"{r}_total").eqNullSafe(F.max(f"{r}_total").over(own))).alias(r)
            for r in rules
        ),
    )
    per_series = won.groupBy(*keys).agg(
        *(F.bool_or(r).alias(r) for r in rules),
        *(F.bool_or(F.col(r) != F.col(FALLBACK)).alias(f"{r}_differs") for r in rules),
    )
    counted = per_series.agg(
        F.array(
            *(
                F.struct(
                    F.lit(r).alias("rule"),
                    F.count_if(r).alias("series"),
                    F.count_if(F.col(r) & F.col(f"{r}_differs")).alias("changed"),
                    F.count_if(~F.col(r)).alias("vanished"),
                )
                for r in rules
            )
        ).alias("audit")
    )
    return counted.select(F.inline("audit"))


def keyed_value_with_reference(
    facts: DataFrame,
    reference: DataFrame,
    series: Mapping[str, object],
    period: str = "Q01",
    period_column: str = "period",
    year: str = "year",
    value: str = "value",
    measure: str = "population",
) -> DataFrame:
    """The values of one series and period beside the annual reference of the same year.

    Years that the reference lacks keep their value and get a null. ``reference`` has one
    row per year. The key filters stand directly on the facts, so they reach the scan.
    """
    wanted = F.col(period_column) == period
    for name, key in series.items():
        wanted = wanted & (F.col(name) == key)
    return (
        facts.where(wanted)
        .select(*series, year, period_column, value)
        .join(reference.select(year, measure), year, "left")
        .select(*series, year, period_column, value, measure)
    )
