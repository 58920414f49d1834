"""Report queries on top of finished answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns_of, display_integer, display_number, quoted
from quarterdeck.operators.gaps import with_previous


def top_k(
    df: DataFrame, measure: str = "yearly_sum", k: int = 10, tie_break: str | Sequence[str] = ()
) -> DataFrame:
    """The k rows with the largest measure; ``tie_break`` decides ties at the cut."""
    ties = [F.asc_nulls_last(c) for c in columns_of(tie_break)]
    return df.orderBy(F.desc_nulls_last(measure), *ties).limit(k)


def best_table(
    df: DataFrame,
    measure: str = "yearly_sum",
    year: str = "year",
    tie_break: str | Sequence[str] = (),
) -> DataFrame:
    """The whole table, largest measure first, with year and measure as display text."""
    ties = [F.asc_nulls_last(c) for c in columns_of(tie_break)]
    return df.orderBy(F.desc_nulls_last(measure), *ties).withColumns(
        {
            f"{year}_display": display_integer(year),
            f"{measure}_display": display_number(measure, 2),
        }
    )


def title_totals(
    df: DataFrame, title: str = "series_title", measure: str = "yearly_sum"
) -> DataFrame:
    """The measure summed per title, largest first. Several series, and several tied years
    of one series, add up where they share a title."""
    return (
        df.groupBy(title)
        .agg(F.sum(measure).alias(measure))
        .orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(title))
    )


def highest(df: DataFrame, measure: str = "yearly_sum") -> DataFrame:
    """The rows that reach the largest measure of all, ties included; null measures reach nothing. One
    pass: every task keeps its own leaders before they meet."""
    best = Window.orderBy(F.desc(quoted(measure)))
    known = df.where(F.col(quoted(measure)).isNotNull())
    return known.withColumn("__place", F.rank().over(best)).where(F.col("__place") == 1).drop("__place")


def trend(
    df: DataFrame,
    measure: str = "population",
    year: str = "year",
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Known values by year, oldest first, with the change from the previous known value.
    ``start`` and ``end`` are inclusive. ``df`` has one row per year."""
    known = df.where(F.col(measure).isNotNull())
    if start is not None:
        known = known.where(F.col(year) >= start)
    if end is not None:
        known = known.where(F.col(year) <= end)
    return (
        with_previous(known.select(year, measure), year, [measure])
        .select(year, measure, (F.col(measure) - F.col(f"previous.{measure}")).alias("change"))
        .orderBy(year)
    )


def result_profile(df: DataFrame, series: str | Sequence[str] = "series_id") -> DataFrame:
    """Rows, distinct series, and series with more than one row; one row."""
    return (
        df.groupBy(*columns_of(series))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("series"),
            F.count_if(F.col("n") > 1).alias("tied"),
        )
    )
