"""Best year kept up to date by batches, from partial totals that add up.

A batch of facts is reduced to partial totals per series, title and year. Totals of several batches
merge by adding, and what decides a year (its quarters' total, its annual total, how many of each there
are) can be read off the merged ones. A correction takes the old fact back with weight -1 and brings the
new one, in any later batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns_of, quoted
from quarterdeck.operators.series import ANNUAL, QUARTERS

# What a partial total holds beside its keys: rows and known values under quarters and under the annual
# code, and their sums.
PARTS = ("quarters", "quarter_values", "quarter_sum", "annuals", "annual_values", "annual_sum")


def partial_totals(
    facts: DataFrame,
    quarters: Sequence[str] = QUARTERS,
    annual: str = ANNUAL,
    series: str | Sequence[str] = "series_id",
    title: str | Sequence[str] | None = "series_title",
    year: str = "year",
    period: str = "period",
    value: str = "value",
    weight: str | None = None,
) -> DataFrame:
    """One row per series, title and year of a batch, mergeable by `merged_totals`. ``weight`` names a
    column that is 1 for a fact to add and -1 for one to take back; by default all are added. Use an
    exact type for ``value``: a sum of doubles need not return to what it was."""
    names = [*columns_of(series), *columns_of(title), year]
    is_quarter = F.col(period).isin(list(quarters))
    sign = F.col(quoted(weight)).cast("long") if weight else F.lit(1).cast("long")
    rows = facts.where(is_quarter | (F.col(period) == annual)).select(
        *map(quoted, names), is_quarter.alias("__quarter"), F.col(quoted(value)).alias("__value"), sign.alias("__sign")
    )

    def parts(of: Column, name: str) -> list[Column]:
        known = of & F.col("__value").isNotNull()
        zero = F.lit(0).cast("long")
        return [
            F.sum(F.when(of, F.col("__sign")).otherwise(zero)).alias(f"{name}s"),
            F.sum(F.when(known, F.col("__sign")).otherwise(zero)).alias(f"{name}_values"),
            F.sum(F.when(known & (F.col("__sign") < 0), -F.col("__value")).when(known, F.col("__value"))).alias(f"{name}_sum"),
        ]

    return rows.groupBy(*map(quoted, names)).agg(
        *parts(F.col("__quarter"), "quarter"), *parts(~F.col("__quarter"), "annual")
    )


def merged_totals(totals: DataFrame) -> DataFrame:
    """Partial totals of any number of batches, added up per series, title and year."""
    keys = [c for c in totals.columns if c not in PARTS]
    kinds = {c: totals.schema[c].dataType for c in PARTS}
    return totals.groupBy(*map(quoted, keys)).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in PARTS))


def best_of_totals(
    totals: DataFrame, series: str | Sequence[str] = "series_id", year: str = "year", gone: bool = False
) -> DataFrame:
    """`best_year` out of merged totals: years without facts left are none, the rule on periods and the
    ties are the same. With ``gone``, a series without facts left has one row, of nulls beside its key, and a
    column ``known`` tells it from the others."""
    keys = columns_of(series)
    rest = [c for c in totals.columns if c not in (*keys, *PARTS)]
    has_quarter = F.col("quarters") > 0
    known = has_quarter | (F.col("annuals") > 0)
    total = F.when(
        has_quarter, F.when(F.col("quarter_values") > 0, F.coalesce("quarter_sum", F.lit(0)))
    ).otherwise(F.when(F.col("annual_values") > 0, F.coalesce("annual_sum", F.lit(0))))
    best = [F.desc("has_quarter"), F.desc_nulls_last("yearly_sum")]
    if gone:  # last, and of those a single one
        best = [F.desc("known"), *best, F.when(~F.col("known"), F.struct(*map(quoted, rest)))]
    ranking = Window.partitionBy(*map(quoted, keys)).orderBy(*best)
    first = (
        (totals if gone else totals.where(known))
        .withColumns({"has_quarter": has_quarter, "known": known})
        .withColumn("yearly_sum", F.round(total, 2))
        .withColumn("place", F.rank().over(ranking))
        .where(F.col("place") == 1)
    )
    rest = [*(c for c in rest if c != year), year]
    if not gone:
        return first.select(*map(quoted, [*keys, *rest]), "yearly_sum")
    return first.select(
        *map(quoted, keys), *(F.when(F.col("known"), F.col(quoted(c))).alias(c) for c in [*rest, "yearly_sum"]), "known"
    )
