"""The three answers as SELECT statements. ``{facts}`` and ``{reference}`` are frames passed
to ``spark.sql``; the other placeholders are literals given the same way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from quarterdeck.functions import columns_of, quoted
from quarterdeck.workspace import parts_for

RANGE_STATS = """
SELECT round(avg(population), 2) AS mean_population,
       round(stddev_samp(population), 2) AS stddev_population
FROM {reference}
WHERE year BETWEEN :start AND :end
"""


def best_year_select(series: str | Sequence[str] = "series_id") -> str:
    """Best year per series in the flag form: every fact learns whether its series has quarters,
    facts under the other code go, and a year wins whose total is the largest of its series."""
    keys = ", ".join(columns_of(series))
    same = " AND ".join(f"t.{k} <=> p.{k}" for k in columns_of(series))
    return f"""
WITH kept AS (
  SELECT {keys}, series_title, year, value FROM (
    SELECT *, count_if(period IN ('Q01', 'Q02', 'Q03', 'Q04')) OVER (PARTITION BY {keys}) AS quarters
    FROM {{facts}} WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04', 'Q05'))
  WHERE (period = 'Q05') = (quarters = 0)
),
t AS (
  SELECT {keys}, series_title, year, round(sum(value), 2) AS yearly_sum
  FROM kept GROUP BY ALL
),
p AS (SELECT {keys}, max(yearly_sum) AS peak FROM t GROUP BY ALL)
SELECT t.* FROM t JOIN p ON {same} AND t.yearly_sum <=> p.peak
"""


def keyed_value_select(series: Sequence[str] = ("series_id",)) -> str:
    """One series and period beside the reference; parameters are named like the columns."""
    keys = ", ".join(f"f.{k}" for k in series)
    wanted = " AND ".join(f"f.{k} = :{k}" for k in series)
    return f"""
SELECT {keys}, f.year, f.period, f.value, r.population
FROM {{facts}} AS f LEFT JOIN {{reference}} AS r ON f.year = r.year
WHERE {wanted} AND f.period = :period
"""


def range_stats_sql(reference: DataFrame, start: int = 2013, end: int = 2018) -> DataFrame:
    return reference.sparkSession.sql(
        RANGE_STATS, args={"start": start, "end": end}, reference=reference
    )


def by_series(facts: DataFrame, series: str | Sequence[str] = "series_id") -> DataFrame:
    """``facts`` dealt out by series into as many parts as their number asks for. `best_year_select` then takes
    its window over all facts, and its groupings, where the rows are, and a task's share does not grow."""
    return facts.repartition(parts_for(facts.count()), *map(quoted, columns_of(series)))


def best_year_sql(facts: DataFrame, series: str | Sequence[str] = "series_id") -> DataFrame:
    return facts.sparkSession.sql(best_year_select(series), facts=by_series(facts, series))


def keyed_value_sql(
    facts: DataFrame, reference: DataFrame, series: Mapping[str, object], period: str = "Q01"
) -> DataFrame:
    return facts.sparkSession.sql(
        keyed_value_select(list(series)),
        args={**series, "period": period},
        facts=facts,
        reference=reference,
    )
