"""From raw text to typed rows that are unique per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of, quoted, trim_text, typed
from quarterdeck.operators.enrich import frequent_codes


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedupe_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    largest: str | Sequence[str] = (),
    order: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: the one with the largest ``largest`` columns, nulls being smallest,
    the remaining columns breaking ties in the same sense. A re-run keeps the same row.

    This is a maximum over whole rows, combined before the shuffle: a key with very many
    copies sends one row per task. ``order`` gives sort expressions to use instead; then it is
    ``row_number() = 1``, which Spark also applies inside each partition first.
    """
    names = columns_of(keys)
    leading = columns_of(largest)
    rest = [c for c in df.columns if c not in names and c not in leading]
    ranked = [*leading, *rest]
    if not ranked:
        return df.distinct()
    if not order and all(_orderable(df.schema[c].dataType) for c in ranked):
        best = df.groupBy(*map(quoted, names)).agg(F.max(F.struct(*map(quoted, ranked))).alias("__row"))
        return best.select(
            *(F.col(quoted(c) if c in names else f"__row.{quoted(c)}").alias(c) for c in df.columns)
        )

    ties = [F.desc_nulls_last(quoted(c)) for c in ranked if _orderable(df.schema[c].dataType)]
    ranking = Window.partitionBy(*map(quoted, names)).orderBy(*order, *(ties or [F.lit(1)]))
    return (
        df.withColumn("__place", F.row_number().over(ranking))
        .where(F.col("__place") == 1)
        .drop("__place")
    )


def typed_clean(
    df: DataFrame,
    trim: str | Sequence[str] = (),
    types: Mapping[str, str] | None = None,
    round_to: Mapping[str, int] | None = None,
) -> DataFrame:
    """Trim, then cast (bad text becomes null), then round, each on the named columns."""
    out = trim_text(df, trim) if trim else df
    out = typed(out, types) if types else out
    return out.withColumns({n: F.round(n, p) for n, p in (round_to or {}).items()})


def clean_facts(
    raw: DataFrame,
    series: str = "series_id",
    year: str = "year",
    period: str = "period",
    value: str = "value",
    parts: int | None = None,
) -> DataFrame:
    """The raw fact as (series, year, period) -> value, other columns passed through. Of
    several values for one key the largest is kept. With ``parts`` the facts come dealt out by series into so
    many, where the session's shuffle partitions would make a task's share grow with the input. Facts of
    a series with much of the rows are made unique before they are dealt out, see `frequent_codes`."""
    clean = typed_clean(
        raw,
        trim=(series, year, period, value),
        types={year: "int", value: "double"},
        round_to={value: 2},
    )
    if parts:
        keys = (series, year, period)
        hot = frequent_codes(clean, series) if parts > 1 else []
        if hot:
            often = F.coalesce(F.col(quoted(series)).isin(hot), F.lit(False))
            clean = clean.where(~often).unionByName(dedupe_by_key(clean.where(often), keys, value))
        clean = clean.repartition(parts, quoted(series))
    return dedupe_by_key(clean, (series, year, period), value)


def reference_years(
    records: DataFrame,
    where: Mapping[str, object] | None = None,
    year: str = "year",
    measure: str = "population",
) -> DataFrame:
    """The annual reference: matching records as (year int, measure long), one per year,
    the largest measure where a year is given more than once."""
    kept = records
    for name, wanted in (where or {}).items():
        kept = kept.where(F.col(name) == wanted)
    return (
        typed(kept.select(year, measure), {year: "int", measure: "bigint"})
        .groupBy(year)
        .agg(F.max(measure).alias(measure))
    )
