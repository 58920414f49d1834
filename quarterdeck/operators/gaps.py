"""Distance to the previous point: holes in the coverage of a year or day sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of

# Points per block. An int has 2**32 values, so one block holds at most 65,536 distinct
# points and a key at most 65,536 blocks: no window partition can exceed either number.
BLOCK = 1 << 16

_INT_LIKE = (T.ByteType, T.ShortType, T.IntegerType, T.DateType)


def _ordinal(df: DataFrame, point: str) -> Column:
    kind = df.schema[point].dataType
    if not isinstance(kind, _INT_LIKE):
        raise TypeError(f"{point} is {kind.simpleString()}: cast it to int or date first")
    return F.unix_date(point) if isinstance(kind, T.DateType) else F.col(point).cast("int")


def _distance(df: DataFrame, point: str, before: Column) -> Column:
    if isinstance(df.schema[point].dataType, T.DateType):
        return F.date_diff(F.col(point), before)
    return F.col(point) - before


def with_previous(
    df: DataFrame, point: str, carry: Sequence[str] = (), keys: str | Sequence[str] | None = None
) -> DataFrame:
    """Add the struct ``previous``: ``point`` and the ``carry`` columns of the row before,
    in the order of ``point``, within ``keys``. It is null for the first row. Rows are
    unique per keys and point.

    A window over the whole table would run in one task. Here rows look back inside a
    block of neighbouring points; only the last row of each block takes part in the second
    look, which serves the first row of the next block.
    """
    names = columns_of(keys)
    rows = df.withColumn("__block", F.floor(_ordinal(df, point) / BLOCK).cast("int"))
    row = F.struct(point, *carry)

    block_order = Window.partitionBy(*names, "__block").orderBy(F.asc_nulls_first(point))
    edge_order = Window.partitionBy(*names).orderBy("__block")
    edges = (
        rows.where(F.col("__block").isNotNull())
        .groupBy(*names, "__block")
        .agg(F.max_by(row, F.col(point)).alias("__last"))
        .withColumn("__before", F.lag("__last").over(edge_order))
        .where(F.col("__before").isNotNull())
        .select(
            *(F.col(n).alias(f"__edge_{n}") for n in names),
            F.col("__block").alias("__edge_block"),
            "__before",
        )
    )
    same = F.col("__block") == F.col("__edge_block")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"__edge_{n}"))
    return (
        rows.withColumn("__inside", F.lag(row).over(block_order))
        .join(edges, same, "left")
        .select(*df.columns, F.coalesce("__inside", "__before").alias("previous"))
    )


def coverage_gaps(
    df: DataFrame,
    point: str = "year",
    measures: Sequence[str] = ("population",),
    keys: str | Sequence[str] | None = None,
    gap: str = "year_gap",
) -> DataFrame:
    """Each row with its distance to the previous point present. 1 means no hole; null
    marks the first row. Holes before the first or after the last point cannot show."""
    names = columns_of(keys)
    distance = _distance(df, point, F.col(f"previous.{point}"))
    return with_previous(df.select(*names, point, *measures), point, (), names).select(
        *names, point, *measures, distance.alias(gap)
    )


def coverage_gaps_by_key(
    df: DataFrame, keys: str | Sequence[str], point: str, gap: str = "gap"
) -> DataFrame:
    """Gaps between the distinct points of each key, from raw rows.

    Rows are reduced to distinct points before anything is ordered, so a key's window
    holds its points (days, years), however many rows the key has.
    """
    names = columns_of(keys)
    order = Window.partitionBy(*names).orderBy(point)
    points = df.select(*names, point).where(F.col(point).isNotNull()).distinct()
    distance = _distance(df, point, F.lag(point).over(order))
    return points.select(*names, point, distance.alias(gap))
