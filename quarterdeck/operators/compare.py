"""Proof that two frames hold the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import columns_of, quoted


def two_way_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows only ``left`` and only ``right`` has, repeats counted.

    Both directions come out of one aggregation over the union: per distinct row, the
    difference of the two multiplicities. Columns are matched by position.
    """
    names = left.columns
    tagged = left.withColumn("__n", F.lit(1)).unionAll(
        right.toDF(*names).withColumn("__n", F.lit(-1))
    )
    surplus = F.col("__surplus")
    return (
        tagged.groupBy(*names)
        .agg(F.sum("__n").alias("__surplus"))
        .agg(
            F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("only_left"),
            F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("only_right"),
        )
    )


def only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows that ``left`` has more often than ``right``."""
    return left.exceptAll(right)


def differing_rows(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], buckets: int = 4096
) -> DataFrame:
    """The rows that one side has more often, with ``surplus``: by how much ``left`` has more of them,
    negative where ``right`` has. Columns are matched by position, keys are named as in ``left``.

    Each side is first reduced to a number per bucket of keys, which does not depend on the order of rows:
    how many there are and the sums of two hashes of them. Only rows of buckets whose numbers differ
    are compared, so frames that agree cost a scan and an exchange of ``buckets`` lines a task. Rows
    that differ have differing numbers but for a chance of 2**-128.
    """
    names = left.columns
    both = left.withColumn("__n", F.lit(1)).unionAll(right.toDF(*names).withColumn("__n", F.lit(-1)))
    hashed = both.withColumn("__bucket", F.pmod(F.xxhash64(*map(quoted, columns_of(keys))), F.lit(buckets)))
    first, second = (F.xxhash64(F.lit(seed), *map(quoted, names)).cast("decimal(20,0)") for seed in (1, 2))
    numbers = hashed.groupBy("__bucket").agg(
        F.sum("__n").alias("rows"), F.sum(first * F.col("__n")).alias("first"), F.sum(second * F.col("__n")).alias("second")
    )
    odd = numbers.where("rows <> 0 OR first <> 0 OR second <> 0").select("__bucket")
    return (
        hashed.join(F.broadcast(odd), "__bucket", "left_semi")  # at most ``buckets`` numbers
        .groupBy(*map(quoted, names))
        .agg(F.sum("__n").alias("surplus"))
        .where("surplus <> 0")
    )
