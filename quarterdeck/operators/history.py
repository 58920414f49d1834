"""Runs over time: a ledger of their numbers, and bounds for a run out of the runs before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns_of, quoted

# Values that a sketch holds before it begins to approximate.
ACCURACY = 200


def run_numbers(
    df: DataFrame, run: str, checks: dict[str, str], dataset: str | None = None, measure: str | None = None
) -> DataFrame:
    """One ledger line per run and check: (dataset, run, check, rows, number). ``checks`` maps a name to a
    predicate as SQL text; the number is how many rows break it. The check ``rows`` counts all rows. With a
    ``measure`` every line also has a quantile sketch of it, ``spread``, that merges with those of other
    runs. One aggregation."""
    broken = {name: F.count_if(~F.coalesce(F.expr(test), F.lit(False))) for name, test in checks.items()}
    lines = [
        F.struct(F.lit(name).alias("check"), number.cast("long").alias("number"))
        for name, number in {"rows": F.count(F.lit(1)), **broken}.items()
    ]
    spread = [F.kll_sketch_agg_double(F.col(quoted(measure)).cast("double"), F.lit(ACCURACY)).alias("spread")] if measure else []
    found = df.groupBy(F.col(quoted(run)).alias("run")).agg(F.count(F.lit(1)).alias("rows"), F.array(*lines).alias("lines"), *spread)
    return found.select(
        F.lit(dataset).cast("string").alias("dataset"), "run", "rows", F.inline("lines"), *(["spread"] if measure else [])
    )


def append_runs(numbers: DataFrame, path: str) -> None:
    """Add lines to the ledger under ``path``. Runs are folders, so a run that is logged again replaces its
    lines; the lines of other runs stay as they are."""
    numbers.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def out_of_bounds(
    ledger: DataFrame, low: float = 0.0, high: float = 1.0, slack: float = 0.0, least: int = 5,
    order: str = "run", keys: str | Sequence[str] = ("dataset", "check"),
) -> DataFrame:
    """The ledger with bounds for each line's number and whether it is ``outside``.

    Bounds are the quantiles ``low`` and ``high`` of the numbers of earlier runs, widened by the share
    ``slack`` of themselves; a line with fewer than ``least`` runs before it has none. Earlier runs are
    merged as quantile sketches, so a line's bounds cost the same however long the history is, and are
    exact while it holds no more than about ``ACCURACY`` runs. A window holds the runs of one check.
    """
    names = columns_of(keys)
    before = Window.partitionBy(*map(quoted, names)).orderBy(quoted(order)).rowsBetween(Window.unboundedPreceding, -1)
    sketch = F.kll_sketch_agg_bigint("number", F.lit(ACCURACY)).over(before)
    known = ledger.withColumn("runs_before", F.count(F.lit(1)).over(before)).withColumn("__sketch", sketch)
    enough = F.col("runs_before") >= max(least, 1)
    bound = {
        "lower": F.kll_sketch_get_quantile_bigint("__sketch", F.lit(low)) * F.lit(1 - slack),
        "upper": F.kll_sketch_get_quantile_bigint("__sketch", F.lit(high)) * F.lit(1 + slack),
    }
    judged = known.withColumns({name: F.when(enough, value) for name, value in bound.items()})
    outside = F.coalesce((F.col("number") < F.col("lower")) | (F.col("number") > F.col("upper")), F.lit(False))
    return judged.select(*map(quoted, [*names, order]), "number", "runs_before", "lower", "upper", outside.alias("outside"))


def drifted(
    ledger: DataFrame, low: float = 0.25, high: float = 0.75, order: str = "run", keys: str | Sequence[str] = ("dataset",)
) -> DataFrame:
    """One line per run: the median of its measure against the quantiles of all measures of earlier runs,
    out of the ``spread`` sketches of the ledger's ``rows`` lines. The measures are not read again."""
    names = columns_of(keys)
    before = Window.partitionBy(*map(quoted, names)).orderBy(quoted(order)).rowsBetween(Window.unboundedPreceding, -1)
    lines = ledger.where(F.col("check") == "rows").withColumn("__before", F.kll_merge_agg_double("spread", F.lit(ACCURACY)).over(before))
    known = F.kll_sketch_get_n_double("__before") > 0
    at = lambda sketch, q: F.kll_sketch_get_quantile_double(sketch, F.lit(q))
    judged = lines.select(
        *map(quoted, [*names, order]), at("spread", 0.5).alias("median"),
        F.when(known, at("__before", low)).alias("lower"), F.when(known, at("__before", high)).alias("upper"),
    )
    outside = F.coalesce((F.col("median") < F.col("lower")) | (F.col("median") > F.col("upper")), F.lit(False))
    return judged.withColumn("outside", outside)
