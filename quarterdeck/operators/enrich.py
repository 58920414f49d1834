"""Labels for facts out of code tables.

No join here carries a broadcast hint. Spark measures a side before it broadcasts it
(``spark.sql.autoBroadcastJoinThreshold``, on the estimate when planning and again on the
real size at run time) and otherwise shuffles both sides and splits skewed partitions,
which is the wanted behaviour for a lookup of unknown size. The one exception is
`broadcast_if_small`, for a lookup whose estimate is far too high; it measures first.

A side of a join on codes has one row per trimmed code, see `unique_codes`, so no fact is
multiplied. A code with a large share of the facts is found by a sketch and salted, see
`salted_lookup`; adaptive execution would split its partition only where the join is the last
thing in its stage that needs one.

For the same reason each lookup is joined to the facts as the plain table it is. Resolving
the lookups on the series table first would look cheaper, but the size estimate of a join is
the product of its sides: the result would never pass for small, and the facts would be
shuffled to meet it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of, quoted, series_title, trim_text

SMALL_ROWS, SMALL_BYTES = 500_000, 32 << 20


CONFLICTS = ("largest", "raise")


def unique_codes(table: DataFrame, codes: str | Sequence[str], conflicts: str = "largest") -> DataFrame:
    """One row per code of a table whose codes are trimmed; codes that differ in their padding are
    one. Where their rows disagree, the largest row is kept (nulls smallest), or the job that reads the
    result fails under ``conflicts="raise"``. Repeats collapse before the shuffle."""
    if conflicts not in CONFLICTS:
        raise ValueError(f"conflicts has to be one of {CONFLICTS}")
    names = columns_of(codes)
    rest = [c for c in table.columns if c not in names]
    if not rest:
        return table.distinct()
    row = F.struct(*map(quoted, rest))
    kept = table.groupBy(*map(quoted, names)).agg(F.max(row).alias("__row"), F.min(row).alias("__other"))
    if conflicts == "raise":
        code = F.concat_ws(", ", *(F.col(quoted(n)).cast("string") for n in names))
        broken = F.raise_error(F.concat(F.lit("rows that disagree for code "), code))
        kept = kept.withColumn("__row", F.when(F.col("__row").eqNullSafe(F.col("__other")), F.col("__row")).otherwise(broken))
    return kept.select(*map(quoted, names), *(F.col(f"__row.{quoted(c)}").alias(c) for c in rest)).select(*map(quoted, table.columns))


@dataclass(frozen=True)
class Lookup:
    """A code table. ``code`` names the column on both sides, ``text`` what it adds: a
    label, or several columns where the table also holds the code of a further lookup.
    ``conflicts`` as in `unique_codes`."""

    table: DataFrame
    code: str
    text: str | Sequence[str]
    conflicts: str = "largest"

    @property
    def added(self) -> list[str]:
        return columns_of(self.text)

    def join_to(self, df: DataFrame, codes: Sequence[str] = ()) -> DataFrame:
        """``df``, whose codes are trimmed, with the added columns last. Of these, the ones
        named in ``codes`` are themselves codes and trimmed too."""
        return df.join(self.rows(codes), self.code, "left").select(*df.columns, *self.added)

    def rows(self, codes: Sequence[str] = ()) -> DataFrame:
        """The table as a join takes it: trimmed, one row per code."""
        table = self.table.select(self.code, *self.added)
        table = trim_text(table, [c for c in table.columns if c == self.code or c in codes])
        return unique_codes(table, self.code, self.conflicts)


def broadcast_if_small(
    df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if counting shows it to be small, else ``df`` as it is.

    Meant for a lookup derived by aggregation: Spark estimates it at the size of the table
    it came from, and would shuffle the facts before finding out. Counting runs a job, one
    distributed aggregate over ``df``. Nested columns are not measured, so never hinted.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if any(isinstance(f.dataType, nested) for f in df.schema.fields):
        return df
    width = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return F.broadcast(df) if size[0] <= max_rows and (size[1] or 0) <= max_bytes else df


def left_lookup(df: DataFrame, lookup: Lookup) -> DataFrame:
    """Add the lookup's text; rows whose code is unknown keep a null. Blanks around the
    codes are ignored on both sides. Column order is kept, the text comes last."""
    return lookup.join_to(trim_text(df, lookup.code))


def frequent_codes(df: DataFrame, code: str, share: float = 0.02, tracked: int = 10_000) -> list:
    """The codes that hold more than about ``share`` of the rows, by a frequent-items sketch that every
    task fills and one step merges. It tracks ``tracked`` codes; at most 1/share codes reach the driver."""
    most = max(1, min(int(1 / share), tracked))
    sketch = F.expr(f"approx_top_k({quoted(code)}, {most}, {tracked})")
    row = df.where(F.col(quoted(code)).isNotNull()).agg(sketch.alias("top"), F.count(F.lit(1)).alias("rows")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] > share * row["rows"]]


def salted_lookup(
    df: DataFrame, lookup: Lookup, salts: int = 64, share: float = 0.02, tracked: int = 10_000
) -> DataFrame:
    """As `left_lookup`, for a lookup too large to broadcast and facts of which a few codes hold much.

    Only the rows of frequent codes are dealt out over ``salts`` keys, and only their lookup rows are
    repeated as often; all others keep one key, so nothing else moves more than in a plain join. Facts
    with a null code meet nothing and are dealt out too.
    """
    code = quoted(lookup.code)
    facts = trim_text(df, lookup.code)
    hot = frequent_codes(facts, lookup.code, share, tracked)
    is_hot = F.col(code).isin(hot) if hot else F.lit(False)
    dealt = facts.withColumn(
        "__salt", F.when(is_hot | F.col(code).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int")
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    table = lookup.rows().withColumn("__salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return dealt.join(table, [lookup.code, "__salt"], "left").select(*map(quoted, [*df.columns, *lookup.added]))


def label_facts(
    facts: DataFrame,
    series: DataFrame,
    lookups: Sequence[Lookup],
    key: str | Sequence[str] = "series_id",
    title: str = "series_title",
    title_of: Sequence[str] | None = None,
    trimmed: bool = False,
) -> DataFrame:
    """Facts with the codes of their series, the text of every code, and a title made of
    the labels ``title_of`` (by default every text column, in the order of the lookups).

    Facts of an unknown series stay, with null codes and labels and an empty title. Every fact
    comes out once: series that differ in their padding only are one, see `unique_codes`. ``trimmed``
    says that the facts' keys are trimmed already; facts dealt out by them then stay where they are.
    """
    names = columns_of(key)
    added = [c for c in series.columns if c not in names]
    out = (
        (facts if trimmed else trim_text(facts, names))
        .join(unique_codes(trim_text(series, [*names, *added]), names), names, "left")
        .select(*facts.columns, *added)
    )
    codes = [lookup.code for lookup in lookups]
    for lookup in lookups:
        out = lookup.join_to(out, codes)
    labels = title_of or [c for lookup in lookups for c in lookup.added]
    return out.withColumn(title, series_title(labels))


def lookup_resolution(df: DataFrame, labels: Sequence[str], weight: str | None = None) -> DataFrame:
    """Per label column: rows, and rows whose label is missing. One aggregation. ``weight`` names a
    column that says for how many rows each row stands, as after counting per code."""
    stands_for = F.col(weight) if weight else F.lit(1).cast("bigint")

    def total(of: Column) -> Column:
        return F.coalesce(F.sum(F.when(of, stands_for)), F.lit(0).cast("bigint"))

    counts = df.agg(
        F.array(
            *(
                F.struct(
                    F.lit(name).alias("label"),
                    total(F.lit(True)).alias("rows"),
                    total(F.col(name).isNull()).alias("missing"),
                )
                for name in labels
            )
        ).alias("checks")
    )
    return counts.select(F.inline("checks"))
