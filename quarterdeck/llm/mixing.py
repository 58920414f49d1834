"""Mix sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source has a target in words. A document of a source is expected ``target / size of the
source`` times: the whole part is certain, and for the fraction p that is left documents compete.
Each draws a random U from its id and gets the Pareto key ``(U / (1 - U)) / (p / (1 - p))``; the
smallest keys are taken until the words that the target still lacks are reached, to the nearest
document, so a source misses its target by at most half a document.

Nothing sorts a whole source. A histogram of the keys in about sqrt(n) bins finds the one bin in
which the words run out, and only the documents of that bin are put in order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterdeck.llm.text import word_count
from quarterdeck.workspace import written

# Sources of a plan up to which it is broadcast; a larger plan is joined.
BROADCAST_SOURCES = 100_000


def _numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """Rows with their place, from 0, by ascending ``by``, null last; no task sees all of them."""
    order = F.col(by).asc_nulls_last()
    parts = written(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "order")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before")
    )  # one row per partition
    place = F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1 + F.col("_before")
    return parts.join(F.broadcast(before), "_part").withColumn(name, place).drop("_part", "_before")


def targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: int = 3
) -> DataFrame:
    """(source, source_size, target) for (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes.
    No target is over ``cap`` times its source; the excess is shared among the others by weight
    until none is above. Each round is one aggregate over the sources.
    """
    numbered = _numbered(sizes, "source", "_place")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights)).cast("int"))
    known = written(
        numbered.select("source", "source_size", weight.alias("weight")), "sources"
    )
    most = F.col("source_size") * cap
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, -1
    while total:
        over = F.col("weight") * F.lit(level) > most
        capped, rest, count = known.agg(
            F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)
        ).first()
        if count == above:
            break
        above, level = count, (total - (capped or 0)) / rest
    target = F.when(F.col("weight") * F.lit(level) > most, most.cast("double")).otherwise(
        F.col("weight") * F.lit(level)
    )
    return known.select("source", "source_size", target.alias("target"))


def _with(docs: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """Documents beside their source's line of the plan, as column ``_plan``."""
    line = plan.select(F.struct(*plan.columns).alias("_plan"))
    if plan.count() <= BROADCAST_SOURCES:
        line = F.broadcast(line)
    return docs.join(line, F.col(source).eqNullSafe(F.col("_plan.source")), "left")


def _name(doc_id: str, text: str) -> Column:
    """What a document draws by: its id and a hash of its text, so that rows which share an id part."""
    own = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), own)


def _pareto_key(name: Column, seed: str) -> Column:
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 12), 16, 10).cast("double")
    u = (drawn + 0.5) / float(1 << 48)
    p = F.col("_plan.fraction")
    return (u / (1 - u)) / (p / (1 - p))


def _bin(key: Column, bins: int) -> Column:
    return F.floor(key / (1 + key) * bins).cast("long")


def plan_mix(
    sized: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """One row per source of ``sized`` (name, source, size): ``source, source_size, target,
    whole`` copies, ``fraction``, and what tells who gets another copy: ``bins, last_bin,
    last`` (key, name, size)."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = (
        targets(sizes, weights, cap)
        .withColumn("whole", F.floor(ratio).cast("long"))
        .withColumn("fraction", ratio - F.col("whole"))
        .withColumn("lacking", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    shares = written(shares, "shares")
    bins = max(1, math.isqrt(sized.count()))

    drawn = (
        _with(sized, shares, "source")
        .where(F.col("_plan.fraction") > 0)
        .withColumn("key", _pareto_key(F.col("name"), seed))
        .withColumn("bin", _bin(F.col("key"), bins))
        .select("source", "bin", "key", "name", "size", F.col("_plan.lacking").alias("lacking"))
    )
    filled = drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("lacking").alias("lacking"))
    upto = F.sum("words").over(W.partitionBy("source").orderBy("bin"))
    tipping = (
        filled.withColumn("upto", upto)
        .where((F.col("upto") > F.col("lacking")) & (F.col("upto") - F.col("words") <= F.col("lacking")))
        .select("source", F.col("bin").alias("last_bin"), (F.col("upto") - F.col("words")).alias("before"))
    )
    tipping = written(tipping, "tipping")

    edge = tipping.select(F.struct(*tipping.columns).alias("_edge"))
    if tipping.count() <= BROADCAST_SOURCES:
        edge = F.broadcast(edge)
    inside = drawn.join(
        edge, F.col("source").eqNullSafe(F.col("_edge.source")) & (F.col("bin") == F.col("_edge.last_bin"))
    )
    # rows alike in all of these stand or fall together
    order = ("key", "name", "size")
    alike = F.sum("size").over(W.partitionBy("source", *order))
    reached = F.sum("size").over(W.partitionBy("source").orderBy(*order)) + F.col("_edge.before")
    last = (
        inside.withColumn("alike", alike)
        .withColumn("reached", reached)
        .where(2 * F.col("reached") - F.col("alike") <= 2 * F.col("lacking"))
        .groupBy("source")
        .agg(F.max(F.struct(*order)).alias("last"))
    )
    null_safe = lambda other, name: F.col("source").eqNullSafe(other[name])
    bounds = tipping.select(F.col("source").alias("s1"), "last_bin")
    lasts = last.select(F.col("source").alias("s2"), "last")
    return written(
        shares.drop("lacking")
        .withColumn("bins", F.lit(bins))
        .join(bounds, null_safe(bounds, "s1"), "left")
        .join(lasts, null_safe(lasts, "s2"), "left")
        .drop("s1", "s2"),
        "plan",
    )


def with_copies(
    docs: DataFrame, plan: DataFrame, size: Column, name: Column, source: str = "source", seed: str = "mix"
) -> DataFrame:
    """``docs`` with a column ``_plan`` (the line of the source) and ``_copies``: how many times
    the mix takes the document. ``name``, ``source`` and ``size`` have to be those planned with."""
    key = _pareto_key(name, seed)
    where = F.floor(key / (1 + key) * F.col("_plan.bins")).cast("long")
    own = F.struct(key.alias("key"), name.alias("name"), size.alias("size"))
    extra = F.when(F.col("_plan.fraction") <= 0, False).when(F.col("_plan.last_bin").isNull(), True).otherwise(
        (where < F.col("_plan.last_bin"))
        | ((where == F.col("_plan.last_bin")) & F.coalesce(own <= F.col("_plan.last"), F.lit(False)))
    )
    return _with(docs, plan, source).withColumn(
        "_copies", F.col("_plan.whole") + F.coalesce(extra, F.lit(False)).cast("long")
    )


def _sized(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """(doc_id, source, name, size), written once: sizes are counted over the whole texts."""
    return written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            _name(doc_id, text).alias("name"),
            word_count(F.col(text)).alias("size"),
        ),
        "sized",
    )


def mix_report(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    weights: Sequence[float] = (5, 2, 1), cap: int = 3, seed: str = "mix",
) -> DataFrame:
    """What the mix takes: ``doc_id, size, source_size, target, copies, taken``, one row per row.

    ``size`` is the number of words of the text (null: 0), ``taken`` the words taken with repeats.
    Documents without words are never counted as taken words. Null is a source of its own, the
    last; rows alike in id and text are taken or left together; null ids are an id like others; no rows
    give no rows; other columns are ignored.
    """
    sized = _sized(docs, doc_id, source, text)
    chosen = with_copies(sized, plan_mix(sized, weights, cap, seed), F.col("size"), F.col("name"), seed=seed)
    return chosen.select(
        "doc_id",
        "size",
        F.col("_plan.source_size").alias("source_size"),
        F.col("_plan.target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    weights: Sequence[float] = (5, 2, 1), cap: int = 3, seed: str = "mix",
) -> DataFrame:
    """The mixed documents themselves, all columns of ``docs``, a row for each copy taken."""
    plan = plan_mix(_sized(docs, doc_id, source, text), weights, cap, seed)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        _name(doc_id, text).alias("name"),
        word_count(F.col(text)).alias("size"),
    )
    chosen = with_copies(packed, plan, F.col("size"), F.col("name"), seed=seed).where(F.col("_copies") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return chosen.select("_row", copies.alias("_copy")).select("_row.*")


# The same in SQL, from the definition: a prefix of each source in the order of the keys.
ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS name,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM sizes),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sizes)
             - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
settled AS (SELECT level FROM levels WHERE weight * level <= 3 * source_size ORDER BY k LIMIT 1),
shares AS (
  SELECT source, source_size,
         CASE WHEN weight * (SELECT level FROM settled) > 3 * source_size THEN (3 * source_size)::DOUBLE
              ELSE weight * (SELECT level FROM settled) END AS target
  FROM sizes),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio FROM shares),
drawn AS (
  SELECT d.doc_id, d.name, d.size, p.*, floor(ratio)::BIGINT AS whole, ratio - floor(ratio) AS fraction,
         (('0x' || substr(md5('mix:' || name), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source),
keyed AS (
  SELECT *, CASE WHEN fraction > 0 THEN (u / (1 - u)) / (fraction / (1 - fraction)) END AS key FROM drawn),
reached AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, name, size) AS upto,
         sum(size) OVER (PARTITION BY source, key, name, size) AS alike
  FROM keyed)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       whole + CASE WHEN fraction > 0 AND 2 * upto - alike <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS copies,
       (whole + CASE WHEN fraction > 0 AND 2 * upto - alike <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) * size AS taken
FROM reached
"""
