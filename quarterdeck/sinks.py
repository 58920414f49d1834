"""Tables out of frames: namespaces, overwrite, description, layout."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of, interleaved, quoted


# Between a table's name and the number of a version; the view's property that names the version.
VERSION = "__v"
SHOWN = "quarterdeck.version"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema unless it exists."""
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def clustered(df: DataFrame, keys: str | Sequence[str], curve: bool = False, files: int | None = None) -> DataFrame:
    """Rearrange the rows so that each file covers a narrow key range.

    The ranges also run over a hash of the row. A key with a large share of the rows is
    therefore cut into several files instead of filling one, which bucketing on the key
    could not do; and being a function of the row, the cut is the same in a repeated task.
    It costs a shuffle and a sampling pass over ``df``. ``files`` sets how many ranges there are.

    Sorted by its first key, a file covers any value of the others. With ``curve`` the order is that of
    `curve_key`, and files are narrow in every key, so that a filter on any of them skips files.
    """
    names = columns_of(keys)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [curve_key(df, names)] if curve else [F.col(quoted(n)) for n in names]
    count = [files] if files else []
    return df.repartitionByRange(*count, *order, F.xxhash64(*map(quoted, plain))).sortWithinPartitions(*order)


def curve_key(df: DataFrame, keys: Sequence[str], bits: int = 16) -> Column:
    """A number in which the bits of all ``keys`` take turns. Numbers and dates are spread evenly between
    their least and greatest value, which costs one aggregation; text is spread by its hash, so files
    are narrow for one value of it but not for a range. Null is the lowest."""
    bits = min(bits, 62 // max(len(keys), 1))
    cells = (1 << bits) - 1

    def number(name: str) -> Column | None:
        kind = df.schema[name].dataType
        if isinstance(kind, T.DateType):
            return F.unix_date(quoted(name)).cast("double")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.col(quoted(name)).cast("timestamp").cast("double")
        return F.col(quoted(name)).cast("double") if isinstance(kind, T.NumericType) else None

    numbers = {n: number(n) for n in keys}
    known = [n for n in keys if numbers[n] is not None]
    ends = df.agg(F.lit(1), *(f(numbers[n]) for n in known for f in (F.min, F.max))).first()[1:]
    ranks = []
    for n in keys:
        if n in known:
            low, high = ends[2 * known.index(n)], ends[2 * known.index(n) + 1]
            width = (high - low) if low is not None and high > low else 1.0
            rank = F.floor((numbers[n] - F.lit(low or 0.0)) / F.lit(width) * F.lit(cells - 1)) + 1
        else:
            rank = F.pmod(F.xxhash64(quoted(n)), F.lit(cells)) + 1
        ranks.append(F.when(F.col(quoted(n)).isNull(), 0).otherwise(F.least(rank, F.lit(cells))))
    return interleaved(ranks, bits)


def describe(
    spark: SparkSession,
    table: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Attach a comment and key/value properties to a table."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def publish(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    cluster_by: str | Sequence[str] | None = None,
    sort_by: str | Sequence[str] | None = None,
    partition_by: str | Sequence[str] | None = None,
    bucket_by: str | Sequence[str] | None = None,
    buckets: int = 0,
    curve_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Replace ``table`` by the rows of ``df`` and return the table. Re-running converges:
    the table is a function of its inputs alone.

    The rows are written to a version of their own, a table named ``<table>__v<number>``, and
    ``table`` is a view of the newest complete version, switched in one step (`switch`). So there is
    no moment without a table: readers and ``df`` itself may read it all the while, a job that fails
    or dies before the switch leaves the old rows, and a query that began on the old version can
    end on it. The version before stays until the next replacement; older ones are dropped.

    ``sort_by`` orders the rows inside each file without moving them between files, so that
    a filter on the leading column skips most row groups. It is free where the rows already
    come in that order, as they do out of a de-duplication on the same keys. ``cluster_by``
    gives whole files a key range, see `clustered`, and ``curve_by`` ranges of several keys at
    once. ``bucket_by`` files the rows into
    ``buckets`` by a hash of the columns, one file each, so that a later grouping on them (or
    on more columns) needs no shuffle; the columns have to spread the rows evenly, as the
    leading part of a unique key does.
    """
    spark = df.sparkSession
    rows = df
    if cluster_by:
        rows = clustered(df, cluster_by)
    elif curve_by:
        rows = clustered(df, curve_by, curve=True)
    elif bucket_by:
        rows = df.repartition(buckets, *columns_of(bucket_by))
    elif sort_by:
        rows = df.sortWithinPartitions(*columns_of(sort_by))
    writer = rows.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*columns_of(partition_by))
    if bucket_by:
        writer = writer.bucketBy(buckets, *columns_of(bucket_by)).sortBy(*columns_of(bucket_by))
    fresh = f"{table}{VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    try:
        writer.saveAsTable(fresh)
        describe(spark, fresh, comment, properties)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    before = switch(spark, table, fresh, comment, properties)
    retire(spark, table, (before, fresh))
    return spark.read.table(table)


def versions(spark: SparkSession, table: str) -> list[str]:
    """The versions of a published table that exist, oldest first."""
    schema, _, name = table.rpartition(".")
    where = f" IN {schema}" if schema else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{name}{VERSION}*'").collect()
    return sorted(f"{schema}.{r.tableName}" if schema else r.tableName for r in found)


def current_version(spark: SparkSession, table: str) -> str | None:
    """The version that ``table`` shows; None where it is not a published table."""
    if not spark.catalog.tableExists(table):
        return None
    told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return told.get(SHOWN)


def switch(
    spark: SparkSession,
    table: str,
    version: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> str | None:
    """Make ``table`` a view of ``version`` and return the version it showed before.

    That is one change of one catalog entry. Only where ``table`` is still a plain table, from before
    versions, it is first renamed to one."""
    before = current_version(spark, table)
    if before is None and spark.catalog.tableExists(table):
        before = f"{table}{VERSION}{0:020d}_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    told = {**(properties or {}), SHOWN: version}
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in told.items())
    remark = f" COMMENT {_quoted(comment)}" if comment is not None else ""
    spark.sql(f"CREATE OR REPLACE VIEW {table}{remark} TBLPROPERTIES ({pairs}) AS SELECT * FROM {version}")
    return before


def retire(spark: SparkSession, table: str, keep: Sequence[str | None]) -> list[str]:
    """Drop the versions of ``table`` that are older than the newest of ``keep`` and not in it, and
    return them. What a crash left behind goes with them; newer versions, which another run may
    be writing, stay."""
    newest = max(v for v in keep if v)
    old = [v for v in versions(spark, table) if v < newest and v not in keep]
    for version in old:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    return old


def publish_query(
    spark: SparkSession,
    table: str,
    select: str,
    inputs: Mapping[str, DataFrame],
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Publish the result of a SELECT whose ``{name}`` placeholders stand for frames and whose
    ``:name`` parameters for the literals ``args``."""
    return publish(spark.sql(select, args=dict(args or {}), **inputs), table, comment, properties)


def land_snapshot(df: DataFrame, path: str, day: str, column: str = "ingest_date") -> None:
    """Write a complete point-in-time copy under ``path``/``column``=``day``. A repeated
    landing of the day replaces it; other days are untouched."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={day}")
