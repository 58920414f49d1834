"""Tables by name, and the inventory of a landing folder."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of, last_segment, quoted


def qualified(name: str, schema: str | None = None) -> str:
    return f"{schema}.{name}" if schema else name


def read_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A table of the current schema, or of ``schema`` when one is given."""
    return spark.read.table(qualified(name, schema))


def landing_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The files directly under ``path`` (directories are not files and do not appear).

    Only file status is used: the content column is pruned and never read.
    """
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            last_segment("path").alias("filename"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def snapshots(spark: SparkSession, path: str, column: str = "ingest_date") -> DataFrame:
    """(day, files, bytes) of the snapshots under ``path``, one folder ``column``=day each. Files are
    listed, none is read."""
    listed = spark.read.format("binaryFile").load(path).select(F.col(column).cast("date").alias("day"), "length")
    return listed.groupBy("day").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def read_as_of(
    spark: SparkSession, path: str, day: date | None = None, schema: T.StructType | None = None, column: str = "ingest_date"
) -> DataFrame:
    """The newest snapshot that is not after ``day`` (by default the newest of all); no rows where there is
    none so early. Which one that is comes from the folders' names, so no other folder is opened. A
    ``schema`` without ``column`` saves the look into a file's footer."""
    kept = snapshots(spark, path, column)
    if day is not None:
        kept = kept.where(F.col("day") <= F.lit(day))
    newest = kept.agg(F.max("day")).first()[0]
    reader = spark.read if schema is None else spark.read.schema(schema.add(column, "date", True))
    return reader.parquet(path).where(F.col(column) == F.lit(newest))


def file_ranges(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """(file, rows, least_*, most_*) of the files a frame is read from: what a reader that skips files by
    their column statistics has to go by."""
    names = columns_of(columns)
    ends = [f(quoted(n)).alias(f"{label}_{n}") for n in names for label, f in (("least", F.min), ("most", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def files_touched(ranges: DataFrame, column: str, value: object) -> DataFrame:
    """(files, touched): all files of `file_ranges`, and those that may hold ``column`` = ``value``."""
    inside = F.lit(value).between(F.col(quoted(f"least_{column}")), F.col(quoted(f"most_{column}")))
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if(inside).alias("touched"))
