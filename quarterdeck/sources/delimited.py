"""Delimited text with a header row."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import clean_names, quoted
from quarterdeck.workspace import written

RESCUED = "_rescued"


def read_delimited(spark: SparkSession, path: str, delimiter: str = "\t") -> DataFrame:
    """Every column as text, named by the trimmed header."""
    raw = spark.read.option("delimiter", delimiter).option("header", True).csv(path)
    return clean_names(raw)


def read_delimited_set(
    spark: SparkSession, root: str, files: Mapping[str, str], delimiter: str = "\t"
) -> dict[str, DataFrame]:
    """One text table per entry of ``files`` (dataset name -> file name under ``root``)."""
    return {
        name: read_delimited(spark, f"{root.rstrip('/')}/{file}", delimiter)
        for name, file in files.items()
    }


def read_with_rescue(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = "\t"
) -> DataFrame:
    """Typed read of files of one layout under an explicit schema that loses no line.

    Fields are found by the names in the header, which is the first line; its copies at the head of other
    files are skipped. Columns of the schema that it lacks are null. A line that does not fit keeps the
    fields that do, and its full text in ``_rescued``; for every other line that column is null. Lines
    are parsed whole, as a column: the file reader would parse only the fields a query needs, and so
    miss bad ones elsewhere. Files of different layouts are for `read_by_header`.
    """
    lines = spark.read.text(path)
    header = lines.first()
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    names = [n.strip() for n in header[0].split(delimiter)] if header else list(kinds)
    if not set(names) & set(kinds):
        raise ValueError(f"the header of {path} has none of the columns {', '.join(kinds)}")
    # a name's first field has the column's type; other fields are text under names of their own
    fields = [
        (n, kinds[n]) if n in kinds and n not in names[:i] else (f"__field_{i}", "string") for i, n in enumerate(names)
    ]
    ddl = ", ".join(f"{quoted(name)} {kind}" for name, kind in [*fields, (RESCUED, "string")])
    options = {
        "sep": delimiter,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RESCUED,
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    }
    line = F.col("value")
    read = [
        (F.col(f"row.{quoted(n)}") if n in names else F.lit(None).cast(kind)).alias(n) for n, kind in kinds.items()
    ]
    return (
        lines.where((line != F.lit(header[0] if header else "")) & (F.trim(line) != ""))
        .select(F.from_csv(line, ddl, options).alias("row"))
        .select(*read, F.col(f"row.{RESCUED}").alias(RESCUED))
    )


def file_headers(spark: SparkSession, path: str, delimiter: str = "\t") -> DataFrame:
    """(file, names) of every delimited file: its first line, cut at the delimiter and trimmed. A name that
    comes again in a line is followed by # and its place, which counts from 1.

    One aggregation of a line per task and file; only the first block of a file takes part in it.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        F.monotonically_increasing_id().alias("line"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("value"))
    given = F.transform(F.split("value", re.escape(delimiter)), lambda n: F.trim(n))
    named = F.transform(
        "names",
        lambda n, i: F.when(F.array_position(F.col("names"), n) == i + 1, n).otherwise(F.concat(n, F.lit("#"), i + 1)),
    )
    return first.select("file", given.alias("names")).select("file", named.alias("names"))


def read_by_header(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = "\t"
) -> DataFrame:
    """Typed read of files that need not agree in their columns: every file's own header says where its
    fields are. Nothing is lost: what the schema has no place for is kept by name in ``_rescued``, a
    VARIANT, which is null for a row that fits.

    * A column that a file lacks is null. Blank fields are null.
    * A value that is none of its column's type is null there and kept as text under the column's name.
    * A field that the schema does not have is kept under its name, one beyond the header under # and
      its place; a line with fewer fields than its header has their number under ``#fields``.

    Fields are cut at the delimiter as they are, without quotes. Lines and headers meet in a join on the
    file. There is a line for each file on one side, whose written size decides whether it is broadcast.
    """
    headers = written(file_headers(spark, path, delimiter), "headers")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    places = [F.array_position("names", n).cast("int").alias(f"__at_{i}") for i, n in enumerate(kinds)]
    known = F.array(*(F.lit(n) for n in kinds)) if kinds else F.array().cast("array<string>")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")
    rows = lines.join(headers.select("file", "names", *places), "file").withColumn(
        "fields", F.transform(F.split("value", re.escape(delimiter), -1), lambda v: F.nullif(F.trim(v), F.lit("")))
    )
    # the header itself, wherever it stands, has its names as its fields
    head = F.forall(
        F.arrays_zip("names", "fields"),
        lambda z: F.coalesce(z["fields"], F.lit("")) == F.regexp_replace(F.coalesce(z["names"], F.lit("")), "#[0-9]+$", ""),
    )
    rows = rows.where(~(head & (F.size("names") == F.size("fields"))))
    raw = {n: F.when(F.col(f"__at_{i}") > 0, F.get("fields", F.col(f"__at_{i}") - 1)) for i, n in enumerate(kinds)}
    value = {n: raw[n].try_cast(kind) for n, kind in kinds.items()}

    def entry(name: str | Column, text: Column) -> Column:
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("key"), text.alias("value"))

    unfit = [F.when(raw[n].isNotNull() & value[n].isNull(), entry(n, raw[n])) for n in kinds]
    few = F.when(F.size("fields") < F.size("names"), entry("#fields", F.size("fields").cast("string")))
    others = F.transform(
        "fields",
        lambda v, i: F.when(
            v.isNotNull() & ~F.coalesce(F.array_contains(known, F.get("names", i)), F.lit(False)),
            entry(F.coalesce(F.get("names", i), F.concat(F.lit("#"), (i + 1).cast("string"))), v),
        ),
    )
    kept = F.array_compact(F.concat(F.array(*unfit, few), others))
    rescued = F.when(F.size("kept") > 0, F.to_variant_object(F.map_from_entries("kept")))
    return rows.select(*(value[n].alias(n) for n in kinds), kept.alias("kept")).select(
        *map(quoted, kinds), rescued.alias(RESCUED)
    )


def write_delimited(df: DataFrame, path: str, delimiter: str = "\t") -> None:
    """Land a frame as delimited text; padding in names and values is preserved."""
    (
        df.write.mode("overwrite")
        .option("delimiter", delimiter)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
