"""JSON documents that hold an array of records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import rename_columns


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """One row per document. By default a document is one line, which lets Spark split
    large files; ``multi_line`` accepts pretty-printed documents, one per file. A given
    ``schema`` saves the inference pass over the data.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def explode_records(
    documents: DataFrame, records: str = "data", names: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per array element, its fields as columns renamed by ``names``.

    A document whose array is empty or null gives no rows.
    """
    rows = documents.select(F.explode(records).alias("record")).select("record.*")
    return rename_columns(rows, names or {})
