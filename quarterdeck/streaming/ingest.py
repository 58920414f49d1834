"""Files that arrived since the last run, appended to a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarterdeck.refresh import NewestRows


def _files(
    spark: SparkSession, source: str, schema: T.StructType, file_format: str, files: str | None,
    files_per_batch: int, options: dict[str, str] | None,
) -> DataFrame:
    reader = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**(options or {}))
    )
    if files:
        reader = reader.option("pathGlobFilter", files)
    return reader.load(source)


def upsert_available(
    spark: SparkSession,
    source: str,
    target: NewestRows,
    checkpoint: str,
    file_format: str = "parquet",
    files: str | None = None,
    files_per_batch: int = 1000,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Bring every file under ``source`` not seen by this checkpoint into ``target``, the newest row of
    each key, then stop; other arguments as in `ingest_available`.

    A batch that the engine runs again, because it died before it was committed, has its old number:
    the target's ledger tells whether it is in already. Returns the target's rows.
    """
    stream = _files(spark, source, target.rows_schema, file_format, files, files_per_batch, options)
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: target.apply(rows, batch) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return target.rows()


def ingest_available(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files: str | None = None,
    files_per_batch: int = 1000,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Process every file under ``source`` not seen by this checkpoint, then stop.

    The checkpoint remembers the files, so a run after a failure continues where the last
    complete batch ended and no file is taken twice. ``files`` is a glob on file names.
    Returns the target as a batch frame.
    """
    query = (
        _files(spark, source, schema, file_format, files, files_per_batch, options)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)
