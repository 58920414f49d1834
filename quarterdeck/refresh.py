"""Answers and tables kept under a path and brought up to date by batches.

Every store here is made of parts that one run writes whole: a folder for a batch, or a folder for a
bucket of keys. A batch that is applied again replaces what it wrote before, so a run that died half
way is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of, quoted
from quarterdeck.operators.clean import dedupe_by_key
from quarterdeck.operators.incremental import best_of_totals, merged_totals, partial_totals
from quarterdeck.workspace import parts_for, written

BUCKETS = 64
# Totals of a batch up to which its series are picked out of the earlier totals by a broadcast.
FEW_ROWS = 100_000


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(buckets)).cast("int").alias("bucket")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What is stored under ``path``; no rows where nothing is yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


class BestYears:
    """Best years under ``path``: partial totals by batch, answers by batch, both cut into buckets of
    series. Batches have ascending numbers; a repeated number replaces its batch."""

    def __init__(
        self, spark: SparkSession, path: str, series: str | Sequence[str] = "series_id",
        title: str | Sequence[str] | None = "series_title", year: str = "year", buckets: int = BUCKETS, **names: str,
    ) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.series, self.title, self.year, self.names = columns_of(series), columns_of(title), year, names

    def _append(self, df: DataFrame, what: str, batch: int) -> DataFrame:
        """Write a batch's rows and return them as they are stored."""
        # a bucket is one file, or where it is large several of the advisory size of a partition
        folder = f"{self.path}/{what}/batch={batch}"
        df.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def refresh(self, facts: DataFrame, batch: int, weight: str | None = None) -> DataFrame:
        """Apply a batch and return the new answers of its series, the only ones that are read or written.
        A series that has no facts left has a row that is not ``known``."""
        own = partial_totals(
            facts, series=self.series, title=self.title, year=self.year, weight=weight, **self.names
        ).withColumn("bucket", _bucket(self.series, self.buckets))
        schema = T.StructType([*own.schema.fields, T.StructField("batch", T.LongType())])
        own = self._append(own, "totals", batch)
        numbers = [r.bucket for r in own.select("bucket").distinct().collect()]  # at most self.buckets
        before = (
            _stored(self.spark, f"{self.path}/totals", schema)
            .where(F.col("bucket").isin(numbers) & (F.col("batch") < batch))
            .drop("batch")
        )
        keys = [*self.series, "bucket"]
        many, earlier = own.count(), before.count()  # out of the files' footers
        if earlier and many <= FEW_ROWS:
            touched = own.select(*map(quoted, keys)).distinct()
            same = [F.col(f"t.{quoted(c)}").eqNullSafe(F.col(f"s.{quoted(c)}")) for c in keys]
            before = before.alias("t").join(F.broadcast(touched).alias("s"), same, "left_semi")
        # dealt out by series once, so that what follows, which all goes by series, needs no other exchange
        rows = before.withColumn("own", F.lit(False)).unionByName(own.withColumn("own", F.lit(True)))
        rows = rows.repartition(parts_for(many if many <= FEW_ROWS else many + earlier), *map(quoted, keys))
        if earlier and many > FEW_ROWS:
            rows = rows.withColumn("own", F.max("own").over(Window.partitionBy(*map(quoted, keys)))).where("own")
        totals = merged_totals(rows.drop("own")) if earlier else rows.drop("own")  # one batch's are merged
        # without a weight no fact is taken back
        answers = best_of_totals(totals, keys, self.year, gone=weight is not None)
        known = F.col("known") if weight else F.lit(True).alias("known")
        answers = answers.select(*map(quoted, ["bucket", *self.series, *self.title, self.year, "yearly_sum"]), known)
        answers = written(answers, "batch-answers")  # stays as it is when the batch is applied again
        self._append(answers, "answers", batch)
        return answers.drop("bucket")

    def current(self) -> DataFrame:
        """The newest answer of every series, after a first refresh."""
        answers = self.spark.read.parquet(f"{self.path}/answers")
        keys = [*self.series, "bucket"]
        rest = [*self.title, self.year, "yearly_sum"]
        # of a series all rows of its newest batch, which are its ties
        newest = Window.partitionBy(*map(quoted, keys)).orderBy(F.desc("batch"))
        return (
            answers.repartition(parts_for(answers.count()), *map(quoted, keys))
            .withColumn("place", F.rank().over(newest))
            .where("place = 1 AND known")
            .select(*map(quoted, [*self.series, *rest]))
        )


class NewestRows:
    """A table of one row per key under ``path``, the newest by ``newest``, in buckets of keys, and a ledger
    of the batches that were applied."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: str | Sequence[str],
        newest: str | Sequence[str], buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.keys, self.newest = columns_of(keys), columns_of(newest)
        self.rows_schema = schema
        self.stored_schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])

    def ledger(self) -> DataFrame:
        """(batch, rows, buckets) of every batch that was applied in full."""
        return _stored(self.spark, f"{self.path}/ledger", T.StructType.fromDDL("batch long, rows long, buckets int"))

    def rows(self) -> DataFrame:
        return _stored(self.spark, f"{self.path}/rows", self.stored_schema).select(*map(quoted, self.rows_schema.names))

    def apply(self, batch_rows: DataFrame, batch: int) -> bool:
        """Bring the rows of a batch in; False where the ledger has the batch already.

        Only buckets that the batch touches are read and written, each in one step. Taking the newest
        row is the same however often and in whatever order batches come, so a batch that died between
        its buckets and its line in the ledger is applied again without harm.
        """
        if not self.ledger().where(F.col("batch") == batch).isEmpty():
            return False
        own = dedupe_by_key(batch_rows.select(*map(quoted, self.rows_schema.names)), self.keys, self.newest)
        own = written(own.withColumn("bucket", _bucket(self.keys, self.buckets)), "batch-rows")
        numbers = [r.bucket for r in own.select("bucket").distinct().collect()]  # at most self.buckets
        if numbers:
            stored = _stored(self.spark, f"{self.path}/rows", self.stored_schema).where(F.col("bucket").isin(numbers))
            merged = dedupe_by_key(stored.unionByName(own), [*self.keys, "bucket"], self.newest)
            merged = written(merged, "merged-rows")  # what is replaced is not read any more
            out = merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            out.partitionBy("bucket").parquet(f"{self.path}/rows")
        line = own.agg(F.lit(batch).cast("long").alias("batch"), F.count(F.lit(1)).alias("rows"), F.lit(len(numbers)).alias("buckets"))
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/applied={batch}")
        return True
