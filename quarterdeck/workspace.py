"""Where a job may write, and how its settings are read from the session."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

CONF_PREFIX = "spark.quarterdeck."


def named_parameter(spark: SparkSession, name: str, default: str) -> str:
    """A session setting; missing and empty both mean ``default``."""
    return spark.conf.get(CONF_PREFIX + name, "") or default


@dataclass(frozen=True)
class Settings:
    """Namespaces of the three layers and the landing zone to read from."""

    landing: str = "landing"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    @classmethod
    def from_session(cls, spark: SparkSession) -> Settings:
        return cls(**{f.name: named_parameter(spark, f.name, f.default) for f in fields(cls)})


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, in a folder that the driver and every executor can reach: the
    session's ``spark.checkpoint.dir``, or where that is unset the warehouse, which is shared too.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    )
    return f"{base.rstrip('/')}/quarterdeck/{name}-{uuid.uuid4().hex}"


def parts_for(rows: int, a_part: int = 1 << 19) -> int:
    """Into how many parts to deal ``rows`` rows, so that a task's share stays the same on any input. The
    session's number of shuffle partitions is fixed: with it alone, a task's share grows with the input."""
    return max(1, -(-rows // a_part))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch path and read back, which cuts its lineage: what reads it does
    not compute it again, and losing an executor costs no more than a reread."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
