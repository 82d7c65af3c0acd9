"""Event store on Parquet: partitioned by dataset and day, scanned with pushed-down filters."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_store(df: DataFrame, path: str, dataset: str, ts: str = "ts", mode: str = "append") -> None:
    (df.withColumn("dataset", F.lit(dataset)).withColumn("day", F.to_date(ts))
     .write.mode(mode).partitionBy("dataset", "day").parquet(path))


def scan_store(spark: SparkSession, path: str, dataset: str, hours: float, now: datetime, columns: list[str] | None = None,
               exists: list[str] = (), terms: dict[str, list] | None = None, ts: str = "ts",
               max_rows: int | None = None) -> DataFrame:
    """Rows of a dataset newer than ``now`` minus ``hours``, latest partitions only.

    ``exists`` lists columns that must be set, ``terms`` columns and their allowed values.  All of
    these, and the column list, reach the Parquet scan.
    """
    since = now - timedelta(hours=hours)
    df = (spark.read.parquet(path).where((F.col("dataset") == dataset) & (F.col("day") >= F.lit(since.date())))
          .where(F.col(ts) >= F.lit(since)))
    for c in exists:
        df = df.where(F.col(c).isNotNull())
    for c, values in (terms or {}).items():
        df = df.where(F.col(c).isin(values))
    df = df.select(*columns) if columns else df.drop("dataset", "day")
    return df if max_rows is None else df.orderBy(F.desc(ts)).limit(max_rows)
