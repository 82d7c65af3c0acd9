"""Tables written to the shared folder to cut lineage; they survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from netsift.session import checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the one that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark)}/netsift-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
