"""Continuous ingest of JSON logs and alert events from a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netsift.sources import alerts, logs


def stream_log(spark: SparkSession, path: str, kind: str, extra: list[str] = (), files_per_batch: int = 1000) -> DataFrame:
    raw = (spark.readStream.schema(logs.json_schema(kind, extra)).option("mode", "DROPMALFORMED")
           .option("maxFilesPerTrigger", files_per_batch).json(path))
    return logs._from_json(raw, kind)


def stream_events(spark: SparkSession, path: str, event_types: list[str] | None = None,
                  files_per_batch: int = 1000) -> DataFrame:
    """Events from JSON lines; fields that are not declared stay in ``extra``, as in ``alerts.read_events``."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return alerts._of_types(alerts.parsed(raw), event_types)
