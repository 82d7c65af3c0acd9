"""Notice clean-up: suppression of repeats and allow-lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions.time import floor_to
from netsift.operators.anchored import throttle


def suppress(notices: DataFrame, seconds: int = 3600, identifier: str = "identifier", order: list[str] = (),
             anchor: str = "first_event") -> DataFrame:
    """Keep the first notice of an identifier and drop repeats for ``seconds`` after it.

    The calendar form keeps the first notice per identifier and time bucket; it needs only a
    mergeable aggregate.
    """
    if anchor == "first_event":
        return throttle(notices, [identifier], "ts", seconds, list(order))
    rest = [c for c in notices.columns if c != identifier]
    first = F.min_by(F.struct(*rest), F.struct("ts", *order)).alias("first")
    return (notices.groupBy(identifier, floor_to("ts", seconds).alias("bucket")).agg(first)
            .select(identifier, "first.*").select(*notices.columns))


def without_allowed(df: DataFrame, allowed: DataFrame, column: str, key: str) -> DataFrame:
    """Drop rows whose ``column`` is in the allow-list table."""
    return df.join(allowed.select(F.col(key).alias(column)).distinct(), column, "left_anti")
