"""Shared output shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dashed(*parts: Column | str) -> Column:
    """Join text parts with dashes; strings are column names, Columns are taken as they are."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("-", *[c.cast("string") for c in cols])


def findings(df: DataFrame, note: str | Column, detail: Column, identifier: Column, kind: str | Column,
             technique: str | None = None, dst: bool = True, keep: list[str] = ()) -> DataFrame:
    """Sensor-style finding: when, who, what was seen, and the id used for suppression."""
    text = lambda v: F.lit(v) if isinstance(v, str) or v is None else v
    return df.select(
        "ts", F.col("id_orig_h").alias("src"),
        (F.col("id_resp_h") if dst else F.lit(None).cast("string")).alias("dst"),
        text(kind).alias("kind"), text(note).alias("note"), detail.alias("detail"),
        text(technique).cast("string").alias("mitre_id"), identifier.alias("identifier"), *keep)


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in order with their ``rank``; a top-k, not a full sort."""
    from pyspark.sql import Window

    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
