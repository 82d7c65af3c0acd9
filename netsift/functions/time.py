"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp column."""
    return F.unix_micros(_col(c).cast("timestamp"))


def floor_to(c: Column | str, seconds: int) -> Column:
    """Timestamp rounded down to a multiple of ``seconds`` since the epoch."""
    width = seconds * 1_000_000
    return F.timestamp_micros(micros(c) - F.pmod(micros(c), F.lit(width)))
