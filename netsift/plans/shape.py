"""Helpers that make query results comparable between engines, and SQL for anchored chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Timestamps become epoch microseconds (``x`` -> ``x_us``) and doubles are rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.unix_micros(c.cast("timestamp")).alias(f"{f.name}_us"))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(c.cast("double"), digits).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def chain(name: str, rows: str, width: int | str) -> str:
    """Recursive CTE: opening positions ``s`` of the anchored windows over rows(key, t)."""
    return (f"{name}(key, s) AS (SELECT key, min(t) FROM {rows} GROUP BY key UNION ALL "
            f"SELECT c.key, min(r.t) FROM {name} c JOIN {rows} r ON r.key = c.key AND r.t >= c.s + {width} "
            f"GROUP BY c.key, c.s)")


def placed(name: str, rows: str, chained: str) -> str:
    """Rows with the opening position of their window."""
    return (f"{name} AS (SELECT r.*, c.s FROM {rows} r ASOF JOIN {chained} c "
            f"ON r.key = c.key AND r.t >= c.s)")


def openers(name: str, rows: str, chained: str) -> str:
    """Only the rows that open a window."""
    return (f"{name} AS (SELECT * EXCLUDE (o) FROM (SELECT r.*, row_number() OVER (PARTITION BY r.key, c.s "
            f"ORDER BY r.uid) AS o FROM {rows} r JOIN {chained} c ON r.key = c.key AND r.t = c.s) WHERE o = 1)")
