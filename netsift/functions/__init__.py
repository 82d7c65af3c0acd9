"""Column-returning functions."""

from pyspark.sql import SparkSession

from netsift.functions import net, text, time

__all__ = ["net", "text", "time", "register_sql_functions"]

# SQL bodies of the functions most used in ad-hoc queries; plain Spark SQL expressions, no Python.
_SQL = {
    "first_label(q STRING) RETURNS STRING": "substring_index(q, '.', 1)",
    "base_domain(q STRING) RETURNS STRING": "CASE WHEN size(split(q, '[.]')) >= 2 THEN substring_index(q, '.', -2) ELSE q END",
    "megabytes(b BIGINT) RETURNS DOUBLE": "b / 1048576.0D",
    "base64_like(s STRING) RETURNS BOOLEAN": "s RLIKE '^[A-Za-z0-9+/]{20,}={0,2}$'",
    "entropy(s STRING) RETURNS DOUBLE": (
        "CASE WHEN length(s) > 0 THEN aggregate(array_distinct(split(s, '')), 0.0D, (a, c) -> a - "
        "(length(s) - length(replace(s, c, ''))) / length(s) * "
        "log2((length(s) - length(replace(s, c, ''))) / length(s))) WHEN s IS NOT NULL THEN 0.0D END"),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create temporary SQL functions so the measures can be used from ``spark.sql``."""
    for signature, body in _SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
