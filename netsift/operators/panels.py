"""Dashboard aggregations over raw logs and alert events; every top-n is a partial aggregate and a top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.constants import SEVERITY_LABELS
from netsift.functions.net import geohash
from netsift.operators.enrich import locate
from netsift.operators.filters import alerts, last_hours


def top_counts(df: DataFrame, column: str | Column, n: int, name: str) -> DataFrame:
    """The ``n`` most frequent values; ties by value."""
    c = F.col(column) if isinstance(column, str) else column
    return (df.where(c.isNotNull()).groupBy(c.alias(name)).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), name).limit(n))


def top_talkers(logs: DataFrame, n: int = 10) -> DataFrame:
    return top_counts(logs, "id_orig_h", n, "source_ip")


def top_signatures(events: DataFrame, n: int = 20) -> DataFrame:
    return top_counts(alerts(events), "alert.signature", n, "signature")


def top_alert_sources(events: DataFrame, n: int = 20) -> DataFrame:
    return top_counts(alerts(events), "src_ip", n, "src_ip")


def top_user_agents(http: DataFrame, n: int = 15) -> DataFrame:
    return top_counts(http, "user_agent", n, "user_agent")


def severity_summary(events: DataFrame) -> DataFrame:
    label = F.create_map(*[F.lit(v) for kv in SEVERITY_LABELS.items() for v in kv])
    return (alerts(events).where("alert.severity IS NOT NULL")
            .groupBy(F.col("alert.severity").alias("severity_int")).agg(F.count("*").alias("count"))
            .withColumn("severity_label", label[F.col("severity_int").cast("int")]).orderBy("severity_int"))


def _bucketed(df: DataFrame, ts: str, interval: str, *group: Column) -> DataFrame:
    return (df.groupBy(F.window(F.col(ts).cast("timestamp"), interval).alias("w"), *group)
            .agg(F.count("*").alias("count")).withColumn("bucket", F.col("w.start")).drop("w"))


def top_over_time(df: DataFrame, value: Column, name: str, ts: str, interval: str, n: int) -> DataFrame:
    """Counts per time bucket of the ``n`` most frequent values."""
    valued = df.where(value.isNotNull()).select(F.col(ts).alias("_ts"), value.alias(name))
    best = top_counts(valued, name, n, name).select(name)
    return _bucketed(valued.join(best, name, "left_semi"), "_ts", interval, F.col(name))


def alerts_by_severity(events: DataFrame, interval: str = "1 hour", n: int = 5, ts: str = "timestamp") -> DataFrame:
    return top_over_time(alerts(events), F.col("alert.severity"), "severity", ts, interval, n)


def alert_categories(events: DataFrame, contains: str = "Trojan", interval: str = "5 minutes", n: int = 5,
                     ts: str = "timestamp") -> DataFrame:
    hits = alerts(events).where(F.contains("alert.category", F.lit(contains)))
    return top_over_time(hits, F.col("alert.category"), "category", ts, interval, n)


def queries_over_time(dns: DataFrame, interval: str = "1 minute") -> DataFrame:
    return _bucketed(dns, "ts", interval)


def top_destinations(conn: DataFrame, n: int = 20) -> DataFrame:
    """Destinations by bytes sent to them."""
    return (conn.groupBy(F.col("id_resp_h").alias("destination_ip")).agg(F.sum("orig_bytes").alias("bytes"))
            .orderBy(F.desc_nulls_last("bytes"), "destination_ip").limit(n))


def destination_grid(logs: DataFrame, ranges: DataFrame, precision: int = 3, dst: str = "id_resp_h") -> DataFrame:
    """Rows per geohash cell of the destination; counted by address first, so each address is located once."""
    per_ip = logs.groupBy(dst).agg(F.count("*").alias("c"))
    cell = geohash("geo_lat", "geo_lon", precision)
    return (locate(per_ip, ranges, dst, "geo").where("geo_lat IS NOT NULL AND geo_lon IS NOT NULL")
            .groupBy(cell.alias("geohash")).agg(F.sum("c").alias("count")))


def alert_total(events: DataFrame, hours: float = 24, now: str | Column | None = None, ts: str = "timestamp") -> DataFrame:
    return last_hours(alerts(events), hours, now, {"ts": ts}).agg(F.count("*").alias("count"))
