"""Ranked reports, roll-ups and host timelines."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import text
from netsift.operators.common import top
from netsift.session import checkpoint_dir


def confidence_bands(beacons: DataFrame, column: str = "confidence") -> DataFrame:
    """Suspects per confidence band: above 90, 70 to 90, 50 to 70, below 50."""
    c = F.col(column)
    band = F.when(c > 90, "Critical").when(c >= 70, "High").when(c >= 50, "Medium").otherwise("Low")
    return beacons.groupBy(band.alias("band")).agg(F.count("*").alias("suspects"))


def funnel(conn: DataFrame, beacons: DataFrame, keys: list[str], min_connections: int = 10) -> DataFrame:
    """Connections, distinct keys, keys with enough connections, keys flagged."""
    per_key = conn.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"))
    head = per_key.agg(F.sum("n").alias("connections"), F.count("*").alias("keys"),
                       F.count_if(F.col("n") >= min_connections).alias("eligible"))
    flagged = beacons.agg(F.count("*").alias("flagged"))
    merged = head.unionByName(flagged, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in ("connections", "keys", "eligible", "flagged")])


def flagged_per_source(found: DataFrame, source: str, domain: str) -> DataFrame:
    """Distinct flagged names per source."""
    return found.groupBy(source).agg(F.count_distinct(domain).alias("flagged"))


def timeline(parts: list[DataFrame]) -> DataFrame:
    """One time-ordered list per host from several (ts, host, source, text) inputs.

    Range partitioning over host and time spreads a busy host over many tasks.
    """
    merged = reduce(DataFrame.unionByName, parts)
    return merged.repartitionByRange("host", "ts").sortWithinPartitions("host", "ts", "source", "text")


def timeline_part(df: DataFrame, host: str, source: str, body: Column, ts: str = "ts") -> DataFrame:
    return df.where(F.col(host).isNotNull()).select(
        F.col(ts).cast("timestamp").alias("ts"), F.col(host).alias("host"), F.lit(source).alias("source"),
        body.alias("text"))


def beacon_table(beacons: DataFrame, n: int = 20) -> DataFrame:
    """Markdown table rows of the best ``n`` suspects: rank and line."""
    ranked = top(beacons, n, F.desc("confidence"), "src_ip", "dst_ip", "dst_port")
    line = F.format_string("| %d | %s | %s | %s | %d | %.1fs | %.4f | **%.1f%%** |", "rank", "src_ip", "dst_ip",
                           F.col("dst_port").cast("string"), "connection_count", "interval_mean", "cv", "confidence")
    return ranked.select("rank", line.alias("line"))


def beacon_details(beacons: DataFrame, n: int = 10) -> DataFrame:
    """Markdown detail sections of the best ``n`` suspects."""
    ranked = top(beacons, n, F.desc("confidence"), "src_ip", "dst_ip", "dst_port")
    body = F.format_string(
        "### %d. %s → %s:%s\n\n- **Connections:** %d\n- **Average Interval:** %.2f seconds (%.1f minutes)\n"
        "- **Std Deviation:** %.2fs\n- **Coefficient of Variation:** %.4f\n- **Confidence Score:** %.1f%%\n"
        "- **First Seen:** %s\n- **Last Seen:** %s\n",
        "rank", "src_ip", "dst_ip", F.col("dst_port").cast("string"), "connection_count", "interval_mean",
        F.col("interval_mean") / 60, "interval_std", "cv", "confidence", F.col("first_seen").cast("string"),
        F.col("last_seen").cast("string"))
    return ranked.select("rank", body.alias("line"))


def alert_table(alerts: DataFrame) -> DataFrame:
    """Markdown rows of all alerts, most severe first.

    The sorted rows are written to the shared folder once; ranks are the place in a partition plus the rows of the
    partitions before it, so no task sees all alerts.
    """
    from netsift.operators.exfil import by_severity

    spark = alerts.sparkSession
    path = f"{checkpoint_dir(spark)}/netsift-alerts-{uuid.uuid4().hex}"
    by_severity(alerts).select("type", "severity", "src", "detail", F.monotonically_increasing_id().alias("_at")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    begin, before = [], 0
    for part, n in sorted((r[0], r[1]) for r in rows.groupBy("_part").count().collect()):    # one row per partition
        begin.append((part, before))
        before += n
    base = spark.createDataFrame(begin, "_part long, _before long")
    ranked = rows.join(F.broadcast(base), "_part").withColumn(
        "rank", (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).cast("long"))
    dash = lambda c: F.coalesce(F.col(c), F.lit("-"))
    line = F.format_string("| %d | %s | %s | %s | %s |", "rank", dash("type"), dash("severity"), dash("src"), dash("detail"))
    return ranked.select("rank", line.alias("line"))


def domain_table(suspects: DataFrame, n: int = 30) -> DataFrame:
    """The best ``n`` generated-domain suspects."""
    return top(suspects, n, F.desc("dga_probability"), "domain")


def decoded_labels(dns: DataFrame, min_chars: int = 20) -> DataFrame:
    """Base64-looking first labels with their decoded text."""
    return dns.withColumn("decoded", text.decode_base64_label("query", min_chars)).where("decoded IS NOT NULL")
