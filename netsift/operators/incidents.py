"""Per-source incidents from sensor notices and signature alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.constants import (
    DEFAULT_NOTICE_WEIGHT,
    DEFAULT_SEVERITY_WEIGHT,
    NOTICE_WEIGHTS,
    SEVERITY_WEIGHTS,
    TECHNIQUES,
)
from netsift.functions.time import floor_to

# --- Fixed values: how the two alert sources are named in incidents ----------
NOTICE_SOURCE, ALERT_SOURCE = "zeek", "suricata"


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(v) for kv in values.items() for v in kv])


def from_notices(notices: DataFrame, seq: str = "seq") -> DataFrame:
    """Sensor notices with weight and technique; a ``Module::`` prefix of the note is ignored."""
    note = F.regexp_replace(F.coalesce("note", F.lit("")), "^[A-Za-z0-9_]+::", "")
    return notices.where(F.col("src").isNotNull() & (F.col("src") != "")).select(
        "src", "ts", F.lit(0).alias("source_rank"), F.col(seq).alias("seq"), F.lit(NOTICE_SOURCE).alias("source"),
        note.alias("type"), F.lit(None).cast("int").alias("severity"), F.coalesce("msg", F.lit("")).alias("msg"),
        F.coalesce(_literal_map(NOTICE_WEIGHTS)[note], F.lit(DEFAULT_NOTICE_WEIGHT)).alias("weight"),
        _literal_map(TECHNIQUES)[note].alias("mitre"))


def from_alerts(events: DataFrame, seq: str = "flow_id", ts: str = "timestamp") -> DataFrame:
    """Alert-engine events of type ``alert``; a missing severity counts as 3."""
    severity = F.coalesce(F.col("alert.severity").cast("int"), F.lit(3))
    return events.where((F.col("event_type") == "alert") & F.col("src_ip").isNotNull() & (F.col("src_ip") != "")).select(
        F.col("src_ip").alias("src"), F.col(ts).cast("timestamp").alias("ts"), F.lit(1).alias("source_rank"),
        F.col(seq).alias("seq"), F.lit(ALERT_SOURCE).alias("source"),
        F.coalesce("alert.signature", F.lit("")).alias("type"), severity.alias("severity"),
        F.lit(None).cast("string").alias("msg"),
        F.coalesce(_literal_map(SEVERITY_WEIGHTS)[severity], F.lit(DEFAULT_SEVERITY_WEIGHT)).alias("weight"),
        F.lit(None).cast("string").alias("mitre"))


def verdict(score: Column, threshold: int) -> Column:
    return (F.when(score >= 80, "CRITICAL").when(score >= threshold, "HIGH").when(score >= 40, "MEDIUM")
            .otherwise("LOW"))


_KIND = ("src", "bucket", "type", "severity")


def kinds(alerts: DataFrame, bucket_seconds: int | None = None) -> DataFrame:
    """Alerts as partial rows of ``merge_kinds``: one kind each, ``bucket`` null without ``bucket_seconds``."""
    bucket = floor_to("ts", bucket_seconds) if bucket_seconds else F.lit(None).cast("timestamp")
    first = F.struct("source_rank", "ts", "seq", "source", "type", "severity", "msg", "weight", "mitre")
    return alerts.select("src", bucket.alias("bucket"), "type", "severity", F.col("weight").cast("long").alias("total"),
                         first.alias("alert"), "mitre")


def merge_kinds(rows: DataFrame) -> DataFrame:
    """Fold alerts, or kinds folded before, to one row per source, bucket, type and severity: score and first alert."""
    order = F.struct("alert.source_rank", "alert.ts", "alert.seq")
    return rows.groupBy(*_KIND).agg(F.sum("total").alias("total"), F.min_by("alert", order).alias("alert"), F.max("mitre").alias("mitre"))


def gather(folded: DataFrame, threshold: int = 70) -> DataFrame:
    """One row per source and bucket from its folded kinds."""
    score = F.least(F.lit(100), F.sum("total"))
    return (folded.groupBy("src", "bucket")
            .agg(score.cast("int").alias("threat_score"), F.count("*").cast("int").alias("alert_count"),
                 F.array_sort(F.collect_list("alert")).alias("alerts"),
                 F.sort_array(F.collect_set("mitre")).alias("mitre_ttps"))
            .withColumn("verdict", verdict(F.col("threat_score"), threshold)))


def score_sources(alerts: DataFrame, threshold: int = 70, bucket_seconds: int | None = None) -> DataFrame:
    """One row per source (and time bucket) with capped score, distinct alerts and verdict.

    Repeats of a (type, severity) add to the score but are listed once, by their first alert.
    They are folded before the per-source gathering, so a source gathers only as
    many entries as there are alert types.
    """
    found = gather(merge_kinds(kinds(alerts, bucket_seconds)), threshold)
    return found if bucket_seconds else found.drop("bucket")


def correlate(notices: DataFrame | None, events: DataFrame | None, threshold: int = 70,
              bucket_seconds: int | None = None, notice_seq: str = "seq", event_seq: str = "flow_id",
              event_ts: str = "timestamp") -> DataFrame:
    """Incidents at or above ``threshold``, highest score first.

    Without ``bucket_seconds`` all alerts of a source form one incident.
    """
    parts = []
    if notices is not None:
        parts.append(from_notices(notices, notice_seq))
    if events is not None:
        parts.append(from_alerts(events, event_seq, event_ts))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    kept = score_sources(both, threshold, bucket_seconds).where(F.col("threat_score") >= threshold)
    return kept.withColumnRenamed("src", "src_ip").orderBy(F.desc("threat_score"), "src_ip")


def payloads(incidents: DataFrame, created: Column | None = None, source: str = "alert-correlation",
             kind: str = "network-correlation") -> DataFrame:
    """Case-system records: title, description with the first ten alerts, severity, tags, observables."""
    at = F.unix_timestamp() if created is None else created
    techniques = F.when(F.size("mitre_ttps") > 0, F.array_join("mitre_ttps", ", ")).otherwise("Unknown")
    lines = F.transform(F.slice("alerts", 1, 10), lambda a: F.format_string(
        "- [%s] %s (weight=%d)", F.upper(a["source"]), a["type"], a["weight"]))
    description = F.format_string(
        "**Source IP:** %s\n**Threat Score:** %d/100\n**Alert Count:** %d\n**MITRE ATT&CK:** %s\n\n"
        "**Alerts Summary:**\n%s", "src_ip", "threat_score", "alert_count", techniques, F.array_join(lines, "\n"))
    return incidents.select(
        F.lit(kind).alias("type"), F.lit(source).alias("source"),
        F.concat_ws("-", F.lit("corr"), "src_ip", at.cast("string")).alias("sourceRef"),
        F.format_string("[%s] Correlated Alerts — %s", "verdict", "src_ip").alias("title"),
        description.alias("description"),
        F.when(F.col("verdict") == "CRITICAL", 1).when(F.col("verdict") == "HIGH", 2).otherwise(3).alias("severity"),
        F.concat(F.array(F.lit(NOTICE_SOURCE), F.lit(ALERT_SOURCE), F.lit("network")), "mitre_ttps").alias("tags"),
        F.array(F.struct(F.lit("ip").alias("dataType"), F.col("src_ip").alias("data"),
                         F.lit("Source IP").alias("message"))).alias("observables"))


def technique_coverage(incidents: DataFrame) -> DataFrame:
    """Incidents per technique id."""
    return (incidents.select(F.explode("mitre_ttps").alias("technique")).groupBy("technique")
            .agg(F.count("*").alias("incidents")))
