"""HTTP detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.constants import SUSPICIOUS_AGENTS
from netsift.functions.net import is_local, outbound
from netsift.functions.text import megabytes
from netsift.operators.common import dashed, findings

FIVE_MB = 5_242_880


def large_uploads(http: DataFrame, threshold_bytes: int = FIVE_MB, mode: str = "prefix",
                  keep: list[str] = ()) -> DataFrame:
    """POST and PUT bodies at or above the threshold sent to an external host."""
    size = F.col("request_body_len")
    hits = http.where(F.col("method").isin("POST", "PUT") & (size >= threshold_bytes) & ~is_local("id_resp_h", mode))
    return hits.select(
        F.lit("HTTP_LARGE_POST").alias("type"), F.lit("HIGH").alias("severity"), F.col("id_orig_h").alias("src"),
        F.col("id_resp_h").alias("dst"), size.alias("bytes"), megabytes("request_body_len", 2).alias("mb"), "uri",
        F.format_string("Large HTTP %s from %s → %s%s (%.1f MB)", "method", "id_orig_h", "id_resp_h",
                        F.coalesce("uri", F.lit("")), megabytes("request_body_len")).alias("detail"), *keep)


def sensor_large_uploads(http: DataFrame, threshold_bytes: int = FIVE_MB, keep: list[str] = ()) -> DataFrame:
    """The same for local-to-external traffic only."""
    hits = http.where(outbound("id_orig_h", "id_resp_h") & F.col("method").isin("POST", "PUT")
                      & (F.col("request_body_len") >= threshold_bytes))
    return findings(hits, "Exfil_HTTP_Large_POST",
                    F.format_string("HTTP %s %.1f MB to %s%s", "method", megabytes("request_body_len"), "id_resp_h",
                                    F.coalesce("uri", F.lit(""))),
                    dashed(F.lit("exfil-post"), "id_orig_h", "id_resp_h"), "HTTP_POST_EXFIL",
                    keep=["method", "request_body_len", *keep])


def suspicious_agents(http: DataFrame, patterns: list[str] = SUSPICIOUS_AGENTS, keep: list[str] = ()) -> DataFrame:
    """User agents matching any pattern, reported once with the first pattern that matches."""
    agent = F.col("user_agent")
    first = F.coalesce(*[F.when(agent.rlike(p), F.lit(p)) for p in patterns])
    hits = http.withColumn("pattern", first).where("pattern IS NOT NULL")
    return findings(hits, "C2_HTTP_Suspicious_UA",
                    F.format_string("Suspicious UA from %s: %s", "id_orig_h", "user_agent"),
                    dashed(F.lit("c2-ua"), "id_orig_h", "user_agent"), "SUSPICIOUS_UA",
                    keep=["user_agent", "pattern", *keep])
