"""All exfiltration reports in one alerts table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.operators import dns as dns_ops
from netsift.operators import http as http_ops
from netsift.operators import volume as volume_ops

SEVERITY_RANK = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}


def all_alerts(conn: DataFrame, dns: DataFrame, http: DataFrame, threshold_mb: float = 100.0,
               post_threshold: int = 5_242_880, nxdomain_ratio: float = 0.7, label_length: int = 40,
               queries_per_minute: int = 100, min_queries: int = 20, mode: str = "prefix") -> DataFrame:
    """Union of the volume, DNS and HTTP reports; columns a report lacks are null."""
    parts = [
        volume_ops.volume_exfil(conn, threshold_mb, mode),
        dns_ops.nxdomain_ratio(dns, nxdomain_ratio, min_queries),
        dns_ops.long_labels(dns, label_length),
        dns_ops.high_entropy(dns),
        dns_ops.query_rate(dns, queries_per_minute),
        http_ops.large_uploads(http, post_threshold, mode),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def by_severity(alerts: DataFrame) -> DataFrame:
    """Most severe first."""
    rank = F.create_map(*[F.lit(v) for kv in SEVERITY_RANK.items() for v in kv])
    return alerts.orderBy(F.coalesce(rank[F.col("severity")], F.lit(9)), "type", "src", "detail")
