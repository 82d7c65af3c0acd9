"""Row filters over logs and alert events; every one is a plain predicate the scan can push down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# column names of the two log namings the filters accept
RAW = {"src": "id_orig_h", "dst": "id_resp_h", "proto": "proto", "ts": "ts", "bytes": "orig_bytes",
       "sport": "id_orig_p", "dport": "id_resp_p"}
COMMON = {"src": "source.ip", "dst": "destination.ip", "proto": "network.transport", "ts": "`@timestamp`",
          "bytes": "source.bytes", "sport": "source.port", "dport": "destination.port"}


def by_src(df: DataFrame, ip: str, names: dict = RAW) -> DataFrame:
    return df.where(F.col(names["src"]) == ip)


def by_dst(df: DataFrame, ip: str, names: dict = RAW) -> DataFrame:
    return df.where(F.col(names["dst"]) == ip)


def by_proto(df: DataFrame, proto: str, names: dict = RAW) -> DataFrame:
    return df.where(F.lower(names["proto"]) == proto.lower())


def by_timeframe(df: DataFrame, start: str, end: str, names: dict = RAW) -> DataFrame:
    """Both ends included."""
    return df.where(F.col(names["ts"]).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def last_hours(df: DataFrame, hours: float, now: str | Column | None = None, names: dict = RAW) -> DataFrame:
    """Rolling look-back from ``now`` (default: the current time)."""
    end = F.current_timestamp() if now is None else (F.lit(now) if isinstance(now, str) else now)
    begin = F.timestamp_micros(F.unix_micros(end.cast("timestamp")) - int(hours * 3_600_000_000))
    return df.where(F.col(names["ts"]) >= begin)


def by_bytes(df: DataFrame, min_bytes: int | None = None, max_bytes: int | None = None,
             names: dict = RAW) -> DataFrame:
    col = F.col(names["bytes"])
    if min_bytes is not None:
        df = df.where(col >= min_bytes)
    if max_bytes is not None:
        df = df.where(col <= max_bytes)
    return df


def by_port(df: DataFrame, port: int, direction: str = "dst", names: dict = RAW) -> DataFrame:
    return df.where(F.col(names["dport" if direction == "dst" else "sport"]) == port)


def required(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def by_event_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("event_type") == kind)


def alerts(df: DataFrame) -> DataFrame:
    return by_event_type(df, "alert")


def dns_events(df: DataFrame) -> DataFrame:
    return by_event_type(df, "dns")


def http_events(df: DataFrame) -> DataFrame:
    return by_event_type(df, "http")


def tls_events(df: DataFrame) -> DataFrame:
    return by_event_type(df, "tls")


def flow_events(df: DataFrame) -> DataFrame:
    return by_event_type(df, "flow")


def _matches(col: str, pattern: str, case_sensitive: bool) -> Column:
    return F.coalesce(F.col(col).rlike(pattern if case_sensitive else f"(?i){pattern}"), F.lit(False))


def by_signature(df: DataFrame, pattern: str, case_sensitive: bool = False) -> DataFrame:
    return df.where(_matches("alert.signature", pattern, case_sensitive))


def by_category(df: DataFrame, pattern: str, case_sensitive: bool = False) -> DataFrame:
    return df.where(_matches("alert.category", pattern, case_sensitive))


def by_severity(df: DataFrame, max_severity: int = 1, min_severity: int = 1) -> DataFrame:
    return df.where(F.col("alert.severity").between(min_severity, max_severity))


def by_sid(df: DataFrame, sid: int) -> DataFrame:
    return df.where(F.col("alert.signature_id") == sid)


def by_src_ip(df: DataFrame, ip: str) -> DataFrame:
    return df.where(F.col("src_ip") == ip)


def by_dst_ip(df: DataFrame, ip: str) -> DataFrame:
    return df.where(F.col("dest_ip") == ip)
