"""TLS detectors and certificate hunts; all are row filters over the ssl log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.constants import (
    HUNT_JA3,
    MALICIOUS_JA3,
    MALWARE_CERT_NAMES,
    SUSPICIOUS_TLS_PORTS,
    TRUSTED_ISSUERS,
)
from netsift.functions.net import is_local
from netsift.functions.text import cert_common_name
from netsift.operators.common import dashed, findings


def _between(text: str):
    return F.format_string(text, "id_orig_h", "id_resp_h")


def malicious_ja3(ssl: DataFrame, hashes: list[str] = MALICIOUS_JA3, keep: list[str] = ()) -> DataFrame:
    return findings(ssl.where(F.col("ja3").isin(hashes)), "C2_JA3_Suspicious",
                    _between("Malicious JA3 matched: %s -> %s"), dashed(F.lit("c2-ja3"), "id_orig_h", "ja3"),
                    "JA3_MATCH", keep=["ja3", *keep])


def self_signed(ssl: DataFrame, malware_names: list[str] = MALWARE_CERT_NAMES, keep: list[str] = ()) -> DataFrame:
    """Subject equals issuer; ``known_malware`` tells certificates whose CN remainder is listed."""
    known = F.coalesce(cert_common_name("subject").isin(malware_names), F.lit(False))
    hits = ssl.where(F.col("subject") == F.col("issuer")).withColumn("known_malware", known)
    kind = F.when(F.col("known_malware"), "c2-cert").otherwise("c2-selfsign")
    return findings(hits, "C2_SSL_SelfSigned",
                    F.format_string("Self-signed cert: %s -> %s CN=%s", "id_orig_h", "id_resp_h", "subject"),
                    dashed(kind, "id_orig_h", "id_resp_h"), "SELF_SIGNED", keep=["subject", "known_malware", *keep])


def suspicious_ports(ssl: DataFrame, ports: list[int] = SUSPICIOUS_TLS_PORTS, keep: list[str] = ()) -> DataFrame:
    return findings(ssl.where(F.col("id_resp_p").isin(ports)), "C2_Non_Standard_Port_TLS",
                    F.format_string("TLS on suspicious port %d: %s -> %s", "id_resp_p", "id_orig_h", "id_resp_h"),
                    dashed(F.lit("c2-port"), "id_orig_h", "id_resp_h", "id_resp_p"), "NONSTANDARD_TLS_PORT",
                    keep=["id_resp_p", *keep])


def expired(ssl: DataFrame, keep: list[str] = ()) -> DataFrame:
    return findings(ssl.where(F.col("not_valid_after") < F.col("ts")), "C2_SSL_Expired",
                    _between("Expired cert from %s to %s"), dashed(F.lit("c2-exp"), "id_orig_h", "id_resp_h"),
                    "EXPIRED_CERT", keep=["not_valid_after", *keep])


def missing_server_name(ssl: DataFrame, keep: list[str] = ()) -> DataFrame:
    """TLS to an external address without a server name."""
    hits = ssl.where(F.col("server_name").isNull() & ~is_local("id_resp_h"))
    return findings(hits, "C2_No_PTR_Record", _between("TLS without server name: %s -> %s"),
                    dashed(F.lit("c2-nosni"), "id_orig_h", "id_resp_h"), "NO_SNI", keep=list(keep))


def hunt_no_server_name(ssl: DataFrame) -> DataFrame:
    return ssl.where(F.col("server_name").isNull() & F.col("id_resp_h").isNotNull())


def hunt_untrusted_issuer(ssl: DataFrame, trusted: list[str] = TRUSTED_ISSUERS) -> DataFrame:
    """Certificates with a subject whose issuer does not start with a trusted name."""
    known = F.lit(False)
    for name in trusted:
        known = known | F.startswith("issuer", F.lit(name))
    return ssl.where(F.col("subject").isNotNull() & ~F.coalesce(known, F.lit(False)))


def hunt_ports(ssl: DataFrame, usual: list[int] = (443, 8443)) -> DataFrame:
    return ssl.where(~F.col("id_resp_p").isin(*usual))


def hunt_ja3(ssl: DataFrame, hashes: list[str] = HUNT_JA3) -> DataFrame:
    return ssl.where(F.col("ja3").isin(hashes))


def hunt_validity(ssl: DataFrame, min_days: int = 30, max_days: int = 3 * 365) -> DataFrame:
    """Certificates valid for less than ``min_days`` or more than ``max_days``."""
    days = F.datediff("not_valid_after", "not_valid_before")
    return ssl.withColumn("validity_days", days).where((days < min_days) | (days > max_days))
