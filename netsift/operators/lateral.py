"""Movement inside the network: SMB, RDP and DCOM detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.constants import RANSOMWARE_EXTENSIONS, SUSPICIOUS_EXTENSIONS
from netsift.functions.net import is_local
from netsift.functions.text import extension
from netsift.operators.anchored import numbered, throttle, time_windows
from netsift.operators.common import dashed, findings

SRC, DST = "id_orig_h", "id_resp_h"


def _internal(df: DataFrame) -> DataFrame:
    return df.where(is_local(SRC) & is_local(DST))


def _between(text: str, *more: str):
    return F.format_string(text, SRC, DST, *more)


# --- running checks ----------------------------------------------------------

def smb_scan(conn: DataFrame, min_hosts: int = 5, window_seconds: int = 180, quiet_seconds: int = 600,
             order: list[str] = (), anchor: str = "first_event") -> DataFrame:
    """A source reaching ``min_hosts`` internal hosts on 445/139 within the window.

    A host counts when first met in the window; a source alerts once per ``quiet_seconds``.  First meetings are
    minima per (source, window, host) and the window's rows are compared with the meeting that fills the number: no
    task holds a whole window.
    """
    order = list(order)
    live = _internal(conn).where(F.col("id_resp_p").isin(445, 139)).select(SRC, DST, "ts", *order)
    seen = time_windows(live, [SRC], "ts", window_seconds, order, anchor).withColumn("at", F.struct("ts", *order))
    # where each host is first met; of them the one that fills the number, found by a partial top-k
    firsts = seen.groupBy(SRC, "win_start", DST).agg(F.min("at").alias("met"))
    rank = F.row_number().over(Window.partitionBy(SRC, "win_start").orderBy("met"))
    full = firsts.withColumn("r", rank).where(F.col("r") <= min_hosts).where(F.col("r") == min_hosts).select(
        SRC, "win_start", F.col("met").alias("full"))
    over = seen.join(full, [SRC, "win_start"]).where("at >= full").drop("full").withColumnRenamed("win_start", "opened")
    alerts = throttle(over, [SRC], "ts", quiet_seconds, order)
    met = firsts.select(SRC, F.col("win_start").alias("opened"), "met")
    hits = (alerts.join(met, [SRC, "opened"]).where("met <= at").groupBy(SRC, DST, "ts", *order, "opened")
            .agg(F.count("*").alias("host_count")))
    return findings(hits, "LM_SMB_Multi_Host_Scan", F.format_string("%s scanned %d SMB hosts", SRC, "host_count"),
                    dashed(F.lit("lm-smb-scan"), SRC), "SMB_MULTI_HOST_SCAN", "T1021.002",
                    keep=["host_count", *order])


def distinct_hosts(conn: DataFrame, bucket_seconds: int = 180, min_hosts: int = 5, approximate: bool = False) -> DataFrame:
    """Calendar form: distinct internal SMB hosts per source and bucket."""
    count = F.approx_count_distinct(DST, 0.01) if approximate else F.count_distinct(DST)
    return (_internal(conn).where(F.col("id_resp_p").isin(445, 139))
            .groupBy(F.col(SRC).alias("src"), F.window("ts", f"{bucket_seconds} seconds").alias("w"))
            .agg(count.alias("host_count")).where(F.col("host_count") >= min_hosts)
            .select("src", F.col("w.start").alias("start"), "host_count"))


def dcom_exec(conn: DataFrame, threshold: int = 3, window_seconds: int = 180, order: list[str] = (),
              anchor: str = "first_event") -> DataFrame:
    """Every ``threshold``-th internal connection of a source to port 135 within the window."""
    live = _internal(conn).where(F.col("id_resp_p") == 135).select(SRC, DST, "ts", *order)
    hits = numbered(live, [SRC], "ts", window_seconds, list(order), anchor).where(F.col("n") % threshold == 0)
    return findings(hits, "LM_WMI_Remote_Exec", _between("WMI/DCOM from %s to %s"), dashed(F.lit("lm-wmi"), SRC, DST),
                    "WMI_REMOTE_EXEC", "T1047", keep=list(order))


def auth_spray(conn: DataFrame, threshold: int = 5, window_seconds: int = 180, quiet_seconds: int = 600,
               order: list[str] = (), anchor: str = "first_event") -> DataFrame:
    """More than ``threshold`` SMB sign-on attempts of a source within the window."""
    order = list(order)
    live = _internal(conn).where(F.col("id_resp_p") == 445).select(SRC, DST, "ts", *order)
    over = numbered(live, [SRC], "ts", window_seconds, order, anchor).where(F.col("n") > threshold)
    hits = throttle(over.withColumn("attempts", F.col("n")), [SRC], "ts", quiet_seconds, order)
    return findings(hits, "LM_Auth_Spray", F.format_string("%s made %d SMB sign-on attempts", SRC, "attempts"),
                    dashed(F.lit("lm-spray"), SRC), "AUTH_SPRAY", "T1110.003", keep=["attempts", *order])


def rdp_brute_force(conn: DataFrame, threshold: int = 10, window_seconds: int = 300, quiet_seconds: int = 600,
                    max_duration: float = 5.0, max_bytes: int = 1024, order: list[str] = (),
                    anchor: str = "first_event") -> DataFrame:
    """Short, small sessions to a local 3389; one alert per source and ``quiet_seconds``."""
    order = list(order)
    live = conn.where((F.col("id_resp_p") == 3389) & is_local(DST) & (F.col("duration") < max_duration)
                      & (F.col("orig_bytes") < max_bytes)).select(SRC, DST, "ts", *order)
    over = numbered(live, [SRC, DST], "ts", window_seconds, order, anchor).where(F.col("n") >= threshold)
    hits = throttle(over.withColumn("attempts", F.col("n")), [SRC], "ts", quiet_seconds, order)
    return findings(hits, "RDP_Brute_Force", _between("RDP brute force from %s to %s: %d attempts", "attempts"),
                    dashed(F.lit("rdp-brute"), SRC, DST), "BRUTE_FORCE", "T1110.001", keep=["attempts", *order])


def smb_write_rate(smb: DataFrame, threshold: int = 100, window_seconds: int = 60, order: list[str] = (),
                   anchor: str = "first_event") -> DataFrame:
    """Every ``threshold``-th write of a pair within the window."""
    live = smb.where(F.col("action") == "write").select(SRC, DST, "ts", *order)
    hits = numbered(live, [SRC, DST], "ts", window_seconds, list(order), anchor).where(F.col("n") % threshold == 0)
    return findings(hits.withColumn("writes", F.lit(threshold)), "SMB_High_Write_Rate",
                    F.format_string("High SMB write rate: %d writes/min from %s to %s", "writes", SRC, DST),
                    dashed(F.lit("smb-writes"), SRC, DST), "HIGH_WRITE_RATE", "T1486", keep=["writes", *order])


# --- row filters -------------------------------------------------------------

def internal_rdp(conn: DataFrame, keep: list[str] = ()) -> DataFrame:
    hits = _internal(conn).where(F.col("id_resp_p") == 3389)
    return findings(hits, "LM_RDP_Multi_Hop", _between("Internal RDP from %s to %s"), dashed(F.lit("lm-rdp"), SRC, DST),
                    "RDP_INTERNAL_CONNECTION", "T1021.001", keep=list(keep))


def admin_share(smb: DataFrame, keep: list[str] = ()) -> DataFrame:
    hits = smb.where(is_local(SRC) & F.col("name").rlike(r"ADMIN\$|C\$\\|IPC\$"))
    return findings(hits, "LM_Admin_Share_Access", _between("Admin share from %s to %s: %s", "name"),
                    dashed(F.lit("lm-share"), SRC, DST, "name"), "ADMIN_SHARE_ACCESS", "T1021.002",
                    keep=["name", *keep])


def admin_share_write(smb: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Create requests under a full ``\\\\host\\ADMIN$`` or ``C$`` path."""
    hits = smb.where((F.col("action") == "create") & F.col("name").rlike(r"\\\\[^\\]+\\(ADMIN|C)\$"))
    return findings(hits, "SMB_Admin_Share_Access",
                    F.format_string("Write to admin share: %s -> %s: %s", SRC, DST, "name"),
                    dashed(F.lit("smb-admin"), SRC, DST, "name"), "ADMIN_SHARE_WRITE", "T1021.002",
                    keep=["name", *keep])


def psexec(smb: DataFrame, keep: list[str] = ()) -> DataFrame:
    hits = smb.where(is_local(SRC) & F.col("name").rlike("PSEXESVC|psexec"))
    return findings(hits, "LM_PsExec_Detected", F.format_string("PsExec detected: %s from %s to %s", "name", SRC, DST),
                    dashed(F.lit("lm-psexec"), SRC, DST), "PSEXEC_LATERAL_MOVEMENT", "T1569.002",
                    keep=["name", *keep])


def psexec_create(smb: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Create-request form: any source, ``psexec`` in any case."""
    hits = smb.where((F.col("action") == "create") & F.col("name").rlike("PSEXESVC|(?i:psexec)"))
    return findings(hits, "SMB_PsExec_Pattern", _between("PsExec binary via SMB: %s -> %s file=%s", "name"),
                    dashed(F.lit("smb-psexec"), SRC, DST), "PSEXEC_BINARY", "T1569.002", keep=["name", *keep])


def suspicious_files(smb: DataFrame, extensions: list[str] = SUSPICIOUS_EXTENSIONS, keep: list[str] = ()) -> DataFrame:
    hits = smb.where(F.col("action") == "create").withColumn("ext", extension("name")).where(F.col("ext").isin(extensions))
    return findings(hits, "SMB_Suspicious_File",
                    _between("Suspicious file extension via SMB: %s -> %s file=%s", "name"),
                    dashed(F.lit("smb-sus"), SRC, DST, "ext"), "SUSPICIOUS_FILE_WRITE", "T1105",
                    keep=["name", "ext", *keep])


def ransomware_files(smb: DataFrame, extensions: list[str] = RANSOMWARE_EXTENSIONS, keep: list[str] = ()) -> DataFrame:
    hits = smb.where(F.col("action") == "create").withColumn("ext", extension("name")).where(F.col("ext").isin(extensions))
    return findings(hits, "SMB_Ransomware_Extension", _between("Ransomware extension from %s to %s: %s", "name"),
                    dashed(F.lit("smb-ransom"), SRC, DST), "RANSOMWARE_EXTENSION", "T1486",
                    keep=["name", "ext", *keep])


def external_rdp(rdp: DataFrame, keep: list[str] = ()) -> DataFrame:
    hits = rdp.where(~is_local(SRC) & is_local(DST))
    return findings(hits, "RDP_External_Connection", _between("External RDP from %s to %s (cookie=%s)", "cookie"),
                    dashed(F.lit("rdp-ext"), SRC, DST), "EXTERNAL_RDP", "T1021.001", keep=list(keep))


def internal_rdp_cookie(rdp: DataFrame, keep: list[str] = ()) -> DataFrame:
    return findings(_internal(rdp), "RDP_Internal_Lateral", _between("Internal RDP lateral movement from %s to %s"),
                    dashed(F.lit("rdp-lateral"), SRC, DST), "INTERNAL_LATERAL_RDP", "T1021.001", keep=list(keep))


def rdp_odd_port(rdp: DataFrame, ports: list[int] = (3389,), keep: list[str] = ()) -> DataFrame:
    hits = rdp.where(~F.col("id_resp_p").isin(*ports))
    return findings(hits, "RDP_Non_Standard_Port",
                    F.format_string("RDP on non-standard port %d from %s to %s", "id_resp_p", SRC, DST),
                    dashed(F.lit("rdp-port"), SRC, "id_resp_p"), "NON_STANDARD_PORT", "T1021.001",
                    keep=["id_resp_p", *keep])


def rdp_without_nla(rdp: DataFrame, keep: list[str] = ()) -> DataFrame:
    hits = rdp.where(F.col("security_protocol") == 0)
    return findings(hits, "RDP_NLA_Disabled", _between("RDP without NLA from %s to %s"),
                    dashed(F.lit("rdp-nla"), SRC, DST), "NLA_DISABLED", "T1557", keep=list(keep))
