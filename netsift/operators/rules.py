"""Signature rules as data (ids, messages, patterns and thresholds are fixed values): each rule is a predicate over one log table plus a rate threshold.

All rules of a table are evaluated in one pass over it; thresholds are counted per rule and
source.  ``limit`` keeps the first ``count`` matches of a window, ``both`` reports
one alert per window once ``count`` matches were seen.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.net import is_local
from netsift.operators.anchored import numbered

col = F.col
SRC, DST, PORT = "id_orig_h", "id_resp_h", "id_resp_p"


@dataclass(frozen=True)
class Rule:
    sid: int
    msg: str
    table: str
    predicate: Callable[[], Column]
    threshold: tuple[str, int, int] | None = None     # (limit | both, count, seconds)
    classtype: str = "trojan-activity"
    mitre: str | None = None
    needs: tuple[str, ...] = ()                        # optional payload columns it reads


# locality of both ends, computed once per row by ``matches``
SRC_HOME, DST_HOME = "_src_home", "_dst_home"


def home_out() -> Column:
    return col(SRC_HOME) & ~col(DST_HOME)


def home_in() -> Column:
    return ~col(SRC_HOME) & col(DST_HOME)


def inside() -> Column:
    return col(SRC_HOME) & col(DST_HOME)


def home() -> Column:
    return col(SRC_HOME)


def has(name: str, text: str) -> Column:
    return F.contains(col(name), F.lit(text))


def has_bytes(name: str, hexa: str) -> Column:
    return F.contains(col(name).cast("binary"), F.unhex(F.lit(hexa)))


def ja3_is(value: str) -> Callable[[], Column]:
    return lambda: home_out() & (col("ja3") == value)


def dns_home() -> Column:
    return home() & (col(PORT) == 53)


def tcp(direction: Column, port: int) -> Column:
    return direction & (col("proto") == "tcp") & (col(PORT) == port)


def smb_445() -> Column:
    return inside() & (col(PORT) == 445)


def syn_only() -> Column:
    return F.startswith("history", F.lit("S"))


def echo() -> Column:
    return (col("proto") == "icmp") & (col("id_orig_p") == 8)


def posted() -> Column:
    return home_out() & (col("method") == "POST")


def put() -> Column:
    return home_out() & (col("method") == "PUT")


def answered_in() -> Column:
    return home_in() & (col("status_code") == 200)


LISTED_IPS = ["45.33.32.156", "185.220.101.45", "91.92.241.103"]

C2_RULES = [
    Rule(9000001, "C2 COBALT STRIKE Default HTTP Beacon jQuery Profile", "http",
         lambda: home_out() & (col("method") == "GET") & F.startswith("uri", F.lit("/jquery-"))
         & F.endswith("uri", F.lit(".min.js")) & has("user_agent", "Mozilla/5.0"), ("limit", 1, 300), mitre="T1071.001"),
    Rule(9000002, "C2 COBALT STRIKE TLS JA3 Fingerprint Default", "ssl",
         ja3_is("a0e9f5d64349fb13191bc781f81f42e1"), ("limit", 1, 600), mitre="T1071.001"),
    Rule(9000003, "C2 COBALT STRIKE HTTP POST Check-in", "http",
         lambda: posted() & F.startswith("uri", F.lit("/jquery-")) & ~has("request_body", "<")
         & F.length("request_body").between(32, 256), ("both", 5, 600), mitre="T1071.001", needs=("request_body",)),
    Rule(9000004, "C2 COBALT STRIKE DNS Lookup Pattern", "dns",
         lambda: dns_home() & has("query", ".stage."), ("limit", 1, 300), mitre="T1071.004"),
    Rule(9000005, "C2 COBALT STRIKE x64 Stager Download", "http",
         lambda: answered_in() & has_bytes("file_data", "FC4883E4F0"), mitre="T1059.001", needs=("file_data",)),
    Rule(9000006, "C2 DNS Long Query Possible Tunneling", "dns",
         lambda: dns_home() & has("query", ".") & (F.length("query") > 100), ("both", 10, 60), "policy-violation",
         "T1071.004"),
    Rule(9000007, "C2 BEACON Regular HTTP GET Pattern", "http",
         lambda: home_out() & (col("method") == "GET") & ~has("uri", "/") & F.length("uri").between(9, 29),
         ("both", 10, 600), mitre="T1071.001"),
    Rule(9000008, "C2 TLS Non-Standard Port Suspicious Cert", "ssl",
         lambda: home_out() & (col(PORT) != 443) & has("subject", "CN=") & has("issuer", "CN="), ("limit", 1, 600),
         mitre="T1573.002"),
    Rule(9000009, "C2 ASYNCRAT TLS JA3 Fingerprint", "ssl", ja3_is("de9f2c7fd25e1b3afad3e85a0bd17d9b"),
         ("limit", 1, 600), mitre="T1573.002"),
    Rule(9000010, "C2 SLIVER TLS JA3 Fingerprint", "ssl", ja3_is("4d7a28d6f2263ed61de88ca66eb011e3"),
         ("limit", 1, 600), mitre="T1071.001"),
    Rule(9000011, "C2 SUSPICIOUS Python requests User-Agent", "http",
         lambda: home_out() & F.startswith("user_agent", F.lit("python-requests/")), ("both", 3, 300),
         "policy-violation", "T1071.001"),
    Rule(9000012, "C2 Go-http-client User-Agent Suspicious", "http",
         lambda: home_out() & has("user_agent", "Go-http-client/"), ("both", 5, 300), "policy-violation", "T1071.001"),
]

LATERAL_RULES = [
    Rule(9001001, "LATERAL MOVEMENT SMB Multi-Host Internal Scan", "smb", smb_445, ("both", 5, 180),
         "attempted-recon", "T1021.002"),
    Rule(9001002, "LATERAL MOVEMENT PsExec Service Binary Drop", "smb",
         lambda: smb_445() & has("named_pipe", "PSEXESVC"), mitre="T1569.002"),
    Rule(9001003, "LATERAL MOVEMENT SMB Admin Share Access", "smb", lambda: smb_445() & has("tree", "ADMIN$"),
         ("limit", 1, 300), "policy-violation", "T1021.002"),
    Rule(9001004, "LATERAL MOVEMENT WMI DCOM Remote Execution", "conn",
         lambda: tcp(inside(), 135) & has_bytes("payload", "05000B"), ("both", 3, 180), mitre="T1047",
         needs=("payload",)),
    Rule(9001005, "LATERAL MOVEMENT NTLM Pass-the-Hash Type1 No Username", "conn",
         lambda: tcp(inside(), 445) & (F.substring(col("payload").cast("binary"), 1, 7) == F.lit(b"NTLMSSP"))
         & (F.substring(col("payload").cast("binary"), 16, 4) == F.unhex(F.lit("01000000")))
         & (F.substring(col("payload").cast("binary"), 48, 1) != F.unhex(F.lit("00"))), ("both", 5, 180),
         mitre="T1550.002", needs=("payload",)),
    Rule(9001006, "LATERAL MOVEMENT Remote Service Creation via SCM", "smb",
         lambda: smb_445() & has("named_pipe", "svcctl"), ("limit", 1, 300), mitre="T1569.002"),
    Rule(9001007, "LATERAL MOVEMENT Internal RDP Connection", "conn", lambda: tcp(inside(), 3389), ("both", 3, 600),
         "policy-violation", "T1021.001"),
    Rule(9001008, "LATERAL MOVEMENT RDP Brute Force External", "conn",
         lambda: tcp(home_in(), 3389) & syn_only(), ("both", 10, 300), "attempted-user", "T1110.001"),
    Rule(9001009, "LATERAL MOVEMENT Named Pipe Impersonation Attempt", "smb",
         lambda: smb_445() & has("named_pipe", "\\pipe\\") & has("payload", "ImpersonateNamedPipe"),
         mitre="T1134.001", needs=("payload",)),
]

EXFIL_RULES = [
    Rule(9002001, "EXFIL Large HTTP POST to External Host", "http",
         lambda: posted() & (col("request_body_len") > 5242880), ("limit", 1, 300), "policy-violation", "T1048.003"),
    Rule(9002002, "EXFIL HTTP PUT Upload to External", "http",
         lambda: put() & (col("request_body_len") > 1048576), ("both", 3, 300), "policy-violation", "T1048.003"),
    Rule(9002003, "EXFIL DNS TXT Record Large Content C2 Channel", "dns",
         lambda: (col(PORT) == 53) & has("query", ".") & (col("qtype_name") == "TXT") & (F.length("query") > 100),
         ("both", 5, 60), mitre="T1071.004"),
    Rule(9002004, "EXFIL DNS Subdomain Tunneling High Query Rate", "dns",
         lambda: dns_home() & has("query", ".") & (F.length("query") > 60), ("both", 50, 60), "policy-violation",
         "T1071.004"),
    Rule(9002005, "EXFIL DNS Base64 Subdomain Exfiltration Pattern", "dns",
         lambda: dns_home() & col("query").rlike(r"^[A-Za-z0-9+/]{40,}=*\."), ("both", 3, 60), mitre="T1048"),
    Rule(9002006, "EXFIL ICMP Tunnel Large Payload", "conn",
         lambda: home_out() & echo() & (col("orig_bytes") > 100), ("both", 20, 60), "policy-violation", "T1048"),
    Rule(9002007, "EXFIL FTP STOR Upload to External", "ftp",
         lambda: home_out() & (col(PORT) == 21) & (F.upper("command") == "STOR"), ("limit", 1, 300),
         "policy-violation", "T1048.003"),
    Rule(9002008, "EXFIL Large Upload to Cloud Storage", "http",
         lambda: put() & has("host", "amazonaws.com") & (col("request_body_len") > 52428800), ("limit", 1, 600),
         "policy-violation", "T1567.002"),
]

MALWARE_RULES = [
    Rule(9003001, "MALWARE EMOTET HTTP C2 Check-in Epoch4", "http",
         lambda: posted() & col("uri").rlike("^/[a-zA-Z]{4,8}/[a-zA-Z0-9]{4,8}/") & (col("request_body_len") > 1024),
         ("both", 3, 600), mitre="T1071.001"),
    Rule(9003002, "MALWARE EMOTET Spambot SMTP Activity", "smtp",
         lambda: home_out() & (col(PORT) == 25) & (col("command") == "EHLO"), ("both", 20, 300), mitre="T1566"),
    Rule(9003003, "MALWARE TRICKBOT HTTP C2 Image Path Pattern", "http",
         lambda: posted() & col("uri").rlike("/images/[a-zA-Z0-9]{8,16}/"), ("both", 3, 600), mitre="T1071.001"),
    Rule(9003004, "MALWARE ASYNCRAT TLS Certificate CN", "ssl",
         lambda: home_out() & has("subject", "CN=AsyncRAT Server"), mitre="T1573.002"),
    Rule(9003005, "MALWARE ASYNCRAT Default Port 6606", "conn", lambda: tcp(home_out(), 6606), ("limit", 1, 600),
         mitre="T1095"),
    Rule(9003006, "MALWARE ASYNCRAT Secondary Port 7707", "conn", lambda: tcp(home_out(), 7707), ("limit", 1, 600),
         mitre="T1095"),
    Rule(9003007, "MALWARE Possible Reverse Shell Non-Standard Port", "conn",
         lambda: home_out() & (col("proto") == "tcp") & (col(PORT) != 80)
         & F.contains(F.lower(col("payload").cast("string")), F.lit("/bin/sh")), ("limit", 1, 300), mitre="T1059.004",
         needs=("payload",)),
    Rule(9003008, "MALWARE PowerShell Download Cradle", "http",
         lambda: answered_in() & col("file_data").rlike("(?i)IEX") & col("file_data").rlike("(?i)DownloadString"),
         mitre="T1059.001", needs=("file_data",)),
    Rule(9003009, "MALWARE Base64 Encoded PowerShell Download", "http",
         lambda: answered_in() & col("file_data").rlike("(?i)powershell.*-enc[od]* [A-Za-z0-9+/]{100}"),
         mitre="T1059.001", needs=("file_data",)),
    Rule(9003010, "MALWARE Ransomware C2 Check-in Pattern", "http",
         lambda: posted() & has("uri", "/api/") & col("request_body").rlike("[Ii]d=[A-Za-z0-9]{16,}"),
         ("limit", 1, 300), mitre="T1486", needs=("request_body",)),
]

LOCAL_RULES = [
    Rule(9009001, "LOCAL POLICY Domain Controller External Connection", "conn",
         lambda: (col(SRC) == "192.168.1.35") & ~col(DST_HOME), ("limit", 1, 600), "policy-violation"),
    Rule(9009002, "LOCAL IOC Known C2 IP Connection", "conn", lambda: home() & col(DST).isin(LISTED_IPS),
         ("limit", 1, 300), mitre="T1071"),
    Rule(9009003, "LOCAL IOC Known C2 Domain c2ops.net", "dns",
         lambda: dns_home() & F.endswith("query", F.lit("c2ops.net")), ("limit", 1, 300), mitre="T1071.004"),
    Rule(9009004, "LOCAL IOC Known DGA Domain jquery-cdn.net", "dns",
         lambda: dns_home() & F.endswith("query", F.lit("jquery-cdn.net")), ("limit", 1, 300), mitre="T1071.001"),
    Rule(9009005, "LOCAL POLICY Internal SSH Lateral Access", "conn", lambda: tcp(inside(), 22), ("both", 5, 300),
         "policy-violation", "T1021.004"),
    Rule(9009006, "LOCAL POLICY Telnet Usage Detected", "conn", lambda: tcp(home(), 23), None, "policy-violation"),
    Rule(9009007, "LOCAL RECON Internal ICMP Ping Sweep", "conn", lambda: inside() & echo(), ("both", 20, 60),
         "attempted-recon", "T1018"),
    Rule(9009008, "LOCAL RECON Internal Port Scan SYN Sweep", "conn",
         lambda: inside() & (col("proto") == "tcp") & syn_only(), ("both", 50, 60), "attempted-recon", "T1046"),
    Rule(9009010, "LOCAL TEST Integration Test Alert", "http", lambda: home() & has("uri", "/suricata-test-alert"),
         None, "not-suspicious"),
]

ALL_RULES = [*C2_RULES, *LATERAL_RULES, *EXFIL_RULES, *MALWARE_RULES, *LOCAL_RULES]


def _lookup(rules: list[Rule], value: Callable[[Rule], object], kind: str) -> Column:
    """A rule's value by ``sid``; one SQL text, since each Column call is a round trip to the JVM."""
    def literal(v: object) -> str:
        if v is None:
            return "null"
        return str(v) if not isinstance(v, str) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(f"{r.sid}, {literal(value(r))}" for r in rules)
    return F.expr(f"cast(map({pairs}) as map<int, {kind}>)[sid]")


def matches(tables: dict[str, DataFrame], rules: list[Rule] = ALL_RULES, order: list[str] = ("uid",)) -> DataFrame | None:
    """Every (rule, row) match as ``sid, table, ts, src, dst`` plus the ``order`` columns.

    Rules whose table is absent, or lacks a payload column they read, are skipped; None if all are.
    """
    parts = []
    for name, df in tables.items():
        mine = [r for r in rules if r.table == name and set(r.needs) <= set(df.columns)]
        if not mine:
            continue
        # nulls leave after the explode, without a lambda over the array
        hits = F.array(*[F.when(r.predicate(), F.lit(r.sid)) for r in mine])
        located = df.withColumns({SRC_HOME: is_local(SRC), DST_HOME: is_local(DST)})
        parts.append(located.select(F.explode(hits).alias("sid"), F.lit(name).alias("table"), "ts", col(SRC).alias("src"),
                               col(DST).alias("dst"), *order).where("sid IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def alerts(tables: dict[str, DataFrame], rules: list[Rule] = ALL_RULES, order: list[str] = ("uid",),
           anchor: str = "first_event") -> DataFrame:
    """Rule matches after their thresholds, with message, class and technique."""
    order = list(order)
    # two passes, each over the tables its own rules read, instead of one result scanned twice
    free = matches(tables, [r for r in rules if not r.threshold], order)
    limited = [r for r in rules if r.threshold]
    counted = matches(tables, limited, order)
    parts = [] if free is None else [free]
    if counted is not None:
        seconds = _lookup(limited, lambda r: r.threshold[2], "long")
        count = _lookup(limited, lambda r: r.threshold[1], "int")
        kind = _lookup(limited, lambda r: r.threshold[0], "string")
        passed = F.when(kind == "limit", col("n") <= count).otherwise(col("n") == count)
        most = max(r.threshold[1] for r in limited)
        kept = numbered(counted, ["sid", "src"], "ts", seconds, ["table", *order], anchor, at_most=most)
        parts.append(kept.where(passed).drop("win_start", "n"))
    if not parts:
        raise ValueError("no rule applies to the given tables")
    return described(reduce(DataFrame.unionByName, parts), rules, order)


def described(hits: DataFrame, rules: list[Rule], order: list[str]) -> DataFrame:
    """Matches with the message, class and technique of their rules."""
    return hits.select(
        "sid", "table", "ts", "src", "dst", *order, _lookup(rules, lambda r: r.msg, "string").alias("msg"),
        _lookup(rules, lambda r: r.classtype, "string").alias("classtype"),
        _lookup(rules, lambda r: r.mitre, "string").alias("mitre_id"))
