"""Logs derived from events and documents in which every signature rule has rows that match and rows that just miss.

Each table is one list of expressions that both engines read.  ``x`` picks the shape of a row, its event type the direction
(outward, inward for ``signup``, inside for ``purchase``), documents fill the payloads.  Payloads are bytes, written in hexadecimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.plans import bind

HASH = "md5(coalesce(text, ''))"
TEXT_HEX = "hex(coalesce(text, ''))"
INWARD, INSIDE = "event_type = 'signup'", "event_type = 'purchase'"
AWAY = "'203.0.113.' || k"
NEAR = "'10.0.0.' || k % 7"


def _hexed(text: str) -> str:
    return text.encode().hex().upper()


def _by_x(n: int, otherwise: str, shapes: dict[int, str]) -> str:
    cases = " ".join(f"WHEN {x} THEN {e}" for x, e in shapes.items())
    return f"CASE event_id % {n} {cases} ELSE {otherwise} END" if shapes else otherwise


def _ends(port: str, near: str = INSIDE) -> dict[str, str]:
    return {"uid": "event_id", "id_orig_h": f"CASE WHEN {INWARD} THEN {AWAY} ELSE src END", "id_orig_p": "40000 + k",
            "id_resp_h": f"CASE WHEN {INWARD} THEN src WHEN {near} THEN {NEAR} ELSE {AWAY} END", "id_resp_p": port}


ENCODED = f"'powershell -' || CASE k % 3 WHEN 0 THEN 'enc ' WHEN 1 THEN 'ENCOD ' ELSE 'exec ' END || {HASH} || {HASH} || {HASH} || {HASH}"
CRADLE = "CASE WHEN k % 3 = 0 THEN 'iex' ELSE 'IEX' END || ' (New-Object Net.WebClient).' || CASE WHEN k % 4 = 0 THEN 'Open' ELSE 'downloadstring' END"
NTLM = f"{_hexed('NTLMSSP')}{'00' * 8}"          # its message type follows, then 28 bytes and the length of the name
TABLES: dict[str, dict[str, str]] = {
    "http": {
        **_ends("80"),
        "method": _by_x(16, "'POST'", {0: "'GET'", 2: "'GET'", 3: "'GET'", 4: "'GET'", 6: "'PUT'", 7: "'PUT'", 10: "'GET'", 11: "'GET'",
                                       13: "'HEAD'", 14: "'GET'", 15: "'GET'"}),
        "uri": _by_x(16, "'/'", {0: "'/jquery-3.' || k || CASE WHEN k % 4 = 0 THEN '.js' ELSE '.min.js' END", 1: "'/jquery-3.' || k",
                                 8: "'/' || CASE WHEN k % 5 = 0 THEN 'abc' ELSE 'wxYZ' END || '/a1b2c' || k || '/'",
                                 9: "'/images/' || CASE WHEN k % 5 = 0 THEN 'short' ELSE substr(md5('' || k), 1, 12) END || '/'",
                                 12: "'/api/' || k", 13: "'/suricata-test-alert?n=' || k", 15: "'update' || k || CASE WHEN k % 3 = 0 THEN '/' ELSE '.php' END"}),
        "host": _by_x(16, "'h' || k || '.example.com'", {7: "'b' || k || '.s3.amazonaws.com'"}),
        "user_agent": _by_x(16, "'Mozilla/5.0 (X11)'", {3: "'python-requests/2.' || k", 4: "'Go-http-client/1.1'", 14: "'x python-requests/2'"}),
        "request_body_len": _by_x(16, "k", {5: "5242880 + k % 3", 6: "1048576 + k % 3", 7: "52428800 + k % 3", 8: "1024 + k % 3"}),
        "status_code": "CASE WHEN k % 7 = 0 THEN 404 ELSE 200 END",
        "request_body": _by_x(16, "coalesce(text, '')", {
            1: f"CASE k % 4 WHEN 0 THEN '<' || {HASH} WHEN 1 THEN substr({HASH}, 1, 31) WHEN 2 THEN {HASH} ELSE repeat({HASH}, 8) || coalesce(text, '') END",
            12: f"CASE k % 3 WHEN 0 THEN 'Id=' WHEN 1 THEN 'id=' ELSE 'ID=' END || substr({HASH}, 1, 10 + k % 12)"}),
        "file_hex": _by_x(16, TEXT_HEX, {
            2: f"{TEXT_HEX} || CASE WHEN k % 3 = 0 THEN '0F' || 'C4883E4F0A' ELSE 'FC4883E4F0' END",
            10: f"hex({CRADLE}) || {TEXT_HEX}", 11: f"hex({ENCODED}) || {TEXT_HEX}"}),
    },
    "ssl": {
        **_ends(_by_x(6, "443", {4: "CASE WHEN k % 3 = 0 THEN 443 ELSE 8443 END"})),
        "ja3": _by_x(6, "md5('' || k)", {0: "'a0e9f5d64349fb13191bc781f81f42e1'", 1: "'de9f2c7fd25e1b3afad3e85a0bd17d9b'",
                                         2: "'4d7a28d6f2263ed61de88ca66eb011e3'"}),
        "subject": _by_x(6, "'CN=h' || k", {3: "'CN=AsyncRAT Server' || CASE WHEN k % 2 = 0 THEN ',O=x' ELSE '' END", 5: "'O=h' || k"}),
        "issuer": "CASE WHEN k % 5 = 0 THEN 'O=x' ELSE 'CN=x' END",
    },
    "dns": {
        **_ends("CASE WHEN k % 9 = 0 THEN 5353 ELSE 53 END"),
        "query": _by_x(8, "'w' || k || '.example.com'", {
            0: "'a' || k || '.stage.example.com'", 1: f"{HASH} || {HASH} || {HASH} || CASE WHEN k % 3 = 0 THEN '.org' ELSE '.example.com' END",
            2: f"{HASH} || '.' || {HASH} || '.' || {HASH} || '.example.com'",
            3: f"{HASH} || {HASH} || '.x.org'", 4: f"{HASH} || 'AB+/CD' || CASE WHEN k % 3 = 0 THEN '' ELSE 'ef' END || '==.x.org'",
            5: "'n' || k || '.c2ops.net'", 6: "CASE WHEN k % 3 = 0 THEN 'jquery-cdn.net.org' ELSE 'cdn.jquery-cdn.net' END"}),
        "qtype_name": "CASE WHEN k % 2 = 0 THEN 'TXT' ELSE 'A' END",
    },
    "conn": {
        **_ends(_by_x(14, "80", {0: "135", 1: "445", 2: "3389", 4: "6606", 5: "7707", 6: "CASE WHEN k % 3 = 0 THEN 80 ELSE 4444 END",
                                 9: "22", 10: "23", 13: "3389"}),
                f"({INSIDE} OR event_id % 14 IN (0, 1, 9, 11, 12, 13))"),
        "id_orig_p": _by_x(14, "40000 + k", {3: "CASE WHEN k % 4 = 0 THEN 0 ELSE 8 END", 11: "8"}),
        "id_orig_h": _by_x(14, f"CASE WHEN {INWARD} THEN {AWAY} ELSE src END", {7: "'192.168.1.35'"}),
        "proto": _by_x(14, "'tcp'", {3: "'icmp'", 8: "'udp'", 11: "'icmp'"}),
        "orig_bytes": "50 * (k % 5)",
        "history": _by_x(14, "'ShAD'", {2: "CASE WHEN k % 3 = 0 THEN 'ShA' ELSE 'D' END", 12: "CASE WHEN k % 3 = 0 THEN 'hA' ELSE 'S' END"}),
        "payload_hex": _by_x(14, TEXT_HEX, {
            0: f"CASE WHEN k % 3 = 0 THEN '50' || '00B0' ELSE '05000B' END || {TEXT_HEX}",
            1: f"CASE WHEN k % 5 = 0 THEN '00' ELSE '' END || '{NTLM}' || CASE WHEN k % 4 = 0 THEN '03000000' ELSE '01000000' END || '{'00' * 28}' "
               f"|| CASE WHEN k % 3 = 0 THEN '00' ELSE '18' END || {TEXT_HEX}",
            6: f"{TEXT_HEX} || CASE WHEN k % 2 = 0 THEN '{_hexed('/bin/SH -i')}' ELSE '{_hexed('/bin/bash')}' END"}),
    } | {"id_resp_h": _by_x(14, f"CASE WHEN {INWARD} THEN src WHEN ({INSIDE} OR event_id % 14 IN (0, 1, 9, 11, 12, 13)) THEN {NEAR} ELSE {AWAY} END", {
        8: "CASE k % 4 WHEN 0 THEN '45.33.32.156' WHEN 1 THEN '185.220.101.45' WHEN 2 THEN '91.92.241.103' ELSE '91.92.241.104' END"})},
    "smb": {
        **_ends("CASE WHEN k % 8 = 0 THEN 139 ELSE 445 END", f"({INSIDE} OR {INWARD} OR k % 2 = 0)"),
        "named_pipe": _by_x(5, "'lsarpc'", {0: "'PSEXESVC-' || k", 1: "'svcctl'", 2: "'\\\\pipe\\\\p' || k"}),
        "tree": _by_x(5, "'IPC$'", {3: "'h' || k || '-ADMIN$'"}),
        "payload_hex": f"{TEXT_HEX} || CASE WHEN k % 3 = 0 THEN '{_hexed('ImpersonatePipe')}' ELSE '{_hexed('ImpersonateNamedPipeClient')}' END",
    },
    "ftp": {**_ends("CASE WHEN k % 5 = 0 THEN 2121 ELSE 21 END"), "command": "CASE k % 3 WHEN 0 THEN 'STOR' WHEN 1 THEN 'stor' ELSE 'RETR' END"},
    "smtp": {**_ends("CASE WHEN k % 5 = 0 THEN 587 ELSE 25 END"), "command": "CASE k % 3 WHEN 0 THEN 'EHLO' WHEN 1 THEN 'ehlo' ELSE 'MAIL' END"},
}
BYTES = {"file_hex": "file_data", "payload_hex": "payload"}

for _name, _columns in TABLES.items():
    # a lone backslash in an engine without escapes in its literals
    _list = ", ".join(f"{e} AS {c}" for c, e in _columns.items()).replace("\\\\", "\\")
    bind.VIEWS[f"probe_{_name}"] = f"SELECT ts, t, {_list} FROM ev LEFT JOIN documents ON doc_id = event_id"
    bind.NEEDS[f"probe_{_name}"] = ["ev"]
VIEWS = [f"probe_{n}" for n in TABLES]


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All probe tables; ``tab`` names the table."""
    rows = bind.events(spark, sf).join(bind.table(spark, sf, "documents").select(F.col("doc_id").alias("event_id"), "text"), "event_id", "left")
    found = {}
    for name, columns in TABLES.items():
        df = rows.select("ts", F.lit(name).alias("tab"), *[F.expr(e).alias(c) for c, e in columns.items()])
        found[name] = df.withColumns({data: F.unhex(h).cast("string") for h, data in BYTES.items() if h in columns}).drop(*BYTES)
    return found
