"""Rules, incidents, scores, joins, mapping, panels and reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from netsift.functions import net, text
from netsift.operators import dns as dns_ops
from netsift.operators import ecs, enrich, incidents, intervals, panels, reports, rules, score, textmatch
from netsift.operators.anchored import time_windows
from netsift.plans import bind, probes
from netsift.plans.catalog import query
from netsift.plans.queries_intervals import GAPS, PAIR_GAPS
from netsift.plans.queries_traffic import BASE, DAY, DAY_US, LABEL, LABELS, LOCAL
from netsift.plans.shape import chain, placed, plain

HOME = LOCAL.format("id_orig_h")
AWAY = f"NOT {LOCAL.format('id_resp_h')}"
IN = LOCAL.format("id_resp_h")

# sid: (table, condition) of every rule the bound tables can answer
RULE_SQL = {
    9000001: ("http", f"{HOME} AND {AWAY} AND method = 'GET' AND uri LIKE '/jquery-%.min.js' AND user_agent LIKE '%Mozilla/5.0%'"),
    9000002: ("ssl", f"{HOME} AND {AWAY} AND ja3 = 'a0e9f5d64349fb13191bc781f81f42e1'"),
    9000004: ("dns", f"{HOME} AND id_resp_p = 53 AND query LIKE '%.stage.%'"),
    9000006: ("dns", f"{HOME} AND id_resp_p = 53 AND len(query) > 100"),
    9000007: ("http", f"{HOME} AND {AWAY} AND method = 'GET' AND uri NOT LIKE '%/%' AND len(uri) > 8 AND len(uri) < 30"),
    9000008: ("ssl", f"{HOME} AND {AWAY} AND id_resp_p <> 443 AND subject LIKE '%CN=%' AND issuer LIKE '%CN=%'"),
    9000009: ("ssl", f"{HOME} AND {AWAY} AND ja3 = 'de9f2c7fd25e1b3afad3e85a0bd17d9b'"),
    9000010: ("ssl", f"{HOME} AND {AWAY} AND ja3 = '4d7a28d6f2263ed61de88ca66eb011e3'"),
    9000011: ("http", f"{HOME} AND {AWAY} AND user_agent LIKE 'python-requests/%'"),
    9000012: ("http", f"{HOME} AND {AWAY} AND user_agent LIKE '%Go-http-client/%'"),
    9001001: ("smb", f"{HOME} AND {IN} AND id_resp_p = 445"),
    9001002: ("smb", f"{HOME} AND {IN} AND id_resp_p = 445 AND named_pipe LIKE '%PSEXESVC%'"),
    9001003: ("smb", f"{HOME} AND {IN} AND id_resp_p = 445 AND tree LIKE '%ADMIN$%'"),
    9001006: ("smb", f"{HOME} AND {IN} AND id_resp_p = 445 AND named_pipe LIKE '%svcctl%'"),
    9001007: ("conn", f"{HOME} AND {IN} AND proto = 'tcp' AND id_resp_p = 3389"),
    9001008: ("conn", f"NOT {HOME} AND {IN} AND proto = 'tcp' AND id_resp_p = 3389 AND history LIKE 'S%'"),
    9002001: ("http", f"{HOME} AND {AWAY} AND method = 'POST' AND request_body_len > 5242880"),
    9002002: ("http", f"{HOME} AND {AWAY} AND method = 'PUT' AND request_body_len > 1048576"),
    9002003: ("dns", "id_resp_p = 53 AND qtype_name = 'TXT' AND len(query) > 100"),
    9002004: ("dns", f"{HOME} AND id_resp_p = 53 AND len(query) > 60"),
    9002005: ("dns", f"{HOME} AND id_resp_p = 53 AND regexp_matches(query, '^[A-Za-z0-9+/]{{40,}}=*[.]')"),
    9002006: ("conn", f"{HOME} AND {AWAY} AND proto = 'icmp' AND id_orig_p = 8 AND orig_bytes > 100"),
    9002008: ("http", f"{HOME} AND {AWAY} AND method = 'PUT' AND host LIKE '%amazonaws.com%' AND request_body_len > 52428800"),
    9003001: ("http", f"{HOME} AND {AWAY} AND method = 'POST' AND regexp_matches(uri, '^/[a-zA-Z]{{4,8}}/[a-zA-Z0-9]{{4,8}}/') "
                      "AND request_body_len > 1024"),
    9003003: ("http", f"{HOME} AND {AWAY} AND method = 'POST' AND regexp_matches(uri, '/images/[a-zA-Z0-9]{{8,16}}/')"),
    9003004: ("ssl", f"{HOME} AND {AWAY} AND subject LIKE '%CN=AsyncRAT Server%'"),
    9003005: ("conn", f"{HOME} AND {AWAY} AND proto = 'tcp' AND id_resp_p = 6606"),
    9003006: ("conn", f"{HOME} AND {AWAY} AND proto = 'tcp' AND id_resp_p = 7707"),
    9009001: ("conn", f"id_orig_h = '192.168.1.35' AND {AWAY}"),
    9009002: ("conn", f"{HOME} AND id_resp_h IN ('45.33.32.156', '185.220.101.45', '91.92.241.103')"),
    9009003: ("dns", f"{HOME} AND id_resp_p = 53 AND query LIKE '%c2ops.net'"),
    9009004: ("dns", f"{HOME} AND id_resp_p = 53 AND query LIKE '%jquery-cdn.net'"),
    9009005: ("conn", f"{HOME} AND {IN} AND proto = 'tcp' AND id_resp_p = 22"),
    9009006: ("conn", f"{HOME} AND proto = 'tcp' AND id_resp_p = 23"),
    9009007: ("conn", f"{HOME} AND {IN} AND proto = 'icmp' AND id_orig_p = 8"),
    9009008: ("conn", f"{HOME} AND {IN} AND proto = 'tcp' AND history LIKE 'S%'"),
    9009010: ("http", f"{HOME} AND uri LIKE '%/suricata-test-alert%'"),
}
STRETCH = 144        # the synthetic events are sparse: windows are made that much longer
RULE_VIEWS = ["conn", "lan", "dns", "http", "ssl", "smb"]


def _hex_holds(column: str, bytes_: str) -> str:
    return f"regexp_matches({column}, '^(..)*{bytes_}')"


def _hex_word(column: str, word: str) -> str:
    """Bytes hold the word in any case."""
    either = (sorted({c.upper().encode().hex().upper(), c.encode().hex().upper()}) for c in word)
    return _hex_holds(column, "".join(f"({'|'.join(e)})" for e in either))


# the rules that read payload columns or tables that only the probe logs have
PAYLOAD_SQL = {
    9000003: ("http", f"{HOME} AND {AWAY} AND method = 'POST' AND uri LIKE '/jquery-%' AND request_body NOT LIKE '%<%' "
                      "AND len(request_body) > 31 AND len(request_body) < 257"),
    9000005: ("http", f"NOT {HOME} AND {IN} AND status_code = 200 AND {_hex_holds('file_hex', 'FC4883E4F0')}"),
    9001004: ("conn", f"{HOME} AND {IN} AND proto = 'tcp' AND id_resp_p = 135 AND {_hex_holds('payload_hex', '05000B')}"),
    9001005: ("conn", f"{HOME} AND {IN} AND proto = 'tcp' AND id_resp_p = 445 AND substr(payload_hex, 1, 14) = hex('NTLMSSP') "
                      "AND substr(payload_hex, 31, 8) = '01000000' AND substr(payload_hex, 95, 2) <> '00'"),
    9001009: ("smb", f"{HOME} AND {IN} AND id_resp_p = 445 AND contains(named_pipe, '\\pipe\\') "
                     f"AND {_hex_holds('payload_hex', b'ImpersonateNamedPipe'.hex().upper())}"),
    9002007: ("ftp", f"{HOME} AND {AWAY} AND id_resp_p = 21 AND lower(command) = 'stor'"),
    9003002: ("smtp", f"{HOME} AND {AWAY} AND id_resp_p = 25 AND command = 'EHLO'"),
    9003007: ("conn", f"{HOME} AND {AWAY} AND proto = 'tcp' AND id_resp_p <> 80 AND {_hex_word('payload_hex', '/bin/sh')}"),
    9003008: ("http", f"NOT {HOME} AND {IN} AND status_code = 200 AND {_hex_word('file_hex', 'iex')} AND {_hex_word('file_hex', 'downloadstring')}"),
    9003009: ("http", f"NOT {HOME} AND {IN} AND status_code = 200 AND CASE WHEN contains(file_hex, 'FC4883E4F0') THEN false ELSE "
                      "regexp_matches(decode(unhex(file_hex)), '(?i)powershell.*-enc[od]* [A-Za-z0-9+/]{100}') END"),
    9003010: ("http", f"{HOME} AND {AWAY} AND method = 'POST' AND uri LIKE '%/api/%' AND regexp_matches(request_body, '[Ii]d=[A-Za-z0-9]{{16,}}')"),
}


def _probe_hits() -> str:
    """All rules over the probe logs."""
    return _rule_hits(RULE_SQL | PAYLOAD_SQL, "probe_", lan=False)


def _rule_hits(sql: dict = RULE_SQL, prefix: str = "", lan: bool = True) -> str:
    parts = []
    for sid, (table, where) in sql.items():
        sources = ["conn", "lan"] if table == "conn" and lan else [table]
        for source in sources:
            clean = where if source != "lan" else where.replace("id_orig_p", "0")
            parts.append(f"SELECT {sid} AS sid, '{source}' AS tab, t, uid, id_orig_h AS src, id_resp_h AS dst FROM {prefix}{source} "
                         f"WHERE {clean}")
    return "hits AS (" + "\n UNION ALL ".join(parts) + ")"


def _rule_limits(stretch: int) -> str:
    rows = [f"({r.sid}, '{r.threshold[0]}', {r.threshold[1]}, {r.threshold[2] * stretch * 10**6}::BIGINT)"
            for r in rules.ALL_RULES if r.threshold]
    return f"lim(sid, kind, cnt, width) AS (VALUES {', '.join(rows)})"


KEPT = "(kind IS NULL OR (kind = 'limit' AND n <= cnt) OR (kind = 'both' AND n = cnt))"


def _rule_tables(spark, sf):
    conn, lan = bind.conn(spark, sf), bind.lan(spark, sf).withColumn("id_orig_p", F.lit(0))
    cols = ["uid", "ts", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "proto", "orig_bytes", "history"]
    both = conn.select(*cols, F.lit("conn").alias("tab")).unionByName(lan.select(*cols, F.lit("lan").alias("tab")))
    named = {"dns": bind.dns, "http": bind.http, "ssl": bind.ssl, "smb": bind.smb}
    return {"conn": both, **{k: f(spark, sf).withColumn("tab", F.lit(k)) for k, f in named.items()}}


def _stretched():
    return [replace(r, threshold=(*r.threshold[:2], r.threshold[2] * STRETCH)) if r.threshold else r
            for r in rules.ALL_RULES]


@query("rule_matches", f"WITH {_rule_hits()} SELECT sid, tab, src, count(*) AS n FROM hits GROUP BY ALL", RULE_VIEWS)
def rule_matches(spark, sf):
    hits = rules.matches(_rule_tables(spark, sf), order=["uid", "tab"])
    return hits.groupBy("sid", "tab", "src").agg(F.count("*").alias("n"))


@query("rule_alerts", f"""
WITH {_rule_hits()}, {_rule_limits(STRETCH)},
live AS (SELECT sid || '-' || src AS key, h.*, kind, cnt, width FROM hits h JOIN lim USING (sid)),
{chain("c", "live", "r.width").replace("c.s + r.width", "c.s + r.width")}, {placed("w", "live", "c")},
n AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY t, tab_rank, uid, tab) AS n
      FROM (SELECT *, 0 AS tab_rank FROM w))
SELECT sid, t AS ts_us, src, dst, uid, tab FROM n WHERE {KEPT}
UNION ALL SELECT sid, t, src, dst, uid, tab FROM hits WHERE sid NOT IN (SELECT sid FROM lim)""", RULE_VIEWS, recursive=True)
def rule_alerts(spark, sf):
    found = rules.alerts(_rule_tables(spark, sf), _stretched(), order=["uid", "tab"])
    return plain(found.select("sid", "ts", "src", "dst", "uid", "tab"))


@query("rule_alerts_calendar", f"""
WITH {_rule_hits()}, {_rule_limits(STRETCH)},
n AS (SELECT h.*, kind, cnt, row_number() OVER (PARTITION BY sid, src, t - t % coalesce(width, 1) ORDER BY t, uid, tab) AS n
      FROM hits h LEFT JOIN lim USING (sid))
SELECT sid, t AS ts_us, src, dst, uid, tab FROM n WHERE {KEPT}""", RULE_VIEWS)
def rule_alerts_calendar(spark, sf):
    found = rules.alerts(_rule_tables(spark, sf), _stretched(), order=["uid", "tab"], anchor="calendar")
    return plain(found.select("sid", "ts", "src", "dst", "uid", "tab"))


@query("rule_evidence", f"WITH {_probe_hits()} SELECT sid, tab, src, dst, count(*) AS n FROM hits GROUP BY ALL", probes.VIEWS)
def rule_evidence(spark, sf):
    hits = rules.matches(probes.tables(spark, sf), order=["uid", "tab"])
    return hits.groupBy("sid", "tab", "src", "dst").agg(F.count("*").alias("n"))


@query("rule_evidence_alerts", f"""
WITH {_probe_hits()}, {_rule_limits(STRETCH)},
n AS (SELECT h.*, kind, cnt, row_number() OVER (PARTITION BY sid, src, t - t % coalesce(width, 1) ORDER BY t, uid, tab) AS n
      FROM hits h LEFT JOIN lim USING (sid))
SELECT sid, t AS ts_us, src, dst, uid, tab FROM n WHERE {KEPT}""", probes.VIEWS)
def rule_evidence_alerts(spark, sf):
    found = rules.alerts(probes.tables(spark, sf), _stretched(), order=["uid", "tab"], anchor="calendar")
    return plain(found.select("sid", "ts", "src", "dst", "uid", "tab"))


# --- incidents ---------------------------------------------------------------

FOLDED = """
WITH weight(note, w, m) AS (VALUES ('C2_Beaconing_Detected', 50, 'T1071.001'), ('C2_JA3_Suspicious', 45, 'T1071.001'),
  ('DNS_High_NXDOMAIN_Ratio', 25, 'T1071.004')),
u AS (SELECT src, t, 0 AS sr, event_id AS seq, note AS type, NULL AS sev, coalesce(w, 15) AS w, m
      FROM notices LEFT JOIN weight USING (note)
  UNION ALL SELECT src_ip, t, 1, event_id, signature, severity,
      CASE severity WHEN 1 THEN 40 WHEN 2 THEN 20 ELSE 10 END, NULL FROM alerts WHERE event_type = 'alert'),
"""


def _incident_sql(bucket: str, group: str, threshold: int) -> str:
    return FOLDED + f"""
b AS (SELECT *{bucket} FROM u),
k AS (SELECT src{group}, type, sev, sum(w) AS w, max(m) AS m, min(t) AS t0 FROM b GROUP BY ALL)
SELECT src AS src_ip{group}, least(100, sum(w))::INT AS threat_score, count(*)::INT AS alert_count,
  CASE WHEN sum(w) >= 80 THEN 'CRITICAL' WHEN sum(w) >= {threshold} THEN 'HIGH' WHEN sum(w) >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS verdict,
  coalesce(string_agg(DISTINCT m, ',' ORDER BY m), '') AS techniques, sum(t0)::BIGINT AS first_sum
FROM k GROUP BY src{group} HAVING sum(w) >= {threshold}"""


def _incident_rows(found, *more):
    first = F.aggregate("alerts", F.lit(0).cast("long"), lambda a, x: a + F.unix_micros(x["ts"]))
    return plain(found.select("src_ip", *more, "threat_score", "alert_count", "verdict",
                              F.array_join("mitre_ttps", ",").alias("techniques"), first.alias("first_sum")))


@query("incidents", _incident_sql("", "", 70), ["notices", "alerts"])
def correlated(spark, sf):
    return _incident_rows(incidents.correlate(bind.notices(spark, sf), bind.alert_events(spark, sf)))


@query("incidents_daily", _incident_sql(f", t - t % {DAY_US} AS bucket_us", ", bucket_us", 70), ["notices", "alerts"])
def correlated_daily(spark, sf):
    found = incidents.correlate(bind.notices(spark, sf), bind.alert_events(spark, sf), bucket_seconds=DAY)
    return _incident_rows(found, "bucket")


@query("incident_payloads", FOLDED + """
k AS (SELECT src, type, sev, sum(w) AS w, max(m) AS m FROM u GROUP BY ALL),
i AS (SELECT src, least(100, sum(w)) AS s FROM k GROUP BY src HAVING sum(w) >= 70)
SELECT '[' || CASE WHEN s >= 80 THEN 'CRITICAL' ELSE 'HIGH' END || '] Correlated Alerts — ' || src AS title,
  CASE WHEN s >= 80 THEN 1 ELSE 2 END AS severity, 'corr-' || src || '-0' AS source_ref FROM i""", ["notices", "alerts"])
def incident_payloads(spark, sf):
    found = incidents.correlate(bind.notices(spark, sf), bind.alert_events(spark, sf))
    p = incidents.payloads(found, F.lit(0))
    return p.select("title", "severity", F.col("sourceRef").alias("source_ref"))


@query("technique_coverage", FOLDED + """
i AS (SELECT src, sum(w) AS s FROM u GROUP BY src HAVING sum(w) >= 70)
SELECT m AS technique, count(DISTINCT u.src) AS incidents FROM u JOIN i ON u.src = i.src WHERE m IS NOT NULL GROUP BY 1""",
       ["notices", "alerts"])
def technique_coverage(spark, sf):
    return incidents.technique_coverage(incidents.correlate(bind.notices(spark, sf), bind.alert_events(spark, sf)))


# --- scores ------------------------------------------------------------------

CONSONANTS = "len(regexp_replace(lower({0}), '[^a-z]|[aeiou]', '', 'g'))"
VOWELS = "len(regexp_replace(lower({0}), '[^aeiou]', '', 'g'))"


@query("entropy_domains", f"""
WITH {LABELS}, d AS (SELECT DISTINCT host AS domain, string_split(host, '.')[1] AS label FROM hosts)
SELECT domain, label, round(e, 4) AS entropy, round(CASE WHEN {VOWELS.format('label')} = 0 THEN {CONSONANTS.format('label')}
    ELSE {CONSONANTS.format('label')} / {VOWELS.format('label')} END, 3)::DOUBLE AS cv_ratio, len(label)::INT AS length,
  false AS base64, round(least(1, greatest(0, (round(e, 4) - 1.8) / 0.4 / 3)) * 100, 2) AS score,
  CASE WHEN round(least(1, greatest(0, (round(e, 4) - 1.8) / 0.4 / 3)) * 100, 2) > 50 THEN 'DGA_SUSPECT' ELSE 'REVIEW' END AS verdict
FROM d JOIN ent USING (label) WHERE len(label) >= 5 AND round(e, 4) >= 2.0""", ["dns", "hosts"])
def entropy_domains(spark, sf):
    names = bind.hosts(spark, sf).select(F.col("host").alias("domain")).distinct()
    return score.entropy_domains(names, threshold=2.0, min_length=5, baseline=(1.8, 0.4))


@query("entropy_domains_baseline", f"""
WITH {LABELS}, base AS (SELECT avg(round(e, 4)) AS m, stddev_pop(round(e, 4)) AS sd
  FROM (SELECT string_split(host, '.')[1] AS label FROM hosts WHERE page_id % 3 = 0) JOIN ent USING (label) WHERE len(label) >= 6),
d AS (SELECT DISTINCT host AS domain, string_split(host, '.')[1] AS label FROM hosts)
SELECT domain, round(e, 4) AS entropy, round(least(1, greatest(0, (round(e, 4) - m) / greatest(sd, 0.01) / 3)) * 100, 2) AS score
FROM d JOIN ent USING (label), base WHERE len(label) >= 5 AND round(e, 4) >= 2.0""", ["dns", "hosts"])
def entropy_domains_baseline(spark, sf):
    hosts = bind.hosts(spark, sf)
    benign = hosts.where("page_id % 3 = 0").select(text.first_label("host").alias("label"))
    names = hosts.select(F.col("host").alias("domain")).distinct()
    found = score.entropy_domains(names, threshold=2.0, min_length=5, baseline=score.entropy_baseline(benign, "label"))
    return found.select("domain", "entropy", "score")


@query("entropy_baseline", f"""
WITH {LABELS}, h AS (SELECT string_split(host, '.')[1] AS label FROM hosts)
SELECT round(avg(round(e, 4)), 6) AS base_mean, round(stddev_pop(round(e, 4)), 6) AS base_std
FROM h JOIN ent USING (label) WHERE len(label) >= 6""", ["dns", "hosts"])
def entropy_baseline(spark, sf):
    names = bind.hosts(spark, sf).select(text.first_label("host").alias("label"))
    return plain(score.entropy_baseline(names, "label"))


@query("unified_scores", PAIR_GAPS + f""",
{LABELS},
pd AS (SELECT DISTINCT id_orig_h, '203.0.113.10' AS id_resp_h, string_split(query, '.')[1] AS label FROM dns),
es AS (SELECT id_orig_h, id_resp_h, max(round(greatest(0, (round(e, 4) - 1.5) / 1.5) * 100, 2)) AS es
       FROM pd JOIN ent USING (label) GROUP BY ALL),
v AS (SELECT id_orig_h, id_resp_h, round(least(100, sum(orig_bytes)::BIGINT / 1234567891.0 * 50), 2) AS vs FROM conn GROUP BY ALL),
b AS (SELECT id_orig_h, id_resp_h, CASE WHEN n >= 10 THEN round(greatest(0, (0.8 - cv) / 0.8) * 50 + least(50, m), 2) ELSE 0 END AS bs
      FROM s WHERE n >= 2),
j AS (SELECT id_orig_h AS src, id_resp_h AS dst, coalesce(bs, 0)::DOUBLE AS bs, coalesce(es, 0)::DOUBLE AS es, coalesce(vs, 0)::DOUBLE AS vs
      FROM v FULL JOIN b USING (id_orig_h, id_resp_h) FULL JOIN es USING (id_orig_h, id_resp_h))
SELECT src, dst, bs AS beacon_score, es AS entropy_score, vs AS volume_score, round(bs * 0.41237 + es * 0.29871 + vs * 0.28892, 2) AS unified_score,
  CASE WHEN bs * 0.41237 + es * 0.29871 + vs * 0.28892 > 80 THEN 'CRITICAL' WHEN bs * 0.41237 + es * 0.29871 + vs * 0.28892 > 60 THEN 'HIGH'
       WHEN bs * 0.41237 + es * 0.29871 + vs * 0.28892 > 40 THEN 'MEDIUM' ELSE 'LOW' END AS verdict,
  round(bs * 0.41237 + es * 0.29871 + vs * 0.28892, 2) >= 60 AS is_anomalous FROM j""", ["conn", "dns"])
def unified_scores(spark, sf):
    pairs = bind.dns(spark, sf).select("id_orig_h", F.lit("203.0.113.10").alias("id_resp_h"), F.col("query").alias("domain"))
    found = score.unified_scores(bind.conn(spark, sf), pairs.distinct(), cv_threshold=0.8, entropy_threshold=1.5,
                                 volume_threshold=1_234_567_891,
                                 weights=(0.41237, 0.29871, 0.28892))
    return found


# --- joins -------------------------------------------------------------------

@query("indicator_addresses", r"""
WITH ips AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b', 1)) AS ip FROM documents)
SELECT doc_id, ip, count(*) AS n FROM ips GROUP BY ALL""")
def indicator_addresses(spark, sf):
    found = enrich.addresses_in_text(bind.table(spark, sf, "documents"))
    return found.groupBy("doc_id", "ip").agg(F.count("*").alias("n"))


@query("indicator_ip_match", """
WITH ind AS (SELECT DISTINCT '203.0.113.' || n_nationkey AS ip, n_name AS family FROM nation)
SELECT uid, id_resp_h, family AS ioc_family FROM http JOIN ind ON id_resp_h = ip""", ["http"])
def indicator_ip_match(spark, sf):
    listed = bind.table(spark, sf, "nation").select(
        F.lit("ip").alias("type"), F.concat(F.lit("203.0.113."), "n_nationkey").alias("value"),
        F.col("n_name").alias("family"), F.lit("C2").alias("role"), F.lit("HIGH").alias("confidence"))
    return enrich.match_values(bind.http(spark, sf), listed, "ip", "id_resp_h").select("uid", "id_resp_h", "ioc_family")


@query("indicator_domain_match", f"""
WITH ind AS (SELECT DISTINCT {BASE.format('host')} AS d FROM hosts WHERE page_id % 9 = 0 UNION SELECT host FROM hosts WHERE page_id % 10 = 0)
SELECT uid, query, d AS ioc_value FROM dns JOIN ind ON query = d OR query LIKE '%.' || d""", ["dns", "hosts"])
def indicator_domain_match(spark, sf):
    h = bind.hosts(spark, sf)
    listed = h.where("page_id % 9 = 0").select(text.base_domain("host").alias("value")).unionByName(
        h.where("page_id % 10 = 0").select(F.col("host").alias("value"))).select(
        F.lit("domain").alias("type"), "value", F.lit("x").alias("family"), F.lit("C2").alias("role"))
    return enrich.match_domains(bind.dns(spark, sf), listed).select("uid", "query", "ioc_value")


@query("published_indicator_hits", """
SELECT 'ja3' AS kind, count(*) AS n FROM ssl WHERE ja3 IN ('a0e9f5d64349fb13191bc781f81f42e1',
  '72a589da586844d7f0818ce684948eea', 'de9f2c7fd25e1b3afad3e85a0bd17d9b')
UNION ALL SELECT 'cert', count(*) FROM ssl WHERE subject IN ('CN=AsyncRAT Server', 'CN=jquery-cdn.net', 'CN=lab.example.com')
UNION ALL SELECT 'ip', count(*) FROM conn WHERE id_resp_h IN ('45.33.32.156', '185.220.101.10', '103.75.190.11',
  '185.220.101.45', '91.92.241.103', '185.180.143.44')""", ["ssl", "conn"])
def published_indicator_hits(spark, sf):
    listed = enrich.published_indicators(spark)
    ssl, conn = bind.ssl(spark, sf), bind.conn(spark, sf)
    parts = [enrich.match_values(df, listed, kind, c).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
             for kind, df, c in (("ja3", ssl, "ja3"), ("cert", ssl, "subject"), ("ip", conn, "id_resp_h"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_OCCURS = """
found AS (SELECT {key}, type, value, unnest(range(1, len(p))) AS i, p FROM
  (SELECT {key}, type, value, string_split(lower({text}), lower(value)) AS p FROM {rows}, listed WHERE contains(lower({text}), lower(value)))),
kept AS (SELECT {key}, type, value, sum(len(p[i])) OVER (PARTITION BY {key}, type, value ORDER BY i) + (i - 1) * len(value) AS start,
  regexp_matches(p[i], '[\\pL\\pN_-]$') AS before, regexp_matches(p[i], '[.]$') AS dot, regexp_matches(p[i + 1], '^[\\pL\\pN_-]') AS after,
  regexp_matches(p[i + 1], '^[.][\\pL\\pN]') AS label, regexp_matches(p[i + 1], '^([\\s"''<>)]|$)') AS stop FROM found)
SELECT {key}, start::BIGINT AS start, type AS ioc_type, value AS ioc_value FROM kept
WHERE CASE type WHEN 'url' THEN NOT before AND stop ELSE NOT before AND NOT after AND (type = 'hash' OR NOT label) AND (type <> 'ip' OR NOT dot) END"""


@query("indicators_in_text", """
WITH listed AS (SELECT DISTINCT 'domain' AS type, 'mail' || n_nationkey || '.example.com' AS value FROM nation
  UNION SELECT 'domain', 'example.com' UNION SELECT 'ip', ip FROM (SELECT regexp_extract(text, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+') AS ip FROM documents
    WHERE doc_id % 20 = 0) WHERE ip <> ''
  UNION SELECT 'hash', h FROM (SELECT regexp_extract(text, '[0-9a-f]{40}') AS h FROM documents WHERE doc_id % 10 = 0) WHERE h <> ''),"""
       + _OCCURS.format(key="doc_id", text="text", rows="documents"))
def indicators_in_text(spark, sf):
    docs, nations = bind.table(spark, sf, "documents"), bind.table(spark, sf, "nation")
    value = lambda df, kind, c: df.select(F.lit(kind).alias("type"), c.alias("value"))
    found = lambda n, p: F.regexp_extract(F.when(F.col("doc_id") % n == 0, F.col("text")), p, 0)
    listed = (value(nations, "domain", F.concat(F.lit("mail"), "n_nationkey", F.lit(".example.com")))
              .unionByName(value(nations, "domain", F.lit("example.com")))
              .unionByName(value(docs, "ip", found(20, r"[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+")))
              .unionByName(value(docs, "hash", found(10, "[0-9a-f]{40}"))).distinct())
    details = {c: F.lit("x") for c in ("family", "role", "confidence")}
    return textmatch.indicators_in(docs, listed.withColumns(details), ["doc_id"], "text").select("doc_id", "start", "ioc_type", "ioc_value")


@query("indicators_in_urls", f"""
WITH listed AS (SELECT DISTINCT 'domain' AS type, {BASE.format('host')} AS value FROM hosts WHERE page_id % 9 = 0
  UNION SELECT 'url', url FROM hosts WHERE page_id % 5 = 0),"""
       + _OCCURS.format(key="page_id", text="url", rows="hosts"), ["hosts"])
def indicators_in_urls(spark, sf):
    h = bind.hosts(spark, sf)
    listed = h.where("page_id % 9 = 0").select(F.lit("domain").alias("type"), text.base_domain("host").alias("value")).unionByName(
        h.where("page_id % 5 = 0").select(F.lit("url").alias("type"), F.col("url").alias("value")))
    details = {c: F.lit("x") for c in ("family", "role", "confidence")}
    return textmatch.indicators_in(h, listed.withColumns(details), ["page_id"], "url").select("page_id", "start", "ioc_type", "ioc_value")


IP_LONG = ("(split_part({0}, '.', 1)::BIGINT * 16777216 + split_part({0}, '.', 2)::BIGINT * 65536 "
           "+ split_part({0}, '.', 3)::BIGINT * 256 + split_part({0}, '.', 4)::BIGINT)")


@query("geo_ranges", f"""
SELECT uid, id_resp_h, country AS dst_geo_country, lat AS dst_geo_lat, lon AS dst_geo_lon, NULL::VARCHAR AS src_geo_country
FROM conn LEFT JOIN geo ON {IP_LONG.format('id_resp_h')} BETWEEN ip_start AND ip_end""", ["conn", "geo"])
def geo_ranges(spark, sf):
    return enrich.locate_both(bind.conn(spark, sf), bind.geo(spark, sf)).select(
        "uid", "id_resp_h", "dst_geo_country", "dst_geo_lat", "dst_geo_lon", "src_geo_country")


@query("locality", f"""
SELECT id_resp_h, {IN} AS cidr, (id_resp_h LIKE '10.%' OR id_resp_h LIKE '172.16.%' OR id_resp_h LIKE '192.168.%') AS prefix,
  count(*) AS n FROM conn GROUP BY ALL""", ["conn"])
def locality(spark, sf):
    return bind.conn(spark, sf).groupBy("id_resp_h", net.is_local_cidr("id_resp_h").alias("cidr"),
                                        net.is_local_prefix("id_resp_h").alias("prefix")).agg(F.count("*").alias("n"))


# --- mapping -----------------------------------------------------------------

def _leaves(df, names):
    flat = ecs.flatten(df, "_")
    return plain(flat.select(*[F.col(f"`{n}`").alias(n.lstrip("@")) for n in names]))


@query("ecs_conn", """
SELECT t AS timestamp_us, 'zeek.conn' AS event_dataset, 'event' AS event_kind, id_orig_h AS source_ip, id_orig_p::INT AS source_port,
  id_resp_h AS destination_ip, id_resp_p AS destination_port, proto AS network_transport, orig_bytes AS source_bytes,
  resp_bytes AS destination_bytes, orig_bytes + resp_bytes AS network_bytes, conn_state AS zeek_conn_state,
  history AS zeek_conn_history, round(duration, 6) AS event_duration, country AS destination_geo_country_name
FROM conn LEFT JOIN geo ON """ + IP_LONG.format("id_resp_h") + " BETWEEN ip_start AND ip_end", ["conn", "geo"])
def ecs_conn(spark, sf):
    return _leaves(ecs.conn_to_ecs(bind.conn(spark, sf), bind.geo(spark, sf)), [
        "@timestamp", "event_dataset", "event_kind", "source_ip", "source_port", "destination_ip", "destination_port",
        "network_transport", "source_bytes", "destination_bytes", "network_bytes", "zeek_conn_state", "zeek_conn_history",
        "event_duration", "destination_geo_country_name"])


@query("ecs_dns", f"""
SELECT t AS timestamp_us, 'zeek.dns' AS event_dataset, query AS dns_question_name, qtype_name AS dns_question_type,
  rcode_name AS dns_response_code, {BASE.format('query')} AS dns_question_registered_domain,
  len({LABEL.format('query')})::INT AS zeek_dns_first_label_length, id_orig_h AS source_ip FROM dns""", ["dns"])
def ecs_dns(spark, sf):
    return _leaves(ecs.dns_to_ecs(bind.dns(spark, sf)), [
        "@timestamp", "event_dataset", "dns_question_name", "dns_question_type", "dns_response_code",
        "dns_question_registered_domain", "zeek_dns_first_label_length", "source_ip"])


@query("ecs_http", r"""
WITH p AS (SELECT *, regexp_extract(uri, '^([^?#]*)', 1) AS path FROM http)
SELECT t AS timestamp_us, 'zeek.http' AS event_dataset, method AS http_request_method, host AS url_domain, path AS url_path,
  nullif(regexp_extract(uri, '^[^?#]*\?([^#]*)', 1), '') AS url_query, nullif(regexp_extract(uri, '#(.*)$', 1), '') AS url_fragment,
  nullif(regexp_extract(path, '\.([^./]+)$', 1), '') AS url_extension, 'http://' || host || path AS url_full,
  user_agent AS user_agent_original, status_code::BIGINT AS http_response_status_code,
  CASE WHEN status_code < 400 THEN 'success' WHEN status_code >= 400 THEN 'failure' END AS event_outcome,
  request_body_len AS http_request_body_bytes FROM p""", ["http"])
def ecs_http(spark, sf):
    return _leaves(ecs.http_to_ecs(bind.http(spark, sf)), [
        "@timestamp", "event_dataset", "http_request_method", "url_domain", "url_path", "url_query", "url_fragment",
        "url_extension", "url_full", "user_agent_original", "http_response_status_code", "event_outcome",
        "http_request_body_bytes"])


@query("ecs_alerts", """
SELECT t AS timestamp_us, 'suricata.' || event_type AS event_dataset, CASE WHEN event_type = 'alert' THEN 'alert' ELSE 'event' END AS event_kind,
  CASE WHEN event_type = 'alert' THEN 'network,intrusion_detection' ELSE 'network' END AS event_category,
  signature AS rule_name, signature_id AS rule_id, category AS rule_category, severity AS event_severity,
  src_ip AS source_ip, dest_ip AS destination_ip FROM alerts""", ["alerts"])
def ecs_alerts(spark, sf):
    flat = ecs.flatten(ecs.eve_to_ecs(bind.alert_events(spark, sf)), "_").withColumn(
        "event_category", F.array_join("event_category", ","))
    return plain(flat.select(F.col("`@timestamp`").alias("timestamp"), "event_dataset", "event_kind", "event_category",
                             "rule_name", "rule_id", "rule_category", "event_severity", "source_ip", "destination_ip"))


@query("ecs_failures", """
SELECT event_id, 'unable to parse time ' || raw AS error_message, 'zeek.conn' AS dataset
FROM (SELECT event_id, CASE WHEN k % 10 = 3 THEN 'bad-' || k ELSE (t // 1000000)::VARCHAR END AS raw FROM ev) WHERE raw LIKE 'bad%'""",
       ["ev"])
def ecs_failures(spark, sf):
    raw = bind.events(spark, sf).select(
        "event_id", F.when(F.col("k") % 10 == 3, F.concat(F.lit("bad-"), "k"))
        .otherwise(F.unix_seconds("ts").cast("string")).alias("ts"))
    return ecs.failures(raw, "ts", "zeek.conn").select("event_id", "error_message", "dataset")


# --- panels ------------------------------------------------------------------

def _top(view: str, column: str, name: str, n: int, where: str = "true") -> str:
    return (f"SELECT {column} AS {name}, count(*) AS count FROM {view} WHERE {where} GROUP BY 1 "
            f"ORDER BY count(*) DESC, 1 LIMIT {n}")


ALERT = "event_type = 'alert'"


@query("panel_top_talkers", _top("conn", "id_orig_h", "source_ip", 10), ["conn"])
def panel_top_talkers(spark, sf):
    return panels.top_talkers(bind.conn(spark, sf))


@query("panel_alerts_by_severity", f"""
WITH best AS ({_top("alerts", "severity", "severity", 5, ALERT)})
SELECT severity, t - t % 3600000000 AS bucket_us, count(*) AS count FROM alerts SEMI JOIN best USING (severity)
WHERE {ALERT} GROUP BY ALL""", ["alerts"])
def panel_alerts_by_severity(spark, sf):
    return plain(panels.alerts_by_severity(bind.alert_events(spark, sf)))


@query("panel_dns_per_minute", "SELECT t - t % 60000000 AS bucket_us, count(*) AS count FROM dns GROUP BY 1", ["dns"])
def panel_dns_per_minute(spark, sf):
    return plain(panels.queries_over_time(bind.dns(spark, sf)))


@query("panel_alert_categories", f"""
WITH best AS ({_top("alerts", "category", "category", 5, ALERT + " AND category LIKE '%Trojan%'")})
SELECT category, t - t % 300000000 AS bucket_us, count(*) AS count FROM alerts SEMI JOIN best USING (category)
WHERE {ALERT} GROUP BY ALL""", ["alerts"])
def panel_alert_categories(spark, sf):
    return plain(panels.alert_categories(bind.alert_events(spark, sf)))


@query("panel_top_destinations", """
SELECT id_resp_h AS destination_ip, sum(request_body_len)::BIGINT AS bytes FROM http GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", ["http"])
def panel_top_destinations(spark, sf):
    return panels.top_destinations(bind.http(spark, sf).withColumnRenamed("request_body_len", "orig_bytes"))


BASE32 = "'0123456789bcdefghjkmnpqrstuvwxyz'"


def _geohash_sql(lat: str, lon: str) -> str:
    x, y = f"floor(({lon} + 180) / 360 * 256)::BIGINT", f"floor(({lat} + 90) / 180 * 128)::BIGINT"
    chars = []
    for i in range(3):
        bits = []
        for j in range(5):
            b = 5 * i + j
            axis, size = (x, 8) if b % 2 == 0 else (y, 7)
            bits.append(f"(({axis} >> {size - 1 - b // 2}) & 1) * {1 << (4 - j)}")
        chars.append(f"substr({BASE32}, ({' + '.join(bits)} + 1)::INT, 1)")
    return " || ".join(chars)


@query("panel_destination_grid", f"""
SELECT {_geohash_sql('lat', 'lon')} AS geohash, count(*) AS count FROM http
JOIN geo ON {IP_LONG.format('id_resp_h')} BETWEEN ip_start AND ip_end GROUP BY 1""", ["http", "geo"])
def panel_destination_grid(spark, sf):
    return panels.destination_grid(bind.http(spark, sf), bind.geo(spark, sf))


@query("panel_user_agents", _top("http", "user_agent", "user_agent", 15), ["http"])
def panel_user_agents(spark, sf):
    return panels.top_user_agents(bind.http(spark, sf))


@query("panel_alert_total", f"SELECT count(*) AS count FROM alerts WHERE {ALERT} AND ts >= TIMESTAMP '2024-01-29'", ["alerts"])
def panel_alert_total(spark, sf):
    return panels.alert_total(bind.alert_events(spark, sf), 24, "2024-01-30")


@query("panel_top_signatures", _top("alerts", "signature", "signature", 20, ALERT), ["alerts"])
def panel_top_signatures(spark, sf):
    return panels.top_signatures(bind.alert_events(spark, sf))


@query("top_alert_sources", _top("alerts", "src_ip", "src_ip", 20, ALERT), ["alerts"])
def top_alert_sources(spark, sf):
    return panels.top_alert_sources(bind.alert_events(spark, sf))


@query("severity_summary", f"""
SELECT severity AS severity_int, count(*) AS count, CASE severity WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'LOW' END AS severity_label
FROM alerts WHERE {ALERT} GROUP BY severity""", ["alerts"])
def severity_summary(spark, sf):
    return panels.severity_summary(bind.alert_events(spark, sf))


# --- reports -----------------------------------------------------------------

BEACON_CONF = GAPS + """, f AS (SELECT *, round(least(100, greatest(0, 1 - sd / m) * 100 + least(10, (n - 10) * 0.5)), 1) AS conf
FROM s WHERE n >= 10 AND round(m, 3) BETWEEN 5 AND 1000000 AND round(sd / m, 4) <= 0.8)
"""


def _beacons(spark, sf):
    return intervals.beacons(bind.conn(spark, sf), cv_threshold=0.8, max_interval=1e6)


@query("report_confidence_bands", BEACON_CONF + """
SELECT CASE WHEN conf > 90 THEN 'Critical' WHEN conf >= 70 THEN 'High' WHEN conf >= 50 THEN 'Medium' ELSE 'Low' END AS band,
  count(*) AS suspects FROM f GROUP BY 1""", ["conn"])
def report_confidence_bands(spark, sf):
    return reports.confidence_bands(_beacons(spark, sf))


@query("report_funnel", BEACON_CONF + """
SELECT (SELECT count(*) FROM conn) AS connections, (SELECT count(*) FROM s) AS keys,
  (SELECT count(*) FROM s WHERE n >= 10) AS eligible, (SELECT count(*) FROM f) AS flagged""", ["conn"])
def report_funnel(spark, sf):
    return reports.funnel(bind.conn(spark, sf), _beacons(spark, sf), intervals.TRIPLE)


@query("report_beacon_table", BEACON_CONF + """, r AS (SELECT *, row_number() OVER (ORDER BY conf DESC, id_orig_h, id_resp_h, id_resp_p) AS rank FROM f)
SELECT rank::INT AS rank, printf('| %d | %s | %s | %d | %d | %.1fs | %.4f | **%.1f%%** |', rank, id_orig_h, id_resp_h, id_resp_p::INT, n,
  round(m, 3), round(sd / m, 4), conf) AS line FROM r WHERE rank <= 20""", ["conn"])
def report_beacon_table(spark, sf):
    return reports.beacon_table(_beacons(spark, sf))


@query("report_flagged_per_source", f"""
WITH {LABELS}
SELECT id_orig_h AS src, count(DISTINCT query) AS flagged FROM dns JOIN ent ON label = string_split(query, '.')[1]
WHERE round(e, 3) > 2.2 AND len(label) > 5 GROUP BY 1""", ["dns"])
def report_flagged_per_source(spark, sf):
    found = dns_ops.high_entropy(bind.dns(spark, sf), min_entropy=2.2, min_length=5)
    return reports.flagged_per_source(found, "src", "query")


@query("host_timeline", """
SELECT t AS ts_us, id_orig_h AS host, 'conn' AS source, id_resp_h || ':' || id_resp_p AS text FROM conn
UNION ALL SELECT t, id_orig_h, 'dns', query FROM dns
UNION ALL SELECT t, id_orig_h, 'http', method || ' ' || host || uri FROM http
UNION ALL SELECT t, id_orig_h, 'ssl', coalesce(server_name, id_resp_h) FROM ssl
UNION ALL SELECT t, src_ip, 'alert', signature FROM alerts WHERE event_type = 'alert'""", ["conn", "dns", "http", "ssl", "alerts"])
def host_timeline(spark, sf):
    conn, dns = bind.conn(spark, sf), bind.dns(spark, sf)
    http, ssl = bind.http(spark, sf), bind.ssl(spark, sf)
    alerts = bind.alert_events(spark, sf).where("event_type = 'alert'")
    return plain(reports.timeline([
        reports.timeline_part(conn, "id_orig_h", "conn", F.concat_ws(":", "id_resp_h", F.col("id_resp_p").cast("string"))),
        reports.timeline_part(dns, "id_orig_h", "dns", F.col("query")),
        reports.timeline_part(http, "id_orig_h", "http", F.concat("method", F.lit(" "), "host", "uri")),
        reports.timeline_part(ssl, "id_orig_h", "ssl", F.coalesce("server_name", "id_resp_h")),
        reports.timeline_part(alerts, "src_ip", "alert", F.col("alert.signature"), "timestamp")]))


@query("decoded_labels", """
SELECT page_id, to_base64(encode(url)) AS label, url AS decoded FROM hosts WHERE len(to_base64(encode(url))) >= 20
  AND regexp_matches(to_base64(encode(url)), '^[A-Za-z0-9+/]{20,}={0,2}$')""", ["hosts"])
def decoded_labels(spark, sf):
    named = bind.hosts(spark, sf).select("page_id", text.base64_text("url").alias("label")).withColumn(
        "query", F.concat("label", F.lit(".exfil.example.org")))
    return reports.decoded_labels(named).select("page_id", "label", "decoded")


@query("anchored_windows", f"""
WITH live AS (SELECT src AS key, event_id AS uid, t FROM ev), {chain("c", "live", 4 * DAY_US)}, {placed("w", "live", "c")}
SELECT uid, s AS win_start FROM w""", ["ev"], recursive=True)
def anchored(spark, sf):
    ev = bind.events(spark, sf).select(F.col("event_id").alias("uid"), "src", "ts")
    return time_windows(ev, ["src"], "ts", 4 * DAY, ["uid"]).select("uid", "win_start")
