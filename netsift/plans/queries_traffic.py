"""DNS, HTTP, TLS and lateral-movement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift.operators import dns, exfil, filters, http, lateral, notices, tls
from netsift.plans import bind
from netsift.plans.catalog import query
from netsift.plans.shape import chain, openers, placed, plain

DAY = 86400
DAY_US = DAY * 10**6
LOCAL = ("({0} LIKE '10.%' OR {0} LIKE '192.168.%' OR regexp_matches({0}, '^172[.](1[6-9]|2[0-9]|3[01])[.]'))")
PREFIX = "({0} LIKE '10.%' OR {0} LIKE '172.16.%' OR {0} LIKE '192.168.%')"
BASE = ("CASE WHEN len(string_split({0}, '.')) >= 2 THEN array_to_string(string_split({0}, '.')[-2:], '.') "
        "ELSE {0} END")
LABEL = "string_split({0}, '.')[1]"

# entropies per distinct label, joined back: a correlated form would run once per row
LABELS = """lab AS (SELECT DISTINCT string_split(query, '.')[1] AS label FROM dns),
chars AS (SELECT label, ch, count(*) AS c FROM (SELECT label, unnest(string_split(label, '')) AS ch FROM lab) GROUP BY ALL),
ent AS (SELECT label, -sum(c / len(label)::DOUBLE * log2(c / len(label)::DOUBLE)) AS e FROM chars GROUP BY label)"""


# --- DNS ---------------------------------------------------------------------

@query("dns_nxdomain_ratio", """
SELECT 'DNS_HIGH_NXDOMAIN' AS type, 'HIGH' AS severity, id_orig_h AS src, count(*) AS queries,
  count(*) FILTER (rcode_name = 'NXDOMAIN') AS nxdomains,
  round(count(*) FILTER (rcode_name = 'NXDOMAIN') / count(*)::DOUBLE, 6) AS ratio FROM dns GROUP BY 3
HAVING count(*) >= 20 AND count(*) FILTER (rcode_name = 'NXDOMAIN') / count(*)::DOUBLE >= 0.4""", ["dns"])
def dns_nxdomain_ratio(spark, sf):
    return plain(dns.nxdomain_ratio(bind.dns(spark, sf), min_ratio=0.4).drop("detail"))


@query("dns_long_labels", f"""
SELECT 'DNS_LONG_SUBDOMAIN' AS type, 'HIGH' AS severity, id_orig_h AS src, query,
  len({LABEL.format('query')}) AS label_len FROM dns WHERE len({LABEL.format('query')}) >= 8""", ["dns"])
def dns_long_labels(spark, sf):
    return dns.long_labels(bind.dns(spark, sf), min_length=8).drop("detail", "entropy")


@query("dns_high_entropy", f"""
WITH {LABELS}
SELECT 'DNS_HIGH_ENTROPY' AS type, 'MEDIUM' AS severity, id_orig_h AS src, query, len(label) AS label_len,
  round(e, 3) AS entropy FROM dns JOIN ent ON label = string_split(query, '.')[1] WHERE round(e, 3) > 2.2 AND len(label) > 5""",
       ["dns"])
def dns_high_entropy(spark, sf):
    return dns.high_entropy(bind.dns(spark, sf), min_entropy=2.2, min_length=5).drop("detail")


@query("dns_query_rate", f"""
WITH c AS (SELECT id_orig_h AS src, {BASE.format('query')} AS domain, t - t % {DAY_US} AS minute_us, count(*) AS queries
  FROM dns GROUP BY ALL HAVING count(*) >= 3)
SELECT 'DNS_HIGH_QUERY_RATE' AS type, 'HIGH' AS severity, *, queries || ' queries/min from ' || src || ' to ' || domain AS detail
FROM c""", ["dns"])
def dns_query_rate(spark, sf):
    return plain(dns.query_rate(bind.dns(spark, sf), min_per_bucket=3, bucket_seconds=DAY))


@query("dns_domain_counts", "SELECT lower(query) AS domain, count(*) AS query_count FROM dns GROUP BY 1", ["dns"])
def dns_domain_counts(spark, sf):
    return dns.domain_counts(bind.dns(spark, sf))


@query("dns_record_types", """
SELECT qtype_name, count(*) AS queries, round(count(*) / (SELECT count(*) FROM dns)::DOUBLE, 6) AS share
FROM dns GROUP BY 1""", ["dns"])
def dns_record_types(spark, sf):
    return plain(dns.record_type_breakdown(bind.dns(spark, sf)))


@query("dns_response_share", """
SELECT count(*) AS queries, count(*) FILTER (rcode = 3) AS nxdomains,
  round(count(*) FILTER (rcode = 3) / count(*)::DOUBLE, 6) AS nxdomain_share FROM dns""", ["dns"])
def dns_response_share(spark, sf):
    return plain(dns.response_breakdown(bind.dns(spark, sf)))


@query("dns_exfil_estimate", f"""
SELECT id_orig_h AS src, {BASE.format('query')} AS domain, count(*) AS queries,
  sum(len({LABEL.format('query')}) * 3 // 4)::BIGINT AS bytes FROM dns WHERE qtype_name = 'A' GROUP BY 1, 2""", ["dns"])
def dns_exfil_estimate(spark, sf):
    return dns.exfil_estimate(bind.dns(spark, sf))


@query("dns_rate_baseline", f"""
WITH c AS (SELECT id_orig_h AS src, t - t % {DAY_US} AS bucket_us, count(*) AS queries FROM dns GROUP BY ALL),
b AS (SELECT *, median(queries) OVER (PARTITION BY src ORDER BY bucket_us
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline FROM c)
SELECT src, bucket_us, queries, round(baseline, 6) AS baseline, round(queries / baseline, 6) AS ratio
FROM b WHERE queries / baseline >= 2""", ["dns"])
def dns_rate_baseline(spark, sf):
    return plain(dns.rate_against_baseline(bind.dns(spark, sf), bucket_seconds=DAY, min_ratio=2.0))


DNS_ROWS = "live AS (SELECT id_orig_h AS key, uid, t, rcode FROM dns)"


@query("sensor_dns_volume", f"""
WITH {DNS_ROWS}, {chain("c", "live", 5 * DAY_US)}, {placed("w", "live", "c")},
n AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY t, uid) AS n FROM w)
SELECT t AS ts_us, key AS src, 'HIGH_QUERY_VOLUME' AS kind, 'DNS_High_Query_Volume' AS note,
  '7 queries/min from ' || key AS detail, 'dns-vol-' || key AS identifier, 7 AS queries, uid FROM n WHERE n % 7 = 0""",
       ["dns"], recursive=True)
def sensor_dns_volume(spark, sf):
    found = dns.sensor_query_volume(bind.dns(spark, sf), threshold=6, window_seconds=5 * DAY, order=["uid"])
    return plain(found.drop("dst", "mitre_id"))


@query("sensor_dns_volume_calendar", f"""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY id_orig_h, t - t % {5 * DAY_US} ORDER BY t, uid) AS n FROM dns)
SELECT t AS ts_us, id_orig_h AS src, uid FROM n WHERE n % 7 = 0""", ["dns"])
def sensor_dns_volume_calendar(spark, sf):
    found = dns.sensor_query_volume(bind.dns(spark, sf), threshold=6, window_seconds=5 * DAY, order=["uid"],
                                    anchor="calendar")
    return plain(found.select("ts", "src", "uid"))


@query("sensor_dns_nxdomain", f"""
WITH {DNS_ROWS}, {chain("c", "live", 10 * DAY_US)}, {placed("w", "live", "c")},
n AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY t, uid) AS i FROM w),
run(key, s, i, t, uid, total, bad, hit) AS (
  SELECT key, s, i, t, uid, 1, (rcode = 3)::INT, false FROM n WHERE i = 1
  UNION ALL
  SELECT n.key, n.s, n.i, n.t, n.uid, CASE WHEN hit THEN 1 ELSE total + 1 END,
    CASE WHEN hit THEN 0 ELSE bad END + (n.rcode = 3)::INT,
    CASE WHEN hit THEN 1 ELSE total + 1 END > 5
      AND (CASE WHEN hit THEN 0 ELSE bad END + (n.rcode = 3)::INT) > 0.6 * (CASE WHEN hit THEN 1 ELSE total + 1 END)
  FROM run r JOIN n ON n.key = r.key AND n.s = r.s AND n.i = r.i + 1)
SELECT t AS ts_us, key AS src, uid, bad::BIGINT AS nxdomains, total::BIGINT AS queries FROM run WHERE hit""",
       ["dns"], recursive=True)
def sensor_dns_nxdomain(spark, sf):
    found = dns.sensor_nxdomain_ratio(bind.dns(spark, sf), ratio=0.6, min_queries=5, window_seconds=10 * DAY,
                                      order=["uid"])
    return plain(found.select("ts", "src", "uid", "nxdomains", "queries"))


@query("sensor_dns_long_subdomain", """
SELECT t AS ts_us, id_orig_h AS src, query, len(array_to_string(string_split(query, '.')[:-3], '.')) AS subdomain_len,
  'dns-long-' || id_orig_h || '-' || query AS identifier, uid
FROM dns WHERE len(string_split(query, '.')) > 2 AND len(array_to_string(string_split(query, '.')[:-3], '.')) > 8""",
       ["dns"])
def sensor_dns_long_subdomain(spark, sf):
    found = dns.sensor_long_subdomain(bind.dns(spark, sf), threshold=8, keep=["uid"])
    return plain(found.select("ts", "src", "query", "subdomain_len", "identifier", "uid"))


@query("sensor_dns_entropy", f"""
WITH {LABELS}
SELECT t AS ts_us, id_orig_h AS src, query, round(e, 6) AS entropy, uid
FROM dns JOIN ent ON label = string_split(query, '.')[1] WHERE e > 2.3""", ["dns"])
def sensor_dns_entropy(spark, sf):
    found = dns.sensor_high_entropy(bind.dns(spark, sf), threshold=2.3, keep=["uid"])
    return plain(found.select("ts", "src", "query", "entropy", "uid"))


@query("sensor_dns_port", """
SELECT t AS ts_us, id_orig_h AS src, query, id_resp_p, 'DNS on port ' || id_resp_p AS detail, uid
FROM dns WHERE id_resp_p <> 53""", ["dns"])
def sensor_dns_port(spark, sf):
    found = dns.sensor_odd_port(bind.dns(spark, sf), keep=["uid"])
    return plain(found.select("ts", "src", "query", "id_resp_p", "detail", "uid"))


@query("dns_tunnel_labels", f"""
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, query, len({LABEL.format('query')}) AS label_len, uid
FROM dns WHERE len(string_split(query, '.')) >= 2 AND len({LABEL.format('query')}) >= 9""", ["dns"])
def dns_tunnel_labels(spark, sf):
    found = dns.tunnel_labels(bind.dns(spark, sf), threshold=9, keep=["uid"])
    return plain(found.select("ts", "src", "dst", "query", "label_len", "uid"))


# --- HTTP --------------------------------------------------------------------

@query("http_large_uploads", """
SELECT 'HTTP_LARGE_POST' AS type, 'HIGH' AS severity, id_orig_h AS src, id_resp_h AS dst, request_body_len AS bytes,
  round(request_body_len / 1048576.0, 2) AS mb, uri, uid
FROM http WHERE method IN ('POST', 'PUT') AND request_body_len >= 5242880""", ["http"])
def http_large_uploads(spark, sf):
    return http.large_uploads(bind.http(spark, sf), keep=["uid"]).drop("detail")


@query("sensor_http_uploads", """
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, method, request_body_len, uid,
  'exfil-post-' || id_orig_h || '-' || id_resp_h AS identifier
FROM http WHERE method IN ('POST', 'PUT') AND request_body_len >= 5242880""", ["http"])
def sensor_http_uploads(spark, sf):
    found = http.sensor_large_uploads(bind.http(spark, sf), keep=["uid"])
    return plain(found.select("ts", "src", "dst", "method", "request_body_len", "uid", "identifier"))


@query("http_suspicious_agents", """
SELECT t AS ts_us, id_orig_h AS src, user_agent, uid, CASE WHEN user_agent LIKE 'python-%' THEN 'python-requests'
  WHEN user_agent LIKE 'Go-%' THEN 'Go-http-client' WHEN user_agent LIKE 'curl/%' THEN 'curl/'
  ELSE 'Mozilla/4\\.0 \\(compatible\\)$' END AS pattern
FROM http WHERE k_agent < 4""".replace("k_agent < 4", "user_agent NOT LIKE 'Mozilla/5.0%'"), ["http"])
def http_suspicious_agents(spark, sf):
    found = http.suspicious_agents(bind.http(spark, sf), keep=["uid"])
    return plain(found.select("ts", "src", "user_agent", "uid", "pattern"))


@query("exfil_alerts", f"""
WITH v AS (SELECT id_orig_h AS src, id_resp_h AS dst, t - t % 3600000000 AS h, sum(orig_bytes)::BIGINT AS b FROM conn
  WHERE NOT {PREFIX.format('id_resp_h')} GROUP BY ALL),
{LABELS},
parts AS (
  SELECT 'VOLUME_EXFIL' AS type, 'HIGH' AS severity, src, dst, NULL AS query FROM v WHERE b / 1048576.0 >= 100
  UNION ALL SELECT 'DNS_HIGH_NXDOMAIN', 'HIGH', id_orig_h, NULL, NULL FROM dns GROUP BY id_orig_h
    HAVING count(*) >= 20 AND count(*) FILTER (rcode = 3) / count(*)::DOUBLE >= 0.4
  UNION ALL SELECT 'DNS_LONG_SUBDOMAIN', 'HIGH', id_orig_h, NULL, query FROM dns WHERE len({LABEL.format('query')}) >= 8
  UNION ALL SELECT 'DNS_HIGH_ENTROPY', 'MEDIUM', id_orig_h, NULL, query FROM dns
    JOIN ent ON label = string_split(query, '.')[1] WHERE round(e, 3) > 3.5 AND len(label) > 10
  UNION ALL SELECT 'DNS_HIGH_QUERY_RATE', 'HIGH', id_orig_h, NULL, NULL FROM dns
    GROUP BY id_orig_h, {BASE.format('query')}, t - t % 60000000 HAVING count(*) >= 2
  UNION ALL SELECT 'HTTP_LARGE_POST', 'HIGH', id_orig_h, id_resp_h, NULL FROM http
    WHERE method IN ('POST', 'PUT') AND request_body_len >= 5242880)
SELECT type, severity, src, dst, query, count(*) AS n FROM parts GROUP BY ALL""", ["conn", "dns", "http"])
def exfil_alerts(spark, sf):
    found = exfil.all_alerts(bind.conn(spark, sf), bind.dns(spark, sf), bind.http(spark, sf), nxdomain_ratio=0.4,
                             label_length=8, queries_per_minute=2)
    return found.groupBy("type", "severity", "src", "dst", "query").agg(F.count("*").alias("n"))


# --- TLS ---------------------------------------------------------------------

@query("tls_malicious_ja3", """
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, ja3, uid, 'c2-ja3-' || id_orig_h || '-' || ja3 AS identifier
FROM ssl WHERE ja3 = md5('BUILDING')""", ["ssl"])
def tls_malicious_ja3(spark, sf):
    import hashlib

    listed = [hashlib.md5(b"BUILDING").hexdigest()]
    found = tls.malicious_ja3(bind.ssl(spark, sf), listed, keep=["uid"])
    return plain(found.select("ts", "src", "dst", "ja3", "uid", "identifier"))


@query("tls_self_signed", """
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, subject, uid, subject = 'CN=MACHINERY' AS known_malware,
  CASE WHEN subject = 'CN=MACHINERY' THEN 'c2-cert-' ELSE 'c2-selfsign-' END || id_orig_h || '-' || id_resp_h AS identifier
FROM ssl WHERE subject = issuer""", ["ssl"])
def tls_self_signed(spark, sf):
    found = tls.self_signed(bind.ssl(spark, sf), ["MACHINERY"], keep=["uid"])
    return plain(found.select("ts", "src", "dst", "subject", "uid", "known_malware", "identifier"))


@query("tls_suspicious_ports", """
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, id_resp_p, uid FROM ssl WHERE id_resp_p IN (8443, 6606)""",
       ["ssl"])
def tls_suspicious_ports(spark, sf):
    return plain(tls.suspicious_ports(bind.ssl(spark, sf), keep=["uid"]).select("ts", "src", "dst", "id_resp_p", "uid"))


@query("tls_expired", """
SELECT t AS ts_us, id_orig_h AS src, epoch_us(not_valid_after) AS not_valid_after_us, uid FROM ssl
WHERE not_valid_after < ts""", ["ssl"])
def tls_expired(spark, sf):
    return plain(tls.expired(bind.ssl(spark, sf), keep=["uid"]).select("ts", "src", "not_valid_after", "uid"))


@query("tls_no_server_name", """
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, uid FROM ssl
WHERE server_name IS NULL AND id_resp_h NOT LIKE '10.%'""", ["ssl"])
def tls_no_server_name(spark, sf):
    return plain(tls.missing_server_name(bind.ssl(spark, sf), keep=["uid"]).select("ts", "src", "dst", "uid"))


@query("hunt_tls_no_server_name", "SELECT uid FROM ssl WHERE server_name IS NULL", ["ssl"])
def hunt_tls_no_server_name(spark, sf):
    return tls.hunt_no_server_name(bind.ssl(spark, sf)).select("uid")


@query("hunt_tls_untrusted_issuer", "SELECT uid, issuer FROM ssl WHERE issuer NOT LIKE 'DigiCert%'", ["ssl"])
def hunt_tls_untrusted_issuer(spark, sf):
    return tls.hunt_untrusted_issuer(bind.ssl(spark, sf)).select("uid", "issuer")


@query("hunt_tls_ports", "SELECT uid, id_resp_p FROM ssl WHERE id_resp_p NOT IN (443, 8443)", ["ssl"])
def hunt_tls_ports(spark, sf):
    return tls.hunt_ports(bind.ssl(spark, sf)).select("uid", "id_resp_p")


@query("hunt_tls_ja3", "SELECT uid, ja3 FROM ssl WHERE ja3 IN (md5('BUILDING'), md5('FURNITURE'))", ["ssl"])
def hunt_tls_ja3(spark, sf):
    import hashlib

    listed = [hashlib.md5(s).hexdigest() for s in (b"BUILDING", b"FURNITURE")]
    return tls.hunt_ja3(bind.ssl(spark, sf), listed).select("uid", "ja3")


@query("hunt_tls_validity", """
SELECT uid, date_diff('day', not_valid_before, not_valid_after) AS validity_days FROM ssl
WHERE date_diff('day', not_valid_before, not_valid_after) < 30
   OR date_diff('day', not_valid_before, not_valid_after) > 1095""", ["ssl"])
def hunt_tls_validity(spark, sf):
    return tls.hunt_validity(bind.ssl(spark, sf)).select("uid", "validity_days")


# --- lateral movement --------------------------------------------------------

@query("smb_scan", f"""
WITH live AS (SELECT id_orig_h AS key, uid, t, id_resp_h FROM lan WHERE id_resp_p IN (445, 139)),
{chain("c1", "live", 3 * DAY_US)}, {placed("w", "live", "c1")},
n AS (SELECT *, row_number() OVER (PARTITION BY key, s, id_resp_h ORDER BY t, uid) = 1 AS fresh FROM w),
h AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY key, s ORDER BY t, uid ROWS UNBOUNDED PRECEDING) AS hosts FROM n),
hits AS (SELECT * FROM h WHERE hosts >= 3), {chain("c2", "hits", 10 * DAY_US)}, {openers("f", "hits", "c2")}
SELECT t AS ts_us, key AS src, id_resp_h AS dst, hosts AS host_count, uid,
  key || ' scanned ' || hosts || ' SMB hosts' AS detail FROM f""", ["lan"], recursive=True)
def smb_scan(spark, sf):
    found = lateral.smb_scan(bind.lan(spark, sf), min_hosts=3, window_seconds=3 * DAY, quiet_seconds=10 * DAY,
                             order=["uid"])
    return plain(found.select("ts", "src", "dst", "host_count", "uid", "detail"))


@query("distinct_hosts", f"""
SELECT id_orig_h AS src, t - t % {DAY_US} AS start_us, count(DISTINCT id_resp_h) AS host_count FROM lan
WHERE id_resp_p IN (445, 139) GROUP BY 1, 2 HAVING count(DISTINCT id_resp_h) >= 3""", ["lan"])
def distinct_hosts(spark, sf):
    return plain(lateral.distinct_hosts(bind.lan(spark, sf), bucket_seconds=DAY, min_hosts=3))


def _every(view_rows: str, width: int, every: int, cols: str) -> str:
    return f"""
WITH live AS ({view_rows}), {chain("c", "live", width)}, {placed("w", "live", "c")},
n AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY t, uid) AS n FROM w)
SELECT {cols} FROM n WHERE n % {every} = 0"""


@query("dcom_exec", _every("SELECT id_orig_h AS key, uid, t, id_resp_h FROM lan WHERE id_resp_p = 135", 10 * DAY_US, 3,
                           "t AS ts_us, key AS src, id_resp_h AS dst, uid, 'T1047' AS mitre_id"),
       ["lan"], recursive=True)
def dcom_exec(spark, sf):
    found = lateral.dcom_exec(bind.lan(spark, sf), window_seconds=10 * DAY, order=["uid"])
    return plain(found.select("ts", "src", "dst", "uid", "mitre_id"))


@query("smb_write_rate", _every("SELECT id_orig_h || '-' || id_resp_h AS key, uid, t, id_orig_h, id_resp_h FROM smb "
                                "WHERE action = 'write'", 60 * DAY_US, 4,
                                "t AS ts_us, id_orig_h AS src, id_resp_h AS dst, uid"), ["smb"], recursive=True)
def smb_write_rate(spark, sf):
    found = lateral.smb_write_rate(bind.smb(spark, sf), threshold=4, window_seconds=60 * DAY, order=["uid"])
    return plain(found.select("ts", "src", "dst", "uid"))


def _over(rows: str, width: int, condition: str, quiet_key: str, quiet: int, cols: str) -> str:
    return f"""
WITH live AS ({rows}), {chain("c1", "live", width)}, {placed("w", "live", "c1")},
n AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY t, uid) AS n FROM w),
hits AS (SELECT {quiet_key} AS key, t, uid, n, id_orig_h, id_resp_h FROM n WHERE {condition}),
{chain("c2", "hits", quiet)}, {openers("f", "hits", "c2")}
SELECT {cols} FROM f"""


@query("auth_spray", _over("SELECT id_orig_h AS key, uid, t, id_orig_h, id_resp_h FROM lan WHERE id_resp_p = 445",
                           10 * DAY_US, "n > 4", "id_orig_h", 10 * DAY_US,
                           "t AS ts_us, id_orig_h AS src, id_resp_h AS dst, n AS attempts, uid"), ["lan"], recursive=True)
def auth_spray(spark, sf):
    found = lateral.auth_spray(bind.lan(spark, sf), threshold=4, window_seconds=10 * DAY, quiet_seconds=10 * DAY,
                               order=["uid"])
    return plain(found.select("ts", "src", "dst", "attempts", "uid"))


@query("rdp_brute_force", _over("SELECT id_orig_h || '-' || id_resp_h AS key, uid, t, id_orig_h, id_resp_h FROM rdp "
                                "WHERE id_resp_p = 3389 AND duration < 5 AND orig_bytes < 1024", 20 * DAY_US, "n >= 3",
                                "id_orig_h", 3 * DAY_US,
                                "t AS ts_us, id_orig_h AS src, id_resp_h AS dst, n AS attempts, uid"), ["rdp"],
       recursive=True)
def rdp_brute_force(spark, sf):
    found = lateral.rdp_brute_force(bind.rdp(spark, sf), threshold=3, window_seconds=20 * DAY, quiet_seconds=3 * DAY,
                                    order=["uid"])
    return plain(found.select("ts", "src", "dst", "attempts", "uid"))


@query("internal_rdp", "SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, uid FROM lan WHERE id_resp_p = 3389", ["lan"])
def internal_rdp(spark, sf):
    return plain(lateral.internal_rdp(bind.lan(spark, sf), keep=["uid"]).select("ts", "src", "dst", "uid"))


@query("smb_admin_share", "SELECT t AS ts_us, id_orig_h AS src, name, uid FROM smb WHERE name LIKE '%ADMIN$%'", ["smb"])
def smb_admin_share(spark, sf):
    return plain(lateral.admin_share(bind.smb(spark, sf), keep=["uid"]).select("ts", "src", "name", "uid"))


@query("smb_admin_share_write", r"""
SELECT t AS ts_us, id_orig_h AS src, name, uid FROM smb WHERE action = 'create' AND name LIKE '\\srv\ADMIN$%'""", ["smb"])
def smb_admin_share_write(spark, sf):
    return plain(lateral.admin_share_write(bind.smb(spark, sf), keep=["uid"]).select("ts", "src", "name", "uid"))


@query("smb_psexec", "SELECT t AS ts_us, id_orig_h AS src, name, uid FROM smb WHERE name LIKE '%PSEXESVC%'", ["smb"])
def smb_psexec(spark, sf):
    return plain(lateral.psexec(bind.smb(spark, sf), keep=["uid"]).select("ts", "src", "name", "uid"))


@query("smb_psexec_create", """
SELECT t AS ts_us, id_orig_h AS src, name, uid FROM smb WHERE action = 'create' AND name LIKE '%PSEXESVC%'""", ["smb"])
def smb_psexec_create(spark, sf):
    return plain(lateral.psexec_create(bind.smb(spark, sf), keep=["uid"]).select("ts", "src", "name", "uid"))


@query("smb_suspicious_files", """
SELECT t AS ts_us, id_orig_h AS src, name, 'exe' AS ext, uid FROM smb WHERE action = 'create' AND name LIKE '%.exe'""",
       ["smb"])
def smb_suspicious_files(spark, sf):
    found = lateral.suspicious_files(bind.smb(spark, sf), keep=["uid"])
    return plain(found.select("ts", "src", "name", "ext", "uid"))


@query("smb_ransomware_files", """
SELECT t AS ts_us, id_orig_h AS src, name, 'locked' AS ext, uid FROM smb WHERE action = 'create' AND name LIKE '%.locked'""",
       ["smb"])
def smb_ransomware_files(spark, sf):
    found = lateral.ransomware_files(bind.smb(spark, sf), keep=["uid"])
    return plain(found.select("ts", "src", "name", "ext", "uid"))


@query("rdp_external", f"""
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, uid, 'External RDP from ' || id_orig_h || ' to ' || id_resp_h
  || ' (cookie=' || cookie || ')' AS detail FROM rdp WHERE NOT {LOCAL.format('id_orig_h')}""", ["rdp"])
def rdp_external(spark, sf):
    return plain(lateral.external_rdp(bind.rdp(spark, sf), keep=["uid"]).select("ts", "src", "dst", "uid", "detail"))


@query("rdp_internal", f"""
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, uid FROM rdp WHERE {LOCAL.format('id_orig_h')}""", ["rdp"])
def rdp_internal(spark, sf):
    return plain(lateral.internal_rdp_cookie(bind.rdp(spark, sf), keep=["uid"]).select("ts", "src", "dst", "uid"))


@query("rdp_odd_port", "SELECT t AS ts_us, id_orig_h AS src, id_resp_p, uid FROM rdp WHERE id_resp_p <> 3389", ["rdp"])
def rdp_odd_port(spark, sf):
    return plain(lateral.rdp_odd_port(bind.rdp(spark, sf), keep=["uid"]).select("ts", "src", "id_resp_p", "uid"))


@query("rdp_without_nla", "SELECT t AS ts_us, id_orig_h AS src, uid FROM rdp WHERE security_protocol = 0", ["rdp"])
def rdp_without_nla(spark, sf):
    return plain(lateral.rdp_without_nla(bind.rdp(spark, sf), keep=["uid"]).select("ts", "src", "uid"))


# --- notices and filters -----------------------------------------------------

@query("notice_suppression", f"""
WITH live AS (SELECT src || '-' || note AS key, event_id AS uid, t FROM notices),
{chain("c", "live", 2 * DAY_US)}, {openers("f", "live", "c")}
SELECT t AS ts_us, key AS identifier, uid AS seq FROM f""", ["notices"], recursive=True)
def notice_suppression(spark, sf):
    n = bind.notices(spark, sf).withColumn("identifier", F.concat_ws("-", "src", "note"))
    return plain(notices.suppress(n.select("ts", "identifier", "seq"), 2 * DAY, order=["seq"]))


@query("notice_suppression_calendar", f"""
SELECT src || '-' || note AS identifier, min(t) AS ts_us, arg_min(event_id, (t, event_id)) AS seq FROM notices
GROUP BY 1, t - t % {2 * DAY_US}""", ["notices"])
def notice_suppression_calendar(spark, sf):
    n = bind.notices(spark, sf).withColumn("identifier", F.concat_ws("-", "src", "note"))
    return plain(notices.suppress(n.select("ts", "identifier", "seq"), 2 * DAY, order=["seq"], anchor="calendar"))


@query("allow_list", """
SELECT query, count(*) AS n FROM dns WHERE query NOT IN (SELECT host FROM hosts WHERE page_id % 3 = 0) GROUP BY 1""",
       ["dns", "hosts"])
def allow_list(spark, sf):
    allowed = bind.hosts(spark, sf).where("page_id % 3 = 0")
    left = notices.without_allowed(bind.dns(spark, sf), allowed, "query", "host")
    return left.groupBy("query").agg(F.count("*").alias("n"))


@query("log_filters", """
SELECT uid, id_orig_h, orig_bytes FROM conn WHERE id_resp_h = '203.0.113.10' AND proto = 'tcp' AND id_resp_p = 80
  AND orig_bytes BETWEEN 1000000 AND 50000000 AND ts BETWEEN '2024-01-05' AND '2024-01-20'""", ["conn"])
def log_filters(spark, sf):
    c = filters.by_dst(bind.conn(spark, sf), "203.0.113.10")
    c = filters.by_port(filters.by_proto(c, "TCP"), 80)
    c = filters.by_bytes(filters.by_timeframe(c, "2024-01-05", "2024-01-20"), 1_000_000, 50_000_000)
    return filters.required(c, "id_orig_h").select("uid", "id_orig_h", "orig_bytes")


@query("log_filter_source", """
SELECT uid, id_resp_h FROM conn WHERE id_orig_h = '192.168.0.2' AND t >= epoch_us(TIMESTAMP '2024-01-20')""", ["conn"])
def log_filter_source(spark, sf):
    c = filters.by_src(bind.conn(spark, sf), "192.168.0.2")
    return filters.last_hours(c, 240, "2024-01-30").select("uid", "id_resp_h")


@query("alert_filters", """
SELECT event_id AS flow_id, signature, category, severity, signature_id FROM alerts WHERE event_type = 'alert'
  AND signature ILIKE '%nature 1%' AND category ILIKE '%trojan%' AND severity BETWEEN 1 AND 3""", ["alerts"])
def alert_filters(spark, sf):
    a = filters.by_signature(filters.alerts(bind.alert_events(spark, sf)), "nature 1")
    a = filters.by_severity(filters.by_category(a, "trojan"), max_severity=3)
    return a.select("flow_id", "alert.signature", "alert.category", "alert.severity", "alert.signature_id")


@query("alert_filter_ids", """
SELECT event_id AS flow_id, src_ip, dest_ip FROM alerts WHERE signature_id = 9000042 AND dest_ip = '203.0.113.42'""",
       ["alerts"])
def alert_filter_ids(spark, sf):
    a = filters.by_dst_ip(filters.by_sid(bind.alert_events(spark, sf), 9000042), "203.0.113.42")
    return a.select("flow_id", "src_ip", "dest_ip")


@query("event_types", "SELECT event_type, count(*) AS n FROM alerts GROUP BY 1", ["alerts"])
def event_types(spark, sf):
    e = bind.alert_events(spark, sf)
    kinds = [filters.alerts, filters.dns_events, filters.http_events, filters.tls_events, filters.flow_events]
    parts = [kind(e).groupBy("event_type").agg(F.count("*").alias("n")) for kind in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
