"""The driver's tables seen as network logs.

Each function reads one or two tables and projects them into a log shape; ``VIEWS``
holds the same projections as SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SRC = "concat('192.168.', user_id div 250, '.', user_id % 250 + 1)"

VIEWS: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def with_views(names: list[str], body: str, recursive: bool = False) -> str:
    """Prefix an oracle query with the view definitions it uses."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    body = body.strip()
    joined = f"{ctes},\n{body[5:]}" if body[:5].upper() == "WITH " else f"{ctes}\n{body}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{joined}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


VIEWS["ev"] = """
  SELECT event_id, event_type, value, user_id, epoch_us(ts) AS t, ts,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         '192.168.' || (user_id // 250) || '.' || (user_id % 250 + 1) AS src
  FROM events"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "event_type", "value", "user_id", F.col("ts").cast("timestamp").alias("ts"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("k"), F.expr(SRC).alias("src"))


VIEWS["conn"] = """
  SELECT event_id AS uid, ts, t, src AS id_orig_h, 49152 + event_id % 16384 AS id_orig_p,
         CASE event_type WHEN 'click' THEN '203.0.113.10' WHEN 'view' THEN '203.0.113.20'
              WHEN 'error' THEN '198.51.100.7' WHEN 'signup' THEN '10.0.0.5' ELSE '172.20.1.9' END AS id_resp_h,
         CASE event_type WHEN 'click' THEN 80 WHEN 'view' THEN 443 WHEN 'error' THEN 6606
              WHEN 'signup' THEN 445 ELSE 3389 END AS id_resp_p,
         CASE WHEN k % 10 = 0 THEN 'udp' ELSE 'tcp' END AS proto, value / 6.1 AS duration,
         CAST(round(value * 1000000) AS BIGINT) AS orig_bytes, k * 1000 AS resp_bytes,
         CASE WHEN event_type = 'error' THEN 'S0' ELSE 'SF' END AS conn_state,
         CASE WHEN event_type = 'error' THEN 'S' ELSE 'ShADadFf' END AS history, k
  FROM ev"""
NEEDS["conn"] = ["ev"]


def _by_type(click, view, error, signup, purchase):
    t = F.col("event_type")
    return (F.when(t == "click", click).when(t == "view", view).when(t == "error", error)
            .when(t == "signup", signup).otherwise(purchase))


def conn(spark: SparkSession, sf: str) -> DataFrame:
    error = F.col("event_type") == "error"
    return events(spark, sf).select(
        F.col("event_id").alias("uid"), "ts", F.col("src").alias("id_orig_h"),
        (49152 + F.col("event_id") % 16384).cast("int").alias("id_orig_p"),
        _by_type("203.0.113.10", "203.0.113.20", "198.51.100.7", "10.0.0.5", "172.20.1.9").alias("id_resp_h"),
        _by_type(80, 443, 6606, 445, 3389).alias("id_resp_p"),
        F.when(F.col("k") % 10 == 0, "udp").otherwise("tcp").alias("proto"),
        (F.col("value") / 6.1).alias("duration"),
        F.round(F.col("value") * 1000000).cast("long").alias("orig_bytes"), (F.col("k") * 1000).alias("resp_bytes"),
        F.when(error, "S0").otherwise("SF").alias("conn_state"),
        F.when(error, "S").otherwise("ShADadFf").alias("history"), "k")


VIEWS["lan"] = """
  SELECT event_id AS uid, ts, t, src AS id_orig_h, '10.0.0.' || k AS id_resp_h,
         CASE event_type WHEN 'click' THEN 445 WHEN 'view' THEN 139 WHEN 'error' THEN 135
              WHEN 'signup' THEN 3389 ELSE 22 END AS id_resp_p,
         'tcp' AS proto, value / 6.1 AS duration, CAST(round(value * 10) AS BIGINT) AS orig_bytes,
         k * 1000 AS resp_bytes, CASE WHEN k % 2 = 0 THEN 'S' ELSE 'ShADadFf' END AS history
  FROM ev"""
NEEDS["lan"] = ["ev"]


def lan(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.col("event_id").alias("uid"), "ts", F.col("src").alias("id_orig_h"),
        F.concat(F.lit("10.0.0."), "k").alias("id_resp_h"), _by_type(445, 139, 135, 3389, 22).alias("id_resp_p"),
        F.lit("tcp").alias("proto"), (F.col("value") / 6.1).alias("duration"),
        F.round(F.col("value") * 10).cast("long").alias("orig_bytes"), (F.col("k") * 1000).alias("resp_bytes"),
        F.when(F.col("k") % 2 == 0, "S").otherwise("ShADadFf").alias("history"))


HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"

VIEWS["hosts"] = f"SELECT page_id, {HOST_SQL} AS host, url FROM pages"
VIEWS["dns"] = """
  SELECT event_id AS uid, ts, t, src AS id_orig_h, '10.0.0.53' AS id_resp_h,
         CASE WHEN k % 20 = 0 THEN 5353 ELSE 53 END AS id_resp_p, 'udp' AS proto, host AS query,
         CASE WHEN event_type = 'purchase' THEN 'TXT' ELSE 'A' END AS qtype_name,
         CASE WHEN event_type IN ('error', 'view') THEN 3 ELSE 0 END AS rcode,
         CASE WHEN event_type IN ('error', 'view') THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode_name
  FROM ev JOIN hosts ON page_id = event_id % (SELECT count(*) FROM pages)"""
NEEDS["dns"] = ["ev", "hosts"]


def hosts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), "url")


def dns(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").count()
    missing = F.col("event_type").isin("error", "view")
    ev = events(spark, sf).withColumn("page_id", F.col("event_id") % pages)
    return ev.join(hosts(spark, sf), "page_id").select(
        F.col("event_id").alias("uid"), "ts", F.col("src").alias("id_orig_h"), F.lit("10.0.0.53").alias("id_resp_h"),
        F.when(F.col("k") % 20 == 0, 5353).otherwise(53).alias("id_resp_p"), F.lit("udp").alias("proto"),
        F.col("host").alias("query"),
        F.when(F.col("event_type") == "purchase", "TXT").otherwise("A").alias("qtype_name"),
        F.when(missing, 3).otherwise(0).cast("long").alias("rcode"),
        F.when(missing, "NXDOMAIN").otherwise("NOERROR").alias("rcode_name"))


VIEWS["http"] = """
  SELECT event_id AS uid, ts, t, src AS id_orig_h, '203.0.113.' || k AS id_resp_h, 80 AS id_resp_p,
         CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END AS method,
         host, regexp_extract(url, '^[a-z]+://[^/?#]+(.*)$', 1) AS uri,
         CASE WHEN k % 7 = 0 THEN 'python-requests/2.31' WHEN k % 7 = 1 THEN 'Go-http-client/1.1'
              WHEN k % 7 = 2 THEN 'curl/8.' || k WHEN k % 7 = 3 THEN 'Mozilla/4.0 (compatible)'
              ELSE 'Mozilla/5.0 (X11) ' || k END AS user_agent,
         CAST(round(value * 100000) AS BIGINT) AS request_body_len, k * 1000 AS response_body_len,
         CASE WHEN event_type = 'error' THEN 404 WHEN k = 0 THEN NULL ELSE 200 END AS status_code
  FROM ev JOIN hosts ON page_id = event_id % (SELECT count(*) FROM pages)"""
NEEDS["http"] = ["ev", "hosts"]


def http(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").count()
    ev = events(spark, sf).withColumn("page_id", F.col("event_id") % pages)
    m = F.col("k") % 7
    agent = (F.when(m == 0, "python-requests/2.31").when(m == 1, "Go-http-client/1.1")
             .when(m == 2, F.concat(F.lit("curl/8."), "k")).when(m == 3, "Mozilla/4.0 (compatible)")
             .otherwise(F.concat(F.lit("Mozilla/5.0 (X11) "), "k")))
    return ev.join(hosts(spark, sf), "page_id").select(
        F.col("event_id").alias("uid"), "ts", F.col("src").alias("id_orig_h"),
        F.concat(F.lit("203.0.113."), "k").alias("id_resp_h"), F.lit(80).alias("id_resp_p"),
        F.when(F.col("event_type") == "purchase", "POST").when(F.col("event_type") == "signup", "PUT")
        .otherwise("GET").alias("method"),
        "host", F.regexp_extract("url", "^[a-z]+://[^/?#]+(.*)$", 1).alias("uri"), agent.alias("user_agent"),
        F.round(F.col("value") * 100000).cast("long").alias("request_body_len"),
        (F.col("k") * 1000).alias("response_body_len"),
        F.when(F.col("event_type") == "error", 404).when(F.col("k") == 0, None).otherwise(200)
        .cast("long").alias("status_code"))


VIEWS["ssl"] = """
  SELECT o_orderkey AS uid, o_orderdate AS ts, epoch_us(o_orderdate) AS t,
         '192.168.' || (o_custkey // 250) % 250 || '.' || (o_custkey % 250 + 1) AS id_orig_h,
         49152 + o_orderkey % 16384 AS id_orig_p,
         CASE WHEN o_orderkey % 3 = 0 THEN '10.1.1.1' ELSE '203.0.113.' || o_orderkey % 200 END AS id_resp_h,
         CASE o_orderstatus WHEN 'F' THEN 443 WHEN 'O' THEN 8443 ELSE 6606 END AS id_resp_p,
         md5(c_mktsegment) AS ja3, 'CN=' || c_mktsegment AS subject,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'CN=' || c_mktsegment
              WHEN o_orderpriority = '1-URGENT' THEN 'DigiCert CA' ELSE 'CN=CA' END AS issuer,
         CASE WHEN o_orderkey % 5 <> 0 THEN lower(c_mktsegment) || '.example.com' END AS server_name,
         o_orderdate - to_days(CAST(o_orderkey % 1500 AS INTEGER)) AS not_valid_before,
         o_orderdate + to_days(CAST(o_custkey % 400 - 40 AS INTEGER)) AS not_valid_after
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def ssl(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
    ts = F.col("o_orderdate").cast("timestamp")
    return joined.select(
        F.col("o_orderkey").alias("uid"), ts.alias("ts"),
        F.expr("concat('192.168.', (o_custkey div 250) % 250, '.', o_custkey % 250 + 1)").alias("id_orig_h"),
        (49152 + F.col("o_orderkey") % 16384).cast("int").alias("id_orig_p"),
        F.when(F.col("o_orderkey") % 3 == 0, "10.1.1.1")
        .otherwise(F.expr("concat('203.0.113.', o_orderkey % 200)")).alias("id_resp_h"),
        F.when(F.col("o_orderstatus") == "F", 443).when(F.col("o_orderstatus") == "O", 8443)
        .otherwise(6606).alias("id_resp_p"),
        F.md5("c_mktsegment").alias("ja3"), F.concat(F.lit("CN="), "c_mktsegment").alias("subject"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("CN="), "c_mktsegment"))
        .when(F.col("o_orderpriority") == "1-URGENT", "DigiCert CA").otherwise("CN=CA").alias("issuer"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lower("c_mktsegment"), F.lit(".example.com")))
        .alias("server_name"),
        F.expr("cast(o_orderdate as timestamp) - make_dt_interval(cast(o_orderkey % 1500 as int))")
        .alias("not_valid_before"),
        F.expr("cast(o_orderdate as timestamp) + make_dt_interval(cast(o_custkey % 400 - 40 as int))")
        .alias("not_valid_after"))


VIEWS["smb"] = """
  SELECT l_orderkey * 10 + l_linenumber AS uid, l_shipdate AS ts, epoch_us(l_shipdate) AS t,
         '192.168.1.' || l_suppkey % 250 AS id_orig_h, '10.0.0.' || l_partkey % 5 AS id_resp_h, 445 AS id_resp_p,
         CASE l_returnflag WHEN 'A' THEN 'write' WHEN 'N' THEN 'create' ELSE 'pipe' END AS action,
         CASE WHEN p_size % 5 = 4 THEN '\\\\srv\\ADMIN$\\PSEXESVC.exe'
              ELSE p_name || CASE p_size % 5 WHEN 0 THEN '.exe' WHEN 1 THEN '.locked' WHEN 2 THEN '' ELSE '.TXT' END
         END AS name,
         CASE WHEN l_linenumber = 1 THEN 'PSEXESVC' WHEN l_linenumber = 2 THEN 'svcctl' END AS named_pipe,
         CASE WHEN l_linenumber = 3 THEN 'ADMIN$' END AS tree
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


def smb(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.expr("l_partkey = p_partkey"))
    size = F.col("p_size") % 5
    suffix = F.when(size == 0, ".exe").when(size == 1, ".locked").when(size == 2, "").otherwise(".TXT")
    line = F.col("l_linenumber")
    return joined.select(
        (F.col("l_orderkey") * 10 + line).alias("uid"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.expr("concat('192.168.1.', l_suppkey % 250)").alias("id_orig_h"),
        F.expr("concat('10.0.0.', l_partkey % 5)").alias("id_resp_h"), F.lit(445).alias("id_resp_p"),
        F.when(F.col("l_returnflag") == "A", "write").when(F.col("l_returnflag") == "N", "create")
        .otherwise("pipe").alias("action"),
        F.when(size == 4, "\\\\srv\\ADMIN$\\PSEXESVC.exe").otherwise(F.concat("p_name", suffix)).alias("name"),
        F.when(line == 1, "PSEXESVC").when(line == 2, "svcctl").alias("named_pipe"),
        F.when(line == 3, "ADMIN$").alias("tree"))


VIEWS["rdp"] = """
  SELECT event_id AS uid, ts, t,
         CASE WHEN k % 3 = 0 THEN '198.51.100.' || user_id % 250 ELSE src END AS id_orig_h,
         '10.0.0.' || k % 7 AS id_resp_h, CASE WHEN k % 11 = 0 THEN 13389 ELSE 3389 END AS id_resp_p,
         'user' || user_id AS cookie, k % 4 AS security_protocol, value / 6.1 AS duration,
         CAST(round(value * 20) AS BIGINT) AS orig_bytes
  FROM ev"""
NEEDS["rdp"] = ["ev"]


def rdp(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.col("event_id").alias("uid"), "ts",
        F.when(F.col("k") % 3 == 0, F.expr("concat('198.51.100.', user_id % 250)")).otherwise(F.col("src"))
        .alias("id_orig_h"),
        F.expr("concat('10.0.0.', k % 7)").alias("id_resp_h"),
        F.when(F.col("k") % 11 == 0, 13389).otherwise(3389).alias("id_resp_p"),
        F.concat(F.lit("user"), "user_id").alias("cookie"), (F.col("k") % 4).alias("security_protocol"),
        (F.col("value") / 6.1).alias("duration"), F.round(F.col("value") * 20).cast("long").alias("orig_bytes"))


VIEWS["notices"] = """
  SELECT event_id, t, src, CASE event_type WHEN 'click' THEN 'C2_Beaconing_Detected'
         WHEN 'view' THEN 'C2_JA3_Suspicious' WHEN 'error' THEN 'DNS_High_NXDOMAIN_Ratio' ELSE 'Other_Notice' END AS note
  FROM ev"""
NEEDS["notices"] = ["ev"]


def notices(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.col("event_id").alias("seq"), "ts", "src",
        _by_type("C2_Beaconing_Detected", "C2_JA3_Suspicious", "DNS_High_NXDOMAIN_Ratio", "Other_Notice",
                 "Other_Notice").alias("note"),
        F.concat(F.lit("notice "), "event_id").alias("msg"))


VIEWS["alerts"] = """
  SELECT event_id, t, ts, src AS src_ip, '203.0.113.' || k AS dest_ip, 'Signature ' || k AS signature,
         9000000 + k AS signature_id, CASE WHEN k % 4 = 0 THEN 'Trojan Activity' WHEN k % 4 = 1 THEN 'Policy Violation'
         WHEN k % 4 = 2 THEN 'Trojan Download' ELSE 'Attempted Recon' END AS category,
         CAST(k % 5 + 1 AS BIGINT) AS severity,
         CASE event_type WHEN 'click' THEN 'alert' WHEN 'view' THEN 'dns' WHEN 'error' THEN 'http'
              WHEN 'signup' THEN 'tls' ELSE 'flow' END AS event_type
  FROM ev"""
NEEDS["alerts"] = ["ev"]


def alert_events(spark: SparkSession, sf: str) -> DataFrame:
    """Alert-engine events with the nested ``alert`` struct, as the JSON source gives them."""
    m = F.col("k") % 4
    category = (F.when(m == 0, "Trojan Activity").when(m == 1, "Policy Violation")
                .when(m == 2, "Trojan Download").otherwise("Attempted Recon"))
    return events(spark, sf).select(
        F.col("event_id").alias("flow_id"), F.col("ts").alias("timestamp"),
        _by_type("alert", "dns", "http", "tls", "flow").alias("event_type"), F.col("src").alias("src_ip"),
        F.lit(50000).alias("src_port"), F.concat(F.lit("203.0.113."), "k").alias("dest_ip"),
        F.lit(443).alias("dest_port"), F.lit("TCP").alias("proto"),
        F.struct(F.lit("allowed").alias("action"), F.concat(F.lit("Signature "), "k").alias("signature"),
                 (9000000 + F.col("k")).alias("signature_id"), category.alias("category"),
                 (F.col("k") % 5 + 1).cast("long").alias("severity")).alias("alert"))


VIEWS["geo"] = """
  SELECT CAST(203 AS BIGINT) * 16777216 + 113 * 256 + n_nationkey * 4 AS ip_start,
         CAST(203 AS BIGINT) * 16777216 + 113 * 256 + n_nationkey * 4 + 3 AS ip_end, n_name AS country,
         CAST(n_nationkey * 7 - 80 AS DOUBLE) AS lat, CAST(n_nationkey * 14 - 170 AS DOUBLE) AS lon
  FROM nation"""


def geo(spark: SparkSession, sf: str) -> DataFrame:
    start = F.lit(203 * 16777216 + 113 * 256).cast("long") + F.col("n_nationkey") * 4
    return table(spark, sf, "nation").select(
        start.alias("ip_start"), (start + 3).alias("ip_end"), F.col("n_name").alias("country"),
        (F.col("n_nationkey") * 7 - 80).cast("double").alias("lat"),
        (F.col("n_nationkey") * 14 - 170).cast("double").alias("lon"))
