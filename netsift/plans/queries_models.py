"""Classifier and outlier queries; trained on the tables they score, so they have no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift.functions import text
from netsift.operators import dga, ecs, iforest, intervals
from netsift.plans import bind
from netsift.plans.catalog import query
from netsift.plans.shape import plain
from netsift.sources import alerts, logs


def _labelled(spark, sf):
    """Page hosts as ordinary names, hash-made names of the same hosts as generated ones."""
    hosts = bind.hosts(spark, sf).select("host", "page_id").distinct()
    made = F.concat(F.substring(F.md5(F.concat("host", F.col("page_id").cast("string"))), 1, 14), F.lit(".biz"))
    return (hosts.select(F.col("host").alias("domain"), F.lit(0).alias("label")).distinct()
            .unionByName(hosts.select(made.alias("domain"), F.lit(1).alias("label"))))


def _mixed_dns(spark, sf):
    """DNS log in which every tenth query asks for a hash-made name."""
    dns = bind.dns(spark, sf)
    made = F.concat(F.substring(F.md5(F.col("uid").cast("string")), 1, 14), F.lit(".biz"))
    return dns.withColumn("query", F.when(F.col("uid") % 10 == 0, made).otherwise(F.col("query")))


LIST = "list_sum(list_transform({0}, lambda c: {1}))"
CHARS = "string_split(sub, '')"
PAIRS = "list_transform(range(1, len(sub)), lambda i: substr(sub, i, 2))"
COUNT = "(len(sub) - len(replace(sub, '{0}', '')))"


def _deviation_sql() -> str:
    from netsift.constants import ENGLISH_LETTERS

    return " + ".join(f"abs({COUNT.format(k)} / letters - {v})" for k, v in ENGLISH_LETTERS.items())


@query("domain_features", f"""
WITH names AS (SELECT DISTINCT host AS domain FROM hosts
  UNION SELECT substr(md5(host || page_id), 1, 14) || '.biz' FROM hosts),
d AS (SELECT domain, string_split(domain, '.')[1] AS sub,
        len(regexp_replace(string_split(domain, '.')[1], '[^a-z]', '', 'g'))::DOUBLE AS letters,
        len(regexp_replace(string_split(domain, '.')[1], '[^aeiou]', '', 'g'))::DOUBLE AS vowels,
        len(regexp_replace(string_split(domain, '.')[1], '[^0-9]', '', 'g')) AS digits FROM names),
ch AS (SELECT domain, sub, c, count(*) AS n FROM (SELECT domain, sub, unnest({CHARS}) AS c FROM d) GROUP BY ALL),
e AS (SELECT domain, -sum(n / len(sub)::DOUBLE * log2(n / len(sub)::DOUBLE)) AS entropy, count(*) AS kinds FROM ch GROUP BY domain),
pos AS (SELECT domain, unnest(range(1, len(sub) + 1)) AS i, sub FROM d),
brk AS (SELECT domain, i, substr(sub, i, 1) AS c, i - row_number() OVER (PARTITION BY domain, substr(sub, i, 1) ORDER BY i) AS g FROM pos),
run AS (SELECT domain, max(n) AS r FROM (SELECT domain, count(*) AS n FROM brk GROUP BY domain, c, g) GROUP BY domain)
SELECT domain, len(domain)::INT AS domain_length, len(sub)::INT AS subdomain_length, round(entropy, 6) AS entropy,
  round(CASE WHEN letters = 0 THEN 0 ELSE (letters - vowels) / letters END, 6) AS cv_ratio,
  round(digits / len(sub)::DOUBLE, 6) AS digit_ratio,
  round(len(regexp_replace(sub, '[^0-9a-f]', '', 'g')) / len(sub)::DOUBLE, 6) AS hex_ratio,
  round(CASE WHEN len(sub) < 2 THEN 1 ELSE len(list_filter({PAIRS}, lambda p: NOT regexp_matches(p, '^[a-z][a-z]$')))
    / (len(sub) - 1)::DOUBLE END, 6) AS ngram_score,
  round(CASE WHEN letters = 0 THEN 0 ELSE {_deviation_sql()} END, 6) AS char_freq_deviation,
  (len(domain) - len(replace(domain, '.', '')))::INT AS dot_count,
  (len(domain) - len(replace(domain, '-', '')))::INT AS hyphen_count, (digits > 0)::INT AS has_digits,
  CASE WHEN r >= 2 THEN r ELSE 0 END::INT AS max_run_length, round(kinds / len(sub)::DOUBLE, 6) AS unique_char_ratio
FROM d JOIN e USING (domain) JOIN run USING (domain)""", ["hosts"])
def domain_features(spark, sf):
    return plain(dga.with_features(_labelled(spark, sf).select("domain").distinct(), "domain"))


def _bigram_sql() -> str:
    from netsift.constants import ENGLISH_BIGRAMS

    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in ENGLISH_BIGRAMS.items())
    return f"list_sum(list_transform({PAIRS}, lambda p: CASE p {cases} ELSE 0 END))"


@query("label_features", f"""
WITH names AS (SELECT DISTINCT host AS domain FROM hosts
  UNION SELECT substr(md5(host || page_id), 1, 14) || '.biz' FROM hosts),
d AS (SELECT domain, string_split(domain, '.')[1] AS sub,
        len(regexp_replace(string_split(domain, '.')[1], '[^a-z]', '', 'g'))::DOUBLE AS letters,
        len(regexp_replace(string_split(domain, '.')[1], '[^aeiou]', '', 'g'))::DOUBLE AS vowels,
        len(regexp_replace(string_split(domain, '.')[1], '[^0-9]', '', 'g')) AS digits FROM names),
ch AS (SELECT domain, sub, c, count(*) AS n FROM (SELECT domain, sub, unnest({CHARS}) AS c FROM d) GROUP BY ALL),
e AS (SELECT domain, -sum(n / len(sub)::DOUBLE * log2(n / len(sub)::DOUBLE)) AS entropy, count(*) AS kinds FROM ch GROUP BY domain)
SELECT domain, len(sub)::INT AS length, round(entropy, 4) AS entropy,
  round(CASE WHEN vowels = 0 THEN letters ELSE (letters - vowels) / vowels END, 4) AS cv_ratio,
  round(round((CASE WHEN len(sub) < 2 THEN 0 ELSE {_bigram_sql()} / (len(sub) - 1) END)::DECIMAL(20,8), 4), 3)::DOUBLE AS bigram_score,
  round(digits / len(sub)::DOUBLE, 4) AS digit_ratio,
  round((len(sub) - len(replace(sub, '-', ''))) / len(sub)::DOUBLE, 4) AS hyphen_ratio,
  round(vowels / len(sub)::DOUBLE, 4) AS vowel_ratio, round(kinds / len(sub)::DOUBLE, 4) AS unique_char_ratio,
  (digits > 0)::INT AS has_digits, (sub LIKE '%-%')::INT AS has_hyphens,
  (len(domain) - len(replace(domain, '.', '')))::INT AS num_dots,
  CASE WHEN domain LIKE '%.biz' THEN 1.0 WHEN domain LIKE '%.net' OR domain LIKE '%.org' THEN 0.5
       WHEN domain LIKE '%.com' THEN 0.1 ELSE 0.7 END::DOUBLE AS tld_risk
FROM d JOIN e USING (domain)""", ["hosts"])
def label_features(spark, sf):
    found = plain(dga.with_features(_labelled(spark, sf).select("domain").distinct(), "label"))
    return found.withColumn("bigram_score", F.round("bigram_score", 3))


@query("dga_detect")
def dga_detect(spark, sf):
    model, _ = dga.train(_labelled(spark, sf), "domain")
    return dga.detect(_mixed_dns(spark, sf), model)


@query("dga_metrics")
def dga_metrics(spark, sf):
    model, held = dga.train(_labelled(spark, sf), "domain")
    return dga.metrics(model, held)


@query("dga_classify")
def dga_classify(spark, sf):
    model, _ = dga.train(_labelled(spark, sf), "label")
    names = _mixed_dns(spark, sf).select(F.lower("query").alias("domain")).distinct()
    return dga.classify(names, model)


@query("isolation_forest")
def isolation_forest(spark, sf):
    conn = bind.conn(spark, sf)
    model = iforest.fit(intervals.pair_features(conn))
    return iforest.detect(conn, model)


@query("string_functions", r"""
SELECT page_id, string_split(host, '.')[1] AS first_label, lower(host) AS host,
  CASE WHEN regexp_matches(split_part(split_part(url, '?', 1), '#', 1), '^[a-z]+://[^/]+/.*[.][^./]+$')
    THEN lower(string_split(url, '.')[-1]) ELSE lower(string_split(url, '.')[-1]) END AS ext,
  regexp_matches(md5(url), '^[A-Za-z0-9+/]{20,}={0,2}$') AS hash_like, len(url)::INT AS length FROM hosts""", ["hosts"])
def string_functions(spark, sf):
    h = bind.hosts(spark, sf)
    return h.select("page_id", text.first_label("host").alias("first_label"), F.lower("host").alias("host"),
                    text.extension("url").alias("ext"), text.base64_like(F.md5("url")).alias("hash_like"),
                    F.length("url").alias("length"))


@query("cert_names", """
SELECT subject, string_split(subject, 'CN=')[2] AS cn, count(*) AS n FROM ssl GROUP BY ALL""", ["ssl"])
def cert_names(spark, sf):
    return bind.ssl(spark, sf).groupBy("subject", text.cert_common_name("subject").alias("cn")).agg(F.count("*").alias("n"))


@query("document_entropy", r"""
WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents),
n AS (SELECT doc_id, ch, count(*) AS n FROM c GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS total FROM n GROUP BY doc_id)
SELECT doc_id, round(CASE WHEN text IS NOT NULL THEN coalesce(e, 0) END, 6) AS entropy FROM documents LEFT JOIN
  (SELECT doc_id, -sum(n / total::DOUBLE * log2(n / total::DOUBLE)) AS e FROM n JOIN t USING (doc_id) GROUP BY doc_id) USING (doc_id)""")
def document_entropy(spark, sf):
    docs = bind.table(spark, sf, "documents")
    return plain(docs.select("doc_id", text.text_entropy("text").alias("entropy")))


# --- reading text into types -------------------------------------------------

@query("log_coercion", """
SELECT event_id, CASE WHEN k % 9 <> 0 THEN t END AS ts_us, CASE WHEN k % 7 <> 0 THEN k END AS id_resp_p,
  CASE WHEN k % 5 <> 0 THEN event_id * 10 END AS orig_bytes, round(value, 6) AS duration, k % 2 = 0 AS local_orig,
  CASE WHEN k % 3 <> 0 THEN 'x' || k END AS extra FROM ev""", ["ev"])
def log_coercion(spark, sf):
    ev, k = bind.events(spark, sf), F.col("k")
    unset = lambda cond, c: F.nullif(F.when(cond, c).otherwise("-"), F.lit("-"))
    seconds = F.format_string("%d.%06d", F.floor(F.unix_micros("ts") / 1_000_000), F.unix_micros("ts") % 1_000_000)
    raw = {"ts": unset(k % 9 != 0, seconds), "id.resp_p": F.when(k % 7 != 0, k.cast("string")).otherwise("seven"),
           "orig_bytes": unset(k % 5 != 0, (F.col("event_id") * 10).cast("string")),
           "duration": F.col("value").cast("string"), "local_orig": F.when(k % 2 == 0, "T").otherwise("F"),
           "extra": unset(k % 3 != 0, F.concat(F.lit("x"), k.cast("string")))}
    found = plain(ev.select("event_id", *logs.coerce(raw, "conn")))
    return found.withColumn("id_resp_p", F.col("id_resp_p").cast("long"))


@query("alert_coercion", """
SELECT event_id AS flow_id, CASE WHEN k % 9 <> 0 THEN t - t % 1000 END AS timestamp_us,
  CASE WHEN k % 4 <> 0 THEN k END AS severity, 9000000 + k AS signature_id FROM ev""", ["ev"])
def alert_coercion(spark, sf):
    ev, k = bind.events(spark, sf), F.col("k")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    raw = ev.select(
        F.when(k % 9 != 0, stamp).otherwise("never").alias("timestamp"), F.col("event_id").alias("flow_id"),
        F.struct(F.when(k % 4 != 0, k.cast("string")).otherwise("high").alias("severity"),
                 (9000000 + k).cast("string").alias("signature_id")).alias("alert"))
    return plain(alerts.coerce(raw).select("flow_id", "timestamp", "alert.severity", "alert.signature_id"))


def _event_texts(spark, sf):
    """One JSON event per row of events, with fields that the reader does not declare, at the top and inside declared objects."""
    k, i = F.col("k"), F.col("event_id")
    kind = F.col("event_type")
    obj = lambda when, **fields: F.when(kind == when, F.struct(*[v.alias(n) for n, v in fields.items()]))
    event = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), i.alias("flow_id"), F.col("src").alias("src_ip"),
        bind._by_type("alert", "fileinfo", "http", "tls", "flow").alias("event_type"),
        F.when(k % 3 == 0, F.array(k, k + 1)).alias("vlan"),
        obj("click", signature=F.concat(F.lit("Signature "), k), severity=k.cast("string"),
            metadata=F.struct(F.array(F.concat(F.lit("tag"), k)).alias("tag"))).alias("alert"),
        obj("view", filename=F.concat(F.lit("f"), i, F.lit(".exe")), sha256=F.sha2(i.cast("string"), 256), size=k * 100).alias("fileinfo"),
        obj("error", hostname=F.concat(F.lit("h"), k), status=F.when(k % 2 == 0, "200").otherwise("none"), xff=F.col("src")).alias("http"))
    return bind.events(spark, sf).select(F.to_json(event).alias("value"))


@query("event_fields", """
SELECT event_id AS flow_id, t - t % 1000 AS timestamp_us, CASE event_type WHEN 'click' THEN 'alert' WHEN 'view' THEN 'fileinfo'
    WHEN 'error' THEN 'http' WHEN 'signup' THEN 'tls' ELSE 'flow' END AS event_type,
  CASE WHEN event_type = 'click' THEN 'Signature ' || k END AS signature, CASE WHEN event_type = 'click' THEN k END AS severity,
  CASE WHEN event_type = 'click' THEN 'tag' || k END AS tag, CASE WHEN event_type = 'view' THEN 'f' || event_id || '.exe' END AS filename,
  CASE WHEN event_type = 'view' THEN sha256(event_id::VARCHAR) END AS sha256, CASE WHEN event_type = 'view' THEN k * 100 END AS size,
  CASE WHEN k % 3 = 0 THEN k + 1 END AS vlan, CASE WHEN event_type = 'error' THEN 'h' || k END AS hostname,
  CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 200 END::BIGINT AS status, CASE WHEN event_type = 'error' THEN src END AS xff,
  (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + CASE WHEN event_type = 'view' THEN 1 ELSE 0 END
   + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_extra
FROM ev""", ["ev"])
def event_fields(spark, sf):
    found = alerts.parsed(_event_texts(spark, sf))
    names = F.coalesce(F.size(F.try_variant_get("extra", "$", "map<string,variant>")), F.lit(0)).cast("long")
    return plain(found.select(
        "flow_id", "timestamp", "event_type", "alert.signature", "alert.severity", alerts.field("alert.metadata.tag[0]").alias("tag"),
        alerts.field("fileinfo.filename").alias("filename"), alerts.field("fileinfo.sha256").alias("sha256"),
        alerts.field("fileinfo.size", "long").alias("size"), alerts.field("vlan[1]", "long").alias("vlan"), "http.hostname", "http.status",
        alerts.field("http.xff").alias("xff"), names.alias("n_extra")))


@query("event_files_mapped", """
SELECT src, t - t % 1000 AS ts_us, 'suricata.fileinfo' AS dataset, sha256(event_id::VARCHAR) AS sha256 FROM ev
WHERE event_type = 'view'""", ["ev"])
def event_files_mapped(spark, sf):
    mapped = ecs.eve_to_ecs(alerts.parsed(_event_texts(spark, sf)))
    eve = mapped.select(F.col("source.ip").alias("src"), F.col("`@timestamp`").alias("ts"), F.col("event.dataset").alias("dataset"),
                        F.col("suricata.eve").alias("extra"))
    return plain(eve.select("src", "ts", "dataset", alerts.field("fileinfo.sha256").alias("sha256")).where("sha256 IS NOT NULL"))
