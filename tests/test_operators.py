import math
from collections import Counter

from pyspark.sql import functions as F

from netsift.functions import net, register_sql_functions, text
from netsift.operators import dga, dns, incidents, intervals, lateral, notices, reports, rules, score, volume
from netsift.sources import sinks


def events(spark, seconds, src="192.168.1.5", dst="203.0.113.9", port=443, **more):
    df = spark.createDataFrame([(float(s), i) for i, s in enumerate(seconds)], "s double, uid long")
    df = df.select(F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("ts"), "uid",
                   F.lit(src).alias("id_orig_h"), F.lit(dst).alias("id_resp_h"), F.lit(port).alias("id_resp_p"),
                   F.lit("tcp").alias("proto"))
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def test_beacon_cases(spark):
    b = intervals.beacons(events(spark, range(0, 720, 60))).first()
    assert (b.connection_count, b.interval_mean, b.interval_std, b.cv, b.interval_mad, b.confidence) == (12, 60, 0, 0, 0, 100)
    assert intervals.beacons(events(spark, range(0, 540, 60))).count() == 0
    assert intervals.beacons(events(spark, range(0, 40, 4))).count() == 0
    assert intervals.beacons(events(spark, range(0, 50, 5))).count() == 1


def test_beacon_statistics_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    ts = np.cumsum(rng.integers(50, 71, 400)).astype(float)
    b = intervals.beacons(events(spark, ts.tolist()), slice_seconds=300).first()
    gaps = np.diff(ts)
    med = np.median(gaps)
    assert abs(b.interval_mean - gaps.mean()) < 1e-3 and abs(b.interval_std - gaps.std()) < 1e-3
    assert b.interval_median == med and b.interval_mad == np.median(np.abs(gaps - med))


def test_results_do_not_depend_on_slice_length(spark):
    df = events(spark, [i * 37 + (i * i) % 11 for i in range(300)])
    rows = [intervals.beacons(df, slice_seconds=s).first().asDict() for s in (30, 600, 86400)]
    assert rows[0] == rows[1] == rows[2]


def test_analyzer_gate(spark):
    ten = events(spark, range(0, 600, 60))
    row = intervals.analyze_intervals(ten).first()
    assert (row.confidence_score, row.verdict) == (59.0, "BEACON_MEDIUM")
    assert intervals.predict_intervals(ten).first().is_beacon is False


def test_sensor_beacon_throttles(spark):
    found = intervals.sensor_beacons(events(spark, range(0, 60 * 60, 60)), order=["uid"])
    at = sorted(r.ts.timestamp() for r in found.collect())
    assert at == [540.0, 2340.0]
    assert intervals.sensor_beacons(events(spark, range(0, 600, 60), dst="172.20.1.9")).count() == 0


def test_volume_edges(spark):
    one = events(spark, [0, 10], orig_bytes=52_428_800)
    assert volume.volume_exfil(one).count() == 1
    assert volume.volume_exfil(events(spark, [3590, 3610], orig_bytes=52_428_800)).count() == 0
    assert volume.volume_exfil(events(spark, [0], dst="172.20.1.9", orig_bytes=209_715_200)).count() == 1
    assert volume.volume_exfil(events(spark, [0], dst="172.20.1.9", orig_bytes=209_715_200), mode="cidr").count() == 0
    sensor = volume.sensor_volume_exfil(events(spark, [0, 10, 20, 30, 3700], orig_bytes=60_000_000), order=["uid"])
    assert [(r.uid, r.bytes_out) for r in sensor.collect()] == [(1, 120_000_000)]


def brute_entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values()) if s else 0.0


def test_text_measures(spark):
    names = ["aaaa", "abcd", "", "xjnwabpfbqwmdhe", "aabbbbcd", "a.b.google.com", "google.com", "localhost", "Ab-9_.x"]
    df = spark.createDataFrame([(s,) for s in names], "s string").select(
        "s", text.entropy("s").alias("e"), text.longest_run("s").alias("run"), text.base_domain("s").alias("base"),
        text.subdomain("s").alias("sub"), text.non_letter_bigram_share("s").alias("nl"),
        text.consonant_share("s").alias("cs"), text.consonants_per_vowel("s").alias("cv"), text.tld_risk("s").alias("risk"))
    rows = {r.s: r for r in df.collect()}
    for s in names:
        assert abs(rows[s].e - brute_entropy(s)) < 1e-9
    assert round(rows["xjnwabpfbqwmdhe"].e, 6) == 3.640224
    assert rows["aabbbbcd"].run == 4 and rows["abcd"].run == 0
    assert rows["a.b.google.com"].base == "google.com" and rows["localhost"].base == "localhost"
    assert rows["a.b.google.com"].sub == "a.b" and rows["google.com"].sub == ""
    assert rows[""].nl == 1.0 and rows["abcd"].nl == 0.0 and rows["Ab-9_.x"].nl == 5 / 6
    assert rows["abcd"].cs == 0.75 and rows["abcd"].cv == 3.0 and rows[""].cs == 0.0
    assert rows["google.com"].risk == 0.1 and rows["localhost"].risk == 0.7


def test_locality_geohash_and_sql_functions(spark):
    ips = ["10.1.2.3", "172.16.0.1", "172.20.1.9", "172.32.0.1", "192.168.0.1", "8.8.8.8", "not an ip", None]
    rows = {r.ip: (r.c, r.p) for r in spark.createDataFrame([(i,) for i in ips], "ip string").select(
        "ip", net.is_local_cidr("ip").alias("c"), net.is_local_prefix("ip").alias("p")).collect()}
    assert rows == {"10.1.2.3": (True, True), "172.16.0.1": (True, True), "172.20.1.9": (True, False),
                    "172.32.0.1": (False, False), "192.168.0.1": (True, True), "8.8.8.8": (False, False),
                    "not an ip": (False, False), None: (False, False)}
    spots = spark.createDataFrame([(57.64911, 10.40744), (-25.38271, -49.26559), (90.0, 180.0)], "lat double, lon double")
    assert [r[0] for r in spots.select(net.geohash("lat", "lon", 6)).collect()] == ["u4pruy", "6gkzwg", "zzzzzz"]
    register_sql_functions(spark)
    assert spark.sql("SELECT base_domain('a.b.c'), round(entropy('abcd'), 3), megabytes(1048576)").first() == ("b.c", 2.0, 1.0)


def test_decode_label(spark):
    df = spark.createDataFrame([("aGVsbG8td29ybGQtZWFzdHNpZGUtcHJvamVjdC01.x.net",), ("short.x",), ("a" * 21 + ".x",)], "q string")
    assert [r[0] for r in df.select(text.decode_base64_label("q")).collect()] == [
        "hello-world-eastside-project-5", None, None]


def test_long_url_labels_stay_one_line(spark):
    import base64
    urls = ["https://example.org/" + "a" * 60, "https://x.org/abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").select(
        "page_id", text.base64_text("url").alias("label"))
    assert [r.label for r in df.orderBy("page_id").collect()] == [base64.b64encode(u.encode()).decode() for u in urls]
    named = df.withColumn("query", F.concat("label", F.lit(".exfil.example.org")))
    assert [r.decoded for r in reports.decoded_labels(named).orderBy("page_id").collect()] == urls


def dns_log(spark, rcodes, step=1):
    rows = [(float(i * step), i, r) for i, r in enumerate(rcodes)]
    return spark.createDataFrame(rows, "s double, uid long, rcode long").select(
        F.timestamp_seconds("s").alias("ts"), "uid", F.lit("10.0.0.9").alias("id_orig_h"), "rcode",
        F.when(F.col("rcode") == 3, "NXDOMAIN").otherwise("NOERROR").alias("rcode_name"), F.lit("a.b.org").alias("query"))


def test_nxdomain_edges(spark):
    assert dns.nxdomain_ratio(dns_log(spark, [3] * 14 + [0] * 6)).count() == 1
    assert dns.nxdomain_ratio(dns_log(spark, [3] * 13 + [0] * 6)).count() == 0
    assert dns.sensor_nxdomain_ratio(dns_log(spark, [3] * 14 + [0] * 6), order=["uid"]).count() == 0
    hits = dns.sensor_nxdomain_ratio(dns_log(spark, [3] * 50), order=["uid"]).collect()
    assert sorted((r.uid, r.nxdomains, r.queries) for r in hits) == [(20, 21, 21), (41, 21, 21)]


def test_query_volume_restarts_after_alert(spark):
    hits = dns.sensor_query_volume(dns_log(spark, [0] * 250, 0.1), order=["uid"]).collect()
    assert sorted(r.uid for r in hits) == [100, 201]


def test_smb_scan_counts_new_hosts(spark):
    rows = [(i * 10.0, f"10.0.0.{i % 6}") for i in range(12)]
    conn = spark.createDataFrame(rows, "s double, id_resp_h string").select(
        F.timestamp_seconds("s").alias("ts"), F.lit("10.1.1.1").alias("id_orig_h"), "id_resp_h", F.lit(445).alias("id_resp_p"))
    hit = lateral.smb_scan(conn).collect()
    assert [(r.ts.timestamp(), r.host_count) for r in hit] == [(40.0, 5)]


def sample_events(spark):
    rows = [("192.168.1.55", "A", 1), ("192.168.1.42", "B", 1), ("192.168.1.78", "C", 2), ("192.168.1.55", "D", 1),
            ("192.168.1.33", "E", 1), ("192.168.1.42", "F", 2)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "flow_id long, src_ip string, sig string, sev long").select(
        "flow_id", F.timestamp_seconds("flow_id").alias("timestamp"), F.lit("alert").alias("event_type"), "src_ip",
        F.struct(F.col("sig").alias("signature"), F.col("sev").alias("severity")).alias("alert"))


def test_incident_from_sample_alerts(spark):
    found = incidents.correlate(None, sample_events(spark)).collect()
    assert [(r.src_ip, r.threat_score, r.verdict, r.alert_count) for r in found] == [("192.168.1.55", 80, "CRITICAL", 2)]


def test_incident_score_counts_repeats_but_lists_once(spark):
    notes = [("C2_Beaconing_Detected",), ("Module::C2_Beaconing_Detected",), ("C2_Beaconing_Detected",), ("Odd",)]
    df = spark.createDataFrame(notes, "note string").select(
        F.monotonically_increasing_id().alias("seq"), F.timestamp_seconds(F.lit(5)).alias("ts"), F.lit("10.0.0.1").alias("src"),
        "note", F.lit("m").alias("msg"))
    r = incidents.correlate(df, None).first()
    assert (r.threat_score, r.alert_count, r.mitre_ttps) == (100, 2, ["T1071.001"])
    p = incidents.payloads(incidents.correlate(df, None), F.lit(0)).first()
    assert p.severity == 1 and "**Threat Score:** 100/100" in p.description and p.tags[-1] == "T1071.001"
    assert p.observables[0].data == "10.0.0.1"


def test_suppression_edges(spark):
    df = events(spark, [0, 1800, 3600, 3700]).select("ts", "uid", F.lit("x").alias("identifier"))
    assert sorted(r.uid for r in notices.suppress(df, order=["uid"]).collect()) == [0, 2]
    assert sorted(r.uid for r in notices.suppress(df, order=["uid"], anchor="calendar").collect()) == [0, 2]


def test_rule_inventory_and_payload_rules(spark):
    assert len(rules.ALL_RULES) == 48 and len({r.sid for r in rules.ALL_RULES}) == 48
    http = events(spark, [0, 1], src="203.0.113.9", dst="10.0.0.5", status_code=200, method="GET", uri="/x", host="h",
                  user_agent="ua", request_body_len=0, request_body="", file_data="iex (New-Object x).downloadstring('u')")
    conn = events(spark, [0], port=4444, history="ShAD", id_orig_p=5000, orig_bytes=1, payload="exec /BIN/sh -i")
    ftp = events(spark, [0, 1, 400], port=21, command="stor")
    found = rules.alerts({"http": http, "conn": conn, "ftp": ftp}).collect()
    got = Counter(r.sid for r in found)
    assert got == {9003008: 2, 9003007: 1, 9002007: 2}
    assert {r.mitre_id for r in found if r.sid == 9002007} == {"T1048.003"}


def test_unified_defaults(spark):
    df = events(spark, range(0, 720, 60), orig_bytes=20_000_000)
    pairs = spark.createDataFrame([("192.168.1.5", "203.0.113.9", "xjnwabpfbqwmdhe.com")], "id_orig_h string, id_resp_h string, domain string")
    r = score.unified_scores(df, pairs).first()
    assert (r.beacon_score, r.entropy_score, r.volume_score) == (61.0, 4.01, 100.0)
    assert r.unified_score == round(61 * 0.4 + 4.01 * 0.3 + 30, 2) and r.verdict == "MEDIUM"


def test_dga_model_separates_and_round_trips(spark, tmp_path):
    good = [(f"{a}{b}.com", 0) for a in ("water", "green", "house", "mountain", "river", "paper", "garden", "winter")
            for b in ("store", "line", "media", "point", "works", "light")]
    bad = spark.range(60).select(F.concat(F.substring(F.md5(F.col("id").cast("string")), 1, 15), F.lit(".biz")).alias("domain"),
                                 F.lit(1).alias("label"))
    labelled = spark.createDataFrame(good, "domain string, label int").unionByName(bad)
    model, held = dga.train(labelled, trees=10)
    assert dga.metrics(model, held).first().accuracy > 0.9
    assert len(dga.importances(model)) == 13
    dga.save(model, str(tmp_path / "m"))
    log = spark.createDataFrame([("Riverstone.COM",), ("riverstone.com",), ("3f9a1c77be02d4a.biz",)], "query string")
    found = dga.detect(log, dga.load(str(tmp_path / "m"))).collect()
    assert [(r.domain, r.query_count) for r in found] == [("3f9a1c77be02d4a.biz", 1)]


def test_isolation_forest_finds_planted_outlier(spark, tmp_path):
    from netsift.operators import iforest

    rows = spark.range(300).select(
        F.concat(F.lit("s"), "id").alias("src"), F.lit("d").alias("dst"),
        *[(F.when(F.col("id") == 7, 500.0).otherwise(0.0) + F.rand(i) * 10).alias(f) for i, f in enumerate(iforest.FEATURES)])
    model = iforest.fit(rows, trees=30)
    model.save(str(tmp_path / "f"))
    back = iforest.IsolationForest.load(spark, str(tmp_path / "f"))
    worst = back.score(rows).orderBy("anomaly_score").first()
    assert worst.src == "s7" and back.cutoff == model.cutoff
    assert iforest.fit(rows, trees=30).cutoff == model.cutoff


def test_beacon_report_file(spark, tmp_path):
    found = intervals.beacons(events(spark, range(0, 720, 60)))
    sinks.write_beacon_report(found, str(tmp_path / "r"))
    body = "\n".join(r.value for r in spark.read.text(str(tmp_path / "r")).collect())
    assert "| 1 | 192.168.1.5 | 203.0.113.9 | 443 | 12 | 60.0s | 0.0000 | **100.0%** |" in body
    assert reports.confidence_bands(found).first().band == "Critical"


def test_text_entropy_counts_each_code_point_once(spark):
    texts = [None, "", "aaaa", "abab", "ab\U0001F600\U0001F600" * 500 + "é", "".join(map(chr, range(0x400, 0x600))) * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.e for r in df.orderBy("doc_id").select(text.text_entropy("text").alias("e")).collect()]
    plain = [r.e for r in df.orderBy("doc_id").select(text.entropy("text").alias("e")).collect()]
    expect = [None, 0.0, 0.0, 1.0] + [-sum(c / len(t) * math.log2(c / len(t)) for c in Counter(t).values()) for t in texts[4:]]
    assert got[:4] == expect[:4] and all(abs(g - e) < 1e-9 for g, e in zip(got[4:], expect[4:]))
    assert got[:4] == plain[:4] and abs(got[5] - plain[5]) < 1e-9
