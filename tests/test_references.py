"""Indicators in texts, crowded address ranges and tables that streams fold, against plain versions."""

import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from netsift.operators import enrich, incidents, score, textmatch
from netsift.streaming import merged

BASE = 1_700_000_040


def plain_occurrences(text, kind, value):
    form = (lambda s: s.translate({c: c + 32 for c in range(65, 91)})) if kind in textmatch.FOLDED else (lambda s: s)
    t, v = form(text), form(value)
    return [i for i in range(len(t) - len(v) + 1) if t[i:i + len(v)] == v and textmatch.confirmed(kind, text, i, i + len(v))]


@pytest.mark.parametrize("piece_bytes", [8 << 20, 100])
def test_indicators_in_texts(spark, piece_bytes):
    listed = [("domain", "evil.com"), ("domain", "sub.evil.com"), ("domain", "aaa"), ("ip", "1.2.3.4"), ("ip", "11.2.3.4"), ("hash", "abcdef0123456789"),
              ("hash", "0123456789"), ("url", "http://evil.com/a"), ("url", "http://evil.com/a/b"), ("domain", None), ("domain", "")]
    texts = ["see http://evil.com/a/b and http://evil.com/a.", "EVIL.com SUB.evil.COM notevil.com evil.com.br evil.com.", "1.2.3.4 11.2.3.4 1.2.3.45 0.1.2.3.4 1.2.3.4.",
             "ABCDEF0123456789 xabcdef0123456789 0123456789", "aaa aaaa aaa-aaa (aaa)", "é😀 evil.com 😀", "http://evil.com/a", '"http://EVIL.com/a"', None, "", "x" * 300_000 + " evil.com"]
    df = spark.createDataFrame([(i, t, "v") for i, t in enumerate(texts)], "id long, text string, ioc_value string")
    ind = spark.createDataFrame([(k, v, f"f{i}", "r", None) for i, (k, v) in enumerate(listed)], "type string, value string, family string, role string, confidence string")
    got = sorted((r.id, r.start, r.ioc_type, r.ioc_value, r.ioc_family) for r in textmatch.indicators_in(df, ind, ["id"], "text", piece_bytes=piece_bytes).collect())
    want = sorted((i, at, k, v, f"f{n}") for i, t in enumerate(texts) if t for n, (k, v) in enumerate(listed) if v for at in plain_occurrences(t, k, v))
    assert got == want and len(want) > 15
    assert textmatch.indicators_in(df, ind.where("false"), ["id"], "text").count() == 0


def test_a_crowded_block_of_ranges(spark):
    rng = random.Random(4)
    cuts = sorted(rng.sample(range(10 << 24, (10 << 24) + 3 * 65536), 40_000))
    ranges = [(a, b - 1 - (k % 3), f"c{k % 250}", float(k), 0.5) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b - 1 - (k % 3) >= a]
    ranges += [(20 << 24, (23 << 24) - 1, "wide", 1.0, 2.0)]
    ips = [rng.randrange(10 << 24, (10 << 24) + 3 * 65536) for _ in range(20_000)] + [(21 << 24) + 5, (23 << 24), 5]
    text = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    rows = [(i, text(n), None if i % 7 == 0 else text(ips[0])) for i, n in enumerate(ips)]     # one address holds most rows of a column
    conn = spark.createDataFrame(rows, "uid long, id_resp_h string, id_orig_h string")
    table = spark.createDataFrame(ranges, "ip_start long, ip_end long, country string, lat double, lon double")
    import bisect
    starts = [r[0] for r in ranges]

    def place(n):
        k = bisect.bisect_right(starts, n) - 1
        return ranges[k][2] if k >= 0 and ranges[k][1] >= n else None

    got = {r.uid: (r.dst_geo_country, r.src_geo_country) for r in enrich.locate_both(conn, table).collect()}
    assert got == {i: (place(n), None if i % 7 == 0 else place(ips[0])) for i, n in enumerate(ips)}


def test_baseline_joined_in_the_plan(spark):
    benign = spark.createDataFrame([("mailserver",), ("intranet",), ("short",), ("fileshare1",)], "label string")
    names = spark.createDataFrame([("xk2j9qpl4z.example.com",), ("www.example.com",), ("aabbccddee.net",)], "domain string")
    base = score.entropy_baseline(benign, "label")
    numbers = tuple(base.first())
    assert score.entropy_domains(names, threshold=2.0, baseline=base).collect() == score.entropy_domains(names, threshold=2.0, baseline=numbers).collect()


def test_folded_table_stays_small_and_equals_batch(spark, tmp_path):
    rng = random.Random(6)
    rows = [(f"h{rng.randrange(5)}", BASE + rng.randrange(9000), i, rng.choice(["C2_Beaconing_Detected", "Mod::LM_Auth_Spray", "Other"]), f"m{i}") for i in range(400)]
    notices = spark.createDataFrame(rows, "src string, s long, seq long, note string, msg string").withColumn("ts", F.timestamp_seconds("s"))
    alerts = incidents.from_notices(notices)
    table = merged.incident_table(spark, str(tmp_path / "t"), parts=3)
    assert table.current() is None
    batches = [incidents.kinds(alerts.where(f"pmod(xxhash64(seq), 12) = {k}"), 3600) for k in range(12)]
    for k, batch in enumerate(batches):
        table.add(batch, k)
        table.add(batch, k)             # a batch that comes again
        assert len([n for n in os.listdir(tmp_path / "t") if n.startswith(("part", "base"))]) <= 2 * 3 + 2
    assert len(os.listdir(tmp_path / "t" / "_manifest")) <= 6      # two manifests and their checksums
    shape = lambda df: sorted((r.src, r.bucket, r.threat_score, r.alert_count, r.verdict, tuple(a.seq for a in r.alerts), tuple(r.mitre_ttps)) for r in df.collect())
    assert shape(merged.incidents_now(table)) == shape(incidents.score_sources(alerts, bucket_seconds=3600))


def test_streams_feed_folded_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(5):
        lines = [{"src": f"h{i % 2}", "s": BASE + i * 60 - k * 7, "seq": 10 * k + i, "note": "C2_JA3_Suspicious", "msg": "m"} for i in range(6)]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(map(json.dumps, lines)))
    schema = "src string, s long, seq long, note string, msg string"
    read = lambda reader: reader.schema(schema).json(str(tmp_path / "in")).withColumn("ts", F.timestamp_seconds("s"))
    live = read(spark.readStream.option("maxFilesPerTrigger", 1))
    table = merged.incident_table(spark, str(tmp_path / "t"), parts=2)
    merged.feed_incidents(table, incidents.from_notices(live), f"i-{uuid.uuid4()}").awaitTermination()
    want = incidents.score_sources(incidents.from_notices(read(spark.read)))
    assert sorted(map(str, merged.incidents_now(table).drop("bucket").collect())) == sorted(map(str, want.collect()))
    base = merged.baseline_table(spark, str(tmp_path / "b"), parts=2)
    merged.feed_baseline(base, live, "note", f"b-{uuid.uuid4()}").awaitTermination()
    mine, whole = merged.baseline_now(base).first(), score.entropy_baseline(read(spark.read), "note").first()
    assert abs(mine[0] - whole[0]) < 1e-9 and abs(mine[1] - whole[1]) < 1e-6
