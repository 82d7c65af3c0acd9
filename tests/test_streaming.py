import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from netsift.operators import anchored, incidents, intervals, lateral, volume
from netsift.streaming import correlate, ingest, windows

BASE = 1_700_000_040     # event times near the epoch would be late for a stream's first watermark
SCHEMA = "s double, src string, dst string, amount long, seq long"


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    return path


def put(path, lines, at):
    """Write a file with its own modification time: the file source reads oldest first."""
    path.write_text("\n".join(map(json.dumps, lines)))
    os.utime(path, (1_000_000 + at, 1_000_000 + at))


def feed(folder, batches):
    for i, rows in enumerate(batches):
        put(folder / f"{i:03}.json", [dict(zip(("s", "src", "dst", "amount", "seq"), r)) for r in rows], i)


def stamped(df):
    return df.withColumn("ts", F.timestamp_micros(((F.col("s") + BASE) * 1_000_000).cast("long")))


def stream(spark, folder):
    return stamped(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder)))


def batch(spark, folder):
    return stamped(spark.read.schema(SCHEMA).json(str(folder)))


def run(df, tmp_path, mode="append"):
    out, chk = tmp_path / "out", tmp_path / "chk"
    (df.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(chk))
     .outputMode(mode).trigger(availableNow=True).start().awaitTermination())
    return df.sparkSession.read.parquet(str(out))


def synthetic():
    rows = [(i * 7 % 997 + i * 3.0, f"10.0.0.{i % 3}", f"10.1.0.{i % 11}", 1000 * (i % 17), i) for i in range(300)]
    rows.sort()
    return [rows[:100], rows[100:200], rows[200:]]


def test_threshold_counter_equals_batch(spark, folder, tmp_path):
    feed(folder, synthetic())
    live = run(windows.threshold_alerts(stream(spark, folder), F.col("src"), "both", 3, 60, F.col("seq"), "1 hour"), tmp_path)
    want = anchored.numbered(batch(spark, folder), ["src"], "ts", 60, ["seq"]).where("n = 3")
    assert sorted((r.key, r.seq) for r in live.collect()) == sorted((r.src, r.seq) for r in want.collect())
    assert live.count() > 5


def test_running_total_equals_batch(spark, folder, tmp_path):
    feed(folder, synthetic())
    live = run(windows.total_alerts(stream(spark, folder), F.col("src"), F.col("amount"), 50_000, 600, 300, F.col("seq"), "1 hour"),
               tmp_path)
    conn = batch(spark, folder).select("ts", "seq", F.col("src").alias("id_orig_h"), F.lit("8.8.8.8").alias("id_resp_h"),
                                       F.col("amount").alias("orig_bytes"))
    want = volume.sensor_volume_exfil(conn, 50_000, 600, 300, ["seq"])
    assert sorted((r.key, r.seq, int(r.total)) for r in live.collect()) == sorted((r.src, r.seq, r.bytes_out) for r in want.collect())
    assert live.count() > 2


def test_distinct_hosts_equals_batch(spark, folder, tmp_path):
    feed(folder, synthetic())
    live = run(windows.host_alerts(stream(spark, folder), F.col("src"), F.col("dst"), 5, 120, 200, F.col("seq"), "1 hour"), tmp_path)
    conn = batch(spark, folder).select("ts", "seq", F.col("src").alias("id_orig_h"), F.col("dst").alias("id_resp_h"),
                                       F.lit(445).alias("id_resp_p"))
    want = lateral.smb_scan(conn, 5, 120, 200, ["seq"])
    assert sorted((r.key, r.seq, r.hosts) for r in live.collect()) == sorted((r.src, r.seq, r.host_count) for r in want.collect())
    assert live.count() > 2


def test_beacon_stream_equals_batch(spark, folder, tmp_path):
    rows = [(i * 60.0 + (i * i) % 5, "10.0.0.1", "8.8.8.8", 1, i) for i in range(150)]
    feed(folder, [rows[:50], rows[50:51], rows[51:]])
    live = run(windows.beacon_alerts(stream(spark, folder), F.col("src"), seq=F.col("seq"), watermark="6 hours"), tmp_path)
    conn = batch(spark, folder).select("ts", "seq", F.col("src").alias("id_orig_h"), F.col("dst").alias("id_resp_h"),
                                       F.lit(443).alias("id_resp_p"), F.lit("tcp").alias("proto"))
    want = intervals.sensor_beacons(conn, order=["seq"])
    got = sorted((r.seq, r.n, round(r.mean, 6), round(r.cv, 9)) for r in live.collect())
    assert got == sorted((r.seq, r.connection_count, round(r.interval_mean, 6), round(r.interval_cv, 9)) for r in want.collect())
    assert len(got) >= 4


def test_calendar_counts_and_late_rows(spark, folder, tmp_path):
    feed(folder, [[(5.0, "a", "x", 1, 0), (50.0, "a", "x", 2, 1), (65.0, "a", "y", 3, 2)], [(5000.0, "z", "x", 1, 3)],
                  [(5010.0, "z", "x", 1, 3)], [(10.0, "a", "x", 9, 4), (9000.0, "z", "x", 1, 5)]])
    live = run(windows.tumbling_counts(stream(spark, folder), ["src"], "1 minute", "1 minute"), tmp_path)
    got = sorted((r.src, r.start.timestamp() - BASE, r["count"]) for r in live.collect())
    assert got == [("a", 0.0, 2), ("a", 60.0, 1), ("z", 4980.0, 2)]     # the late row at 10 s is not counted


def test_stream_suppression(spark, folder, tmp_path):
    feed(folder, [[(0.0, "a", "x", 1, 0), (5.0, "a", "x", 1, 1), (6.0, "b", "x", 1, 2)]])
    df = stream(spark, folder).withColumn("identifier", F.col("src"))
    assert run(windows.suppress(df), tmp_path).count() == 2


def test_ingest_and_running_incidents(spark, tmp_path, folder):
    events = [{"timestamp": f"2024-06-15T08:{m:02}:00Z", "flow_id": m, "event_type": "alert", "src_ip": src,
               "alert": {"signature": "x", "severity": sev}} for m, src, sev in ((1, "h1", 1), (2, "h1", 1), (3, "h2", 3))]
    put(folder / "a.json", events[:1], 0)
    put(folder / "b.json", events[1:], 1)
    normal = incidents.from_alerts(ingest.stream_events(spark, str(folder), files_per_batch=1))
    out = str(tmp_path / "scores")
    correlate.upsert(correlate.running_scores(normal), out, f"incidents-{uuid.uuid4()}").awaitTermination()
    rows = correlate.current(spark.read.parquet(out)).collect()
    assert [(r.src, r.threat_score, r.alerts_seen, r.verdict) for r in rows] == [("h1", 80, 2, "CRITICAL")]


def test_stream_log(spark, folder, tmp_path):
    (folder / "a.json").write_text(json.dumps({"ts": 10.5, "uid": "u", "id.orig_h": "10.0.0.1", "query": "a.b"}))
    rows = run(ingest.stream_log(spark, str(folder), "dns"), tmp_path).collect()
    assert [(r.uid, r.id_orig_h, r.ts.timestamp()) for r in rows] == [("u", "10.0.0.1", 10.5)]
