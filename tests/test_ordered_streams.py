"""Streams whose files come in any order against the batch operators on the same rows."""

import json
import os
import random

from pyspark.sql import functions as F

from netsift.operators import dns as dns_ops
from netsift.operators import rules
from netsift.streaming import ordered

BASE = 1_700_000_040


def feed(folder, rows, files, far):
    """Rows dealt to files so that neighbours in time come in different files; a last file moves the watermark past all."""
    folder.mkdir()
    parts = [rows[k::files] for k in range(files)]
    random.Random(3).shuffle(parts)
    for k, part in enumerate([*parts, [far], [far]]):
        path = folder / f"{k:03}.json"
        path.write_text("\n".join(map(json.dumps, part)))
        os.utime(path, (1_000_000 + k, 1_000_000 + k))


def read(spark, folder, schema, live):
    reader = spark.readStream.option("maxFilesPerTrigger", 1) if live else spark.read
    return reader.schema(schema).json(str(folder)).withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))


def run(df, path):
    out, chk = path / "out", path / "chk"
    (df.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(chk))
     .trigger(availableNow=True).start().awaitTermination())
    return df.sparkSession.read.parquet(str(out))


def test_all_rule_thresholds_in_one_stream(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        rows.append({"uid": i, "s": BASE + i * 1.5 + rng.random(), "id_orig_h": f"10.0.0.{i % 3}",
                     "id_resp_h": rng.choice(["10.0.0.77", "8.8.8.8", "45.33.32.156"]), "id_resp_p": rng.choice([22, 23, 3389, 6606, 443]),
                     "id_orig_p": 8, "proto": rng.choice(["tcp", "tcp", "icmp"]), "history": rng.choice(["S", "ShADadFf"]), "orig_bytes": rng.randrange(300)})
    rows.append(dict(rows[0], uid=5000, id_orig_h="192.168.1.35", id_resp_h="8.8.8.8"))
    far = {"uid": 10**6, "s": BASE + 10**6, "id_orig_h": "172.16.0.1", "id_resp_h": "9.9.9.9", "id_resp_p": 1, "proto": "udp", "history": "", "orig_bytes": 1}
    feed(tmp_path / "in", rows, 5, far)
    schema = "uid long, s double, id_orig_h string, id_resp_h string, id_resp_p int, id_orig_p int, proto string, history string, orig_bytes long"
    live = run(ordered.rule_alerts({"conn": read(spark, tmp_path / "in", schema, True)}, watermark="1 hour"), tmp_path)
    batch = read(spark, tmp_path / "in", schema, False).where("uid <> 1000000")
    want = rules.alerts({"conn": batch})
    assert live.columns == want.columns
    shape = lambda df: sorted((r.sid, r.table, r.ts, r.src, r.dst, r.uid, r.msg, r.classtype, r.mitre_id) for r in df.collect())
    assert shape(live) == shape(want)
    modes = {r.sid: r.threshold and r.threshold[0] for r in rules.ALL_RULES}
    assert {modes[r.sid] for r in want.select("sid").distinct().collect()} == {"limit", "both", None}


def test_failed_lookup_share_in_a_stream(spark, tmp_path):
    rng = random.Random(2)
    rows = [{"uid": i, "s": BASE + i * 0.4, "id_orig_h": f"h{rng.randrange(2)}", "rcode": 3 if rng.random() < 0.8 else 0} for i in range(3000)]
    rows += [{"uid": 9000 + i, "s": BASE + 5 + i, "id_orig_h": "h0", "rcode": None} for i in range(20)]
    feed(tmp_path / "in", rows, 6, {"uid": 10**6, "s": BASE + 10**6, "id_orig_h": "far", "rcode": 0})
    schema = "uid long, s double, id_orig_h string, rcode int"
    live = run(ordered.nxdomain_ratio(read(spark, tmp_path / "in", schema, True), order=["uid"], watermark="1 hour"), tmp_path)
    want = dns_ops.sensor_nxdomain_ratio(read(spark, tmp_path / "in", schema, False), order=["uid"])
    assert live.columns == want.columns
    assert sorted(map(tuple, live.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert want.count() > 40


def test_state_is_dropped_when_its_window_has_passed(spark, tmp_path):
    """Two bursts far apart: the second starts from nothing, and nothing is held in between."""
    rows = [{"uid": i, "s": BASE + i, "id_orig_h": "a", "rcode": 3} for i in range(19)]
    late = [{"uid": 100 + i, "s": BASE + 50_000 + i, "id_orig_h": "a", "rcode": 3} for i in range(25)]
    (tmp_path / "in").mkdir()
    for k, part in enumerate([rows, [dict(rows[0], id_orig_h="z", s=BASE + 20_000)], [dict(rows[0], id_orig_h="z", s=BASE + 40_000)], late,
                              [dict(rows[0], id_orig_h="z", s=BASE + 10**6)]]):
        path = tmp_path / "in" / f"{k}.json"
        path.write_text("\n".join(map(json.dumps, part)))
        os.utime(path, (1_000_000 + k, 1_000_000 + k))
    live = run(ordered.nxdomain_ratio(read(spark, tmp_path / "in", "uid long, s double, id_orig_h string, rcode int", True), order=["uid"]), tmp_path)
    assert [(r.uid, r.nxdomains, r.queries) for r in live.collect()] == [(120, 21, 21)]
