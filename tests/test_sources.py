import json
from datetime import datetime

from pyspark.sql import functions as F

import pytest

from netsift.operators import ecs, filters
from netsift.sources import alerts, logs, sinks, store, wordlists

HEADER = "#separator \\x09\n#fields\tts\tuid\tid.orig_h\tid.orig_p\tid.resp_h\tid.resp_p\tproto\torig_bytes\tlocal_orig\tnew_col\n" \
         "#types\ttime\tstring\taddr\tport\taddr\tport\tenum\tcount\tbool\tstring\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_tsv_header_types_and_dropped_lines(spark, tmp_path):
    body = ("1718439791.482000\tC1\t10.0.0.1\t5000\t8.8.8.8\t53\tudp\t120\tT\tx\n"
            "1718439792.000001\tC2\t10.0.0.2\t-\t8.8.8.8\t53\tudp\tbad\tF\t-\n"
            "too\tfew\n#close\t2024\n")
    df = logs.read_log(spark, write(tmp_path / "conn.log", HEADER + body))
    assert dict(df.dtypes) == {"ts": "timestamp", "uid": "string", "id_orig_h": "string", "id_orig_p": "int",
                               "id_resp_h": "string", "id_resp_p": "int", "proto": "string", "orig_bytes": "bigint",
                               "local_orig": "boolean", "new_col": "string"}
    a, b = df.orderBy("uid").withColumn("us", F.unix_micros("ts")).collect()
    assert (a.us, a.orig_bytes, a.local_orig, a.new_col) == (1718439791482000, 120, True, "x")
    assert (b.us, b.id_orig_p, b.orig_bytes, b.local_orig, b.new_col) == (1718439792000001, None, None, False, None)


def test_tsv_files_may_differ_in_columns(spark, tmp_path):
    write(tmp_path / "conn.1.log", "#fields\tts\tuid\n1.5\tA\n")
    write(tmp_path / "conn.2.log", "#fields\tuid\tproto\tts\nB\ttcp\t2.5\n")
    df = logs.read_tsv(spark, str(tmp_path / "conn.*.log"), "conn")
    assert sorted((r.uid, r.proto) for r in df.collect()) == [("A", None), ("B", "tcp")]


def test_json_lines_and_rejects(spark, tmp_path):
    lines = [json.dumps({"ts": 1718439791.482, "uid": "C1", "id.orig_h": "10.0.0.1", "id.resp_p": 53, "query": "a.b.c",
                         "AA": True, "rcode": 3}), "{broken", json.dumps({"ts": "oops", "uid": "C2"})]
    path = write(tmp_path / "dns.log", "\n".join(lines) + "\n")
    rows = {r.uid: r for r in logs.read_log(spark, path).withColumn("us", F.unix_micros("ts")).collect()}
    assert set(rows) == {"C1", "C2"}
    assert (rows["C1"].us, rows["C1"].id_resp_p, rows["C1"].AA, rows["C1"].rcode) == (1718439791482000, 53, True, 3)
    assert rows["C2"].us is None
    good, bad = logs.read_json_with_rejects(spark, path, "dns")
    assert good.count() == 2 and [r.line for r in bad.collect()] == ["{broken"]


EVENTS = [
    {"timestamp": "2024-06-15T08:23:11.482Z", "flow_id": 1, "event_type": "alert", "src_ip": "192.168.1.55", "src_port": 1,
     "dest_ip": "45.33.32.156", "dest_port": 80, "alert": {"signature": "A", "signature_id": 9000001, "severity": 1,
                                                          "category": "Trojan Activity"}},
    {"timestamp": "nonsense", "flow_id": 2, "event_type": "dns", "src_ip": "192.168.1.42", "dns": {"rrname": "x.org", "id": "q"}},
    {"timestamp": "2024-06-15T08:23:12.000Z", "flow_id": 3, "event_type": "weather"},
]


def test_events_array_and_lines(spark, tmp_path):
    array = write(tmp_path / "array.json", json.dumps(EVENTS))
    lines = write(tmp_path / "eve.json", "\n".join(map(json.dumps, EVENTS)))
    for df in (alerts.read_events(spark, array, array_file=True), alerts.read_events(spark, lines)):
        rows = {r.flow_id: r for r in df.collect()}
        assert set(rows) == {1, 2}
        assert rows[1].alert.signature_id == 9000001 and rows[1].dest_port == 80 and rows[1].dns is None
        assert rows[2].timestamp is None and rows[2].dns.id is None
    only = alerts.read_alerts(spark, lines)
    assert only.count() == 1 and filters.by_severity(only).count() == 1
    assert filters.by_signature(only, "^a$").count() == 1
    assert filters.by_signature(only, "^a$", case_sensitive=True).count() == 0
    assert "alert.signature" in ecs.flatten(only).columns
    mapped = ecs.eve_to_ecs(only).select("event.dataset", "event.kind", "rule.name", "source.ip").first()
    assert tuple(mapped) == ("suricata.alert", "alert", "A", "192.168.1.55")
    assert alerts.read_events(spark, lines, max_rows=1).count() == 1


def test_store_scan_pushes_filters(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-01' + make_dt_interval(0, id) AS ts, concat('10.0.0.', id) AS src, "
                   "IF(id % 2 = 0, 'a', NULL) AS tag, id AS big FROM range(100)")
    path = str(tmp_path / "store")
    store.write_store(df, path, "zeek.conn")
    store.write_store(df, path, "zeek.dns")
    out = store.scan_store(spark, path, "zeek.conn", 24, datetime(2024, 1, 5, 0), ["ts", "src"], exists=["tag"])
    assert out.columns == ["ts", "src"]
    assert out.count() == 14        # even hours from 72 to 99
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "day#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "IsNotNull(tag)" in plan and "GreaterThanOrEqual(ts" in plan
    assert "big" not in plan.split("ReadSchema")[1]
    assert store.scan_store(spark, path, "zeek.dns", 24, datetime(2024, 1, 5, 0), max_rows=3).count() == 3


def test_word_lists_and_sinks(spark, tmp_path):
    good = write(tmp_path / "good.txt", "# comment\n\nexample.com\n  spaced.org \n")
    bad = write(tmp_path / "bad.txt", "qxzkw.biz\n")
    rows = sorted((r.domain, r.label) for r in wordlists.labelled(spark, good, bad).collect())
    assert rows == [("example.com", 0), ("qxzkw.biz", 1), ("spaced.org", 0)]
    out = str(tmp_path / "out")
    sinks.write_json(wordlists.read_words(spark, good, 0), out)
    assert spark.read.json(out).count() == 2
    sinks.write_parquet(wordlists.read_words(spark, good, 0), out + "-p")
    assert spark.read.parquet(out + "-p").count() == 2


def test_every_loader(spark, tmp_path):
    for name in ("conn", "dns", "http", "ssl", "notice", "files", "weird"):
        path = write(tmp_path / f"{name}.log", "#fields\tts\tuid\n1.5\tA\n")
        assert getattr(logs, name)(spark, path).first().uid == "A"


def test_formats_are_decided_per_file(spark, tmp_path):
    write(tmp_path / "conn.1.log", "#fields\tts\tuid\tproto\n1.5\tA\ttcp\n")
    write(tmp_path / "conn.2.log", '{"ts": 2.5, "uid": "B", "proto": "udp", "vlan": 7, "tags": ["x", "y"]}\n')
    write(tmp_path / "conn.3.log", "#fields\tts\tproto\tuid\n3.5\ticmp\tC\n")
    rows = {r.uid: r for r in logs.read_log(spark, str(tmp_path / "conn.*.log"), "conn").collect()}
    assert {u: r.proto for u, r in rows.items()} == {"A": "tcp", "B": "udp", "C": "icmp"}
    assert rows["B"].vlan == "7" and json.loads(rows["B"].tags) == ["x", "y"] and rows["A"].tags is None


def test_two_headers_in_one_file_are_refused(spark, tmp_path):
    path = write(tmp_path / "conn.log", "#fields\tts\tuid\tproto\n1.5\tA\ttcp\n#fields\tts\tproto\tuid\n2.5\tudp\tB\n")
    with pytest.raises(ValueError, match="headers"):
        logs.read_tsv(spark, path)


def test_tsv_lines_are_not_shuffled(spark, tmp_path, capsys):
    path = write(tmp_path / "conn.log", "#fields\tts\tuid\tproto\n1.5\tA\ttcp\n")
    logs.read_tsv(spark, path).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_alert_table_keeps_all_and_ranks_critical_first(spark):
    from netsift.operators import reports

    rows = [(f"t{i}", s, "h", "d") for i, s in enumerate(["LOW", "MEDIUM", "CRITICAL", "HIGH"] * 400)]
    alerts = spark.createDataFrame(rows, "type string, severity string, src string, detail string").repartition(7)
    table = reports.alert_table(alerts).orderBy("rank").collect()
    assert [r["rank"] for r in table] == list(range(1, 1601))
    order = [r.line.split(" | ")[2] for r in table]
    assert order == ["CRITICAL"] * 400 + ["HIGH"] * 400 + ["MEDIUM"] * 400 + ["LOW"] * 400
