"""Events with undeclared fields, and TSV logs as a stream."""

import json

import pytest
from pyspark.sql import functions as F

from netsift.operators import ecs
from netsift.sources import alerts, logs
from netsift.streaming import ingest, tsv

EVENTS = [
    {"timestamp": "2024-06-15T08:23:11.482Z", "flow_id": 1, "event_type": "alert", "vlan": [3, 4],
     "alert": {"severity": "2", "signature": "A", "metadata": {"tag": ["x"]}}},
    {"flow_id": "7", "event_type": "fileinfo", "fileinfo": {"filename": "a.exe", "sha256": "ff", "size": 12},
     "http": {"hostname": "h", "length": "bad", "xff": "1.1.1.1"}},
    {"flow_id": 3, "event_type": "stats", "stats": {"decoder": {"pkts": 9}}, "dns": "odd", "tls": None},
    {"flow_id": 4, "event_type": "tls", "tls": {"ja3": {"hash": "h", "extra_hash": "g"}}},
    {"flow_id": 5, "event_type": "flow", "src_port": "x"},
]
LEFT = {1: {"vlan": [3, 4], "alert": {"metadata": {"tag": ["x"]}}},
        7: {"fileinfo": {"filename": "a.exe", "sha256": "ff", "size": 12}, "http": {"xff": "1.1.1.1"}},
        3: {"stats": {"decoder": {"pkts": 9}}, "dns": "odd"}, 4: {"tls": {"ja3": {"extra_hash": "g"}}}, 5: None}


@pytest.fixture
def eve(tmp_path):
    path = tmp_path / "eve"
    path.mkdir()
    odd = ["{broken", "", "[1]", "7", '{"flow_id": 6}', '{"event_type": "dns", "flow_id": 8, "flow_id": 9, "new": 1}']
    (path / "eve.json").write_text("\n".join([*map(json.dumps, EVENTS), *odd]))
    return str(path)


def left(df):
    return {r.flow_id: r.left and json.loads(r.left) for r in df.select("flow_id", F.to_json("extra").alias("left")).collect()}


def test_undeclared_fields_are_kept(spark, eve, tmp_path):
    df = alerts.read_events(spark, eve)
    assert left(df) == LEFT | {9: None}        # a field named twice: the last counts, undeclared ones are lost
    rows = {r.flow_id: r for r in df.drop("extra").collect()}
    assert rows[1].alert.severity == 2 and rows[1].timestamp is not None and rows[1].http is None
    assert rows[7].http.hostname == "h" and rows[7].http.length is None
    assert rows[3].dns is None and rows[3].tls is None and rows[4].tls.ja3.hash == "h" and rows[5].src_port is None
    (tmp_path / "array.json").write_text(json.dumps(EVENTS, indent=1))
    assert left(alerts.read_events(spark, str(tmp_path / "array.json"), array_file=True)) == LEFT
    assert alerts.read_events(spark, eve, ["weather"]).count() == 0


def test_undeclared_fields_reach_the_common_schema_and_parquet(spark, eve, tmp_path):
    mapped = ecs.eve_to_ecs(alerts.read_events(spark, eve, ["fileinfo"]))
    assert mapped.select(alerts.field("fileinfo.sha256", column="suricata.eve"),
                         alerts.field("fileinfo.size", "long", "suricata.eve"), "url.domain").first()[:] == ("ff", 12, "h")
    out = str(tmp_path / "store")
    alerts.read_events(spark, eve).write.parquet(out)
    assert left(spark.read.parquet(out)) == LEFT | {9: None}


def test_each_text_is_parsed_once(spark, eve, capsys):
    alerts.read_events(spark, eve).select("flow_id", "alert.severity").explain()
    assert capsys.readouterr().out.count("parseJson") == 1


def test_event_stream_keeps_undeclared_fields(spark, eve, tmp_path):
    out = str(tmp_path / "out")
    (ingest.stream_events(spark, eve).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination())
    assert left(spark.read.parquet(out)) == LEFT | {9: None}


FILES = {
    "conn.1.log": "#separator x\n#fields\tts\tuid\tid.orig_h\torig_bytes\tvlan\n1.5\tA\t10.0.0.1\t7\t9\n2.5\tB\t-\tbad\t-\ntoo\tfew\n#close\n",
    "conn.2.log": "#fields\tuid\tproto\tts\ttags\nC\ttcp\t3.5\tx\nC\ttcp\t3.5\tx\n",
    "conn.3.log": "D\tudp\t4.5\n",
}
COLUMNS = ["ts", "uid", "id_orig_h", "orig_bytes", "proto", "vlan", "tags"]


def shown(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def run(table, lines, name):
    table.feed(lines, name).awaitTermination()


def test_tsv_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for name, body in FILES.items():
        (folder / name).write_text(body)
    table = tsv.TsvTable(spark, str(tmp_path / "table"), "conn", ["vlan", "tags"])
    run(table, tsv.file_lines(spark, str(folder), files_per_batch=1), f"tsv-{tmp_path.name}")
    assert shown(table.rows()) == shown(logs.read_tsv(spark, str(folder), "conn"))
    assert [r.value for r in table.pending().collect()] == ["D\tudp\t4.5"]
    (folder / "conn.4.log").write_text("#fields\tuid\tnew\tnew\nE\tu\tv\n")
    run(table, tsv.file_lines(spark, str(folder)), f"tsv-{tmp_path.name}")
    assert {r.uid: r.other for r in table.rows().collect()} == {"A": {}, "B": {}, "C": {}, "E": {"new": "v"}}


def test_lines_wait_for_their_header(spark, tmp_path):
    """Shipped lines: rows before their header, files interleaved, one line a batch."""
    folder, good = tmp_path / "shipped", tmp_path / "whole"
    folder.mkdir(), good.mkdir()
    lines = [(n, v) for n, body in FILES.items() for v in body.splitlines()]
    for i, (name, value) in enumerate(sorted(lines, key=lambda x: x[1].startswith("#fields"))):
        (folder / f"{i:03}.json").write_text(json.dumps({"file": name, "value": value}))
    for name, body in FILES.items():
        (good / name).write_text(body)
    stream = lambda: spark.readStream.schema("file string, value string").option("maxFilesPerTrigger", 3).json(str(folder))
    table = tsv.TsvTable(spark, str(tmp_path / "table"), "conn", ["vlan", "tags"], parts=2)
    run(table, stream(), f"wait-{tmp_path.name}")
    assert shown(table.rows()) == shown(logs.read_tsv(spark, str(good), "conn"))
    assert len(list((tmp_path / "table" / "pending").iterdir())) <= 2
    before = shown(table.rows())
    last = table._pending()[-1]
    again = spark.createDataFrame([("conn.1.log", "8.5\tZ\t-\t1\t-")], "file string, value string")
    table.add(again, last + 1)
    table.add(again, last + 1)          # the same batch once more
    assert len(shown(table.rows())) == len(before) + 1
    (folder / "999.json").write_text(json.dumps({"file": "conn.2.log", "value": "#fields\tuid\tts"}))
    with pytest.raises(ValueError, match="headers"):
        table.add(spark.read.json(str(folder / "999.json")).select("file", "value"), last + 2)
