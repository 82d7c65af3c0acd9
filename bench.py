"""Headline timings: one JSON line.

Each query is run once to warm up and then timed as the median of three whole runs (all rows
collected).  ``beacons_847k`` repeats the beacon search over 847,291 connections derived from the
events table, the size of the published single-machine run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from netsift import local_session  # noqa: E402
from netsift.operators import intervals  # noqa: E402
from netsift.plans import bind, catalog  # noqa: E402

HEADLINE = ["beacons", "interval_analyzer", "volume_exfil", "dns_nxdomain_ratio", "dns_high_entropy", "exfil_alerts",
            "incidents", "unified_scores", "rule_alerts_calendar", "sensor_dns_volume", "geo_ranges", "ecs_conn",
            "panel_top_talkers", "tls_self_signed", "smb_suspicious_files"]
ROWS, KEYS = 847_291, 12_847


def published_size(spark, sf):
    """847,291 connections over 12,847 keys: copies of the events, shifted in time per copy."""
    ev = bind.events(spark, sf).select("event_id", "ts")
    copies = -(-ROWS // max(ev.count(), 1))
    many = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    key = F.pmod(F.xxhash64("event_id", "copy"), F.lit(KEYS))
    spread = many.withColumn("key", key).withColumn(
        "ts", F.timestamp_micros(F.unix_micros("ts") + F.col("copy") * 7_000_000))
    return spread.limit(ROWS).select(
        "ts", F.concat(F.lit("192.168."), F.floor(F.col("key") / 250), F.lit("."), F.col("key") % 250).alias("id_orig_h"),
        F.lit("203.0.113.10").alias("id_resp_h"), F.lit(443).alias("id_resp_p"))


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(3):
        begin = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"))
    catalog.load()
    times = {name: timed(lambda q=catalog.QUERIES[name]: q(spark, sf).collect()) for name in HEADLINE}
    table = f"{os.environ.get('TMPDIR', '/tmp')}/netsift-bench-{os.getpid()}"
    published_size(spark, sf).write.parquet(table)
    conn = spark.read.parquet(table)
    times["beacons_847k"] = timed(lambda: intervals.beacons(conn, max_interval=7200.0).collect())
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "beacon_rows": ROWS,
                      "beacon_rows_per_sec": round(ROWS / times["beacons_847k"])}))


if __name__ == "__main__":
    main()
