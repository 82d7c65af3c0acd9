"""One key with all rows: windows, restarts, first meetings and medians against plain loops, and no task with all rows."""

import bisect
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.operators import anchored, dns, lateral, medians


def plain_ratio(missed, limit, least, bad=0, total=0):
    hits = []
    for i, m in enumerate(missed):
        bad, total = bad + bool(m), total + 1
        if total > least and bad * limit.denominator > limit.numerator * total:
            hits.append((i, bad, total))
            bad = total = 0
    return hits, bad, total


def test_ratio_pieces_equal_a_plain_count():
    rng = np.random.default_rng(0)
    for _ in range(400):
        missed, before = (rng.random(int(rng.integers(k, 60))) < rng.random() for k in (1, 0))
        least, limit = int(rng.integers(0, 8)), Fraction(str(rng.choice([0.5, 0.7, 0.33])))
        _, bad, total = plain_ratio(before, limit, least)
        want = plain_ratio(missed, limit, least, bad, total)
        assert dns.ratio_hits(missed, limit, least, bad, total) == want
        p, q = limit.numerator, limit.denominator
        level = p * total - q * bad
        at, up, left, size = dns._cell_summary(np.cumsum(np.where(missed, q - p, -p)), missed, least, max(level, p * least))
        fit = np.flatnonzero((up > level) & (at >= least - total))
        got = (left[fit[0]], size[fit[0]]) if len(fit) else (bad + missed.sum(), total + len(missed))
        assert tuple(map(int, got)) == want[1:]


@pytest.mark.parametrize("share", [0.72, 0.9, 1.0])
def test_one_source_floods_one_window(spark, share):
    n = 200_000
    rows = spark.range(n).select(
        F.lit("10.0.0.1").alias("id_orig_h"), F.timestamp_micros(F.lit(1_700_000_040_000_000) + F.col("id") * 1000).alias("ts"), F.col("id").alias("seq"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(1000)) < int(share * 1000), 3).otherwise(0).alias("rcode"))
    got = [(r.seq, r.nxdomains, r.queries) for r in dns.sensor_nxdomain_ratio(rows, order=["seq"]).orderBy("seq").collect()]
    missed = [r.rcode == 3 for r in rows.orderBy("seq").collect()]
    assert got == plain_ratio(missed, Fraction("0.7"), 20)[0] and len(got) > 10


def test_quiet_start_then_failures(spark):
    """The level carried into a cell can be far below zero."""
    bits = [0] * 3000 + [3] * 9000 + [0, 3] * 500
    rows = spark.createDataFrame([("s", 1_700_000_040 + i / 50, i, b) for i, b in enumerate(bits)], "id_orig_h string, s double, seq long, rcode int")
    rows = rows.withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    got = [(r.seq, r.nxdomains, r.queries) for r in dns.sensor_nxdomain_ratio(rows, order=["seq"]).orderBy("seq").collect()]
    assert got == plain_ratio([b == 3 for b in bits], Fraction("0.7"), 20)[0]


def test_counts_of_a_flooded_window(spark):
    n = 100_000
    rows = spark.range(n).select(F.lit("k").alias("k"), F.col("id"), F.timestamp_micros(F.lit(1_700_000_040_000_000) + F.col("id") * 500).alias("ts"))
    found = anchored.numbered(rows, ["k"], "ts", 60, ["id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k#" not in plan and plan.count("_cell") > 0     # no window over (key, win_start) on rows
    assert found.where("n <> id + 1").count() == 0 and found.count() == n
    few = anchored.numbered(rows, ["k"], "ts", 60, ["id"], at_most=50)
    assert sorted(r.id for r in few.collect()) == list(range(50))
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()
    # null keys are a key of their own
    loose = spark.createDataFrame([(None, 1, 0.0), (None, 2, 1.0), ("a", 3, 5.0)], "k string, id long, s double").withColumn(
        "ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    assert sorted((r.id, r.n) for r in anchored.numbered(loose, ["k"], "ts", 60, ["id"]).collect()) == [(1, 1), (2, 2), (3, 1)]


def test_hosts_of_a_flooded_window(spark):
    conn = spark.range(60_000).select(
        F.lit("10.0.0.9").alias("id_orig_h"), F.concat(F.lit("10.1."), F.col("id") % 7, F.lit("."), (F.col("id") / 1000).cast("int")).alias("id_resp_h"),
        F.lit(445).alias("id_resp_p"), F.col("id").alias("seq"), F.timestamp_micros(F.lit(1_700_000_040_000_000) + F.col("id") * 20_000).alias("ts"))
    got = [(r.seq, r.host_count) for r in lateral.smb_scan(conn, 20, 180, 60, ["seq"]).orderBy("seq").collect()]
    want, opened, hosts, last = [], None, set(), None
    for i in range(60_000):
        us = i * 20_000
        if opened is None or us >= opened + 180_000_000:
            opened, hosts = us, set()
        hosts.add((i % 7, i // 1000))
        if len(hosts) >= 20 and (last is None or us - last >= 60_000_000):
            last = us
            want.append((i, len(hosts)))
    assert got == want and len(want) >= 1


def plain_medians(values):
    before, out = [], []
    for v in values:
        n = len(before)
        out.append(None if not n else (before[(n - 1) // 2] + before[n // 2]) / 2)
        bisect.insort(before, v)
    return out


@pytest.mark.parametrize("block", [8, 64, 4096])
def test_growing_medians(spark, block, monkeypatch):
    monkeypatch.setattr(medians, "BLOCK", block)
    rng = np.random.default_rng(block)
    series = {"a": rng.integers(1, 5, 700), "b": rng.integers(0, 10**9, 500), None: np.arange(300)[::-1] ** 2, "d": np.repeat(7, 90), "e": np.array([3])}
    rows = [(k, int(i * 3 + (i > 100) * 500), int(v)) for k, s in series.items() for i, v in enumerate(s)]
    df = spark.createDataFrame(rows, "k string, at long, v long")
    got = {(r.k, r["at"]): r.m for r in medians.growing_median(df, ["k"], "at", "v", "m").collect()}
    want = {(k, at): m for k, s in series.items() for (_, at, _), m in zip([r for r in rows if r[0] == k], plain_medians(s.tolist()))}
    assert got == want


def test_a_long_series(spark):
    """200,000 buckets of one source in seconds."""
    import time

    rows = spark.range(200_000).select(F.lit("s").alias("k"), F.col("id").alias("at"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"))
    begin = time.perf_counter()
    got = [r.m for r in medians.growing_median(rows, ["k"], "at", "v", "m").orderBy("at").collect()]
    assert time.perf_counter() - begin < 90
    assert got == plain_medians([r.v for r in rows.orderBy("at").collect()])
