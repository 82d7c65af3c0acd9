import random

import pytest
from pyspark.sql import functions as F

from netsift.operators.anchored import anchored_windows, numbered, throttle


def brute(xs, width, end=None):
    """win_start per position of one sorted series."""
    out, start = [], 0 if end is not None else None
    for x in xs:
        if end is None or x >= end:
            start, end = x, x + width
        out.append(start)
    return out


def series(seed):
    rnd = random.Random(seed)
    data = {}
    for key in range(12):
        span, count = rnd.choice([(50, 200), (5_000, 400), (200_000, 300), (3_000_000, 60)])
        data[f"k{key}"] = sorted(rnd.randrange(span) for _ in range(count))
    return data


@pytest.mark.parametrize("width", [7, 100])
def test_windows_equal_brute_force(spark, width):
    data = series(width)
    rows = [(k, x, i) for k, xs in data.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "key string, x long, i long").repartition(5)
    got = {(r.key, r.i): (r.win_start, r.win_first)
           for r in anchored_windows(df, ["key"], "x", width, ["i"]).collect()}
    assert len(got) == len(rows)
    for k, xs in data.items():
        want, seen = brute(xs, width), set()
        for i, (x, s) in enumerate(zip(xs, want)):
            assert got[k, i] == (s, s not in seen)
            seen.add(s)


def test_chain_starts_open_for_running_totals(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for k in range(5):
        total, xs = 0, []
        for i in range(300):
            total += rnd.randrange(40)
            xs.append(total)
            rows.append((k, total, i))
        want[k] = brute(xs, 1000, end=1000)
    df = spark.createDataFrame(rows, "key int, x long, i int")
    out = anchored_windows(df, ["key"], "x", 1000, ["i"], opens_at_width=True).collect()
    assert len(out) == 1500
    for r in out:
        assert r.win_start == want[r.key][r.i]
    firsts = sorted((r.key, r.x) for r in out if r.win_first)
    assert firsts == sorted({(k, s) for k in want for s in want[k] if s})


def test_width_may_differ_by_key(spark):
    df = spark.createDataFrame([("a", 0), ("a", 5), ("a", 9), ("b", 0), ("b", 5), ("b", 20)], "k1 string, x long")
    w = F.when(F.col("k1") == "a", 5).otherwise(20)
    out = anchored_windows(df, ["k1"], "x", w)
    assert sorted((r.k1, r.x, r.win_start) for r in out.collect()) == [
        ("a", 0, 0), ("a", 5, 5), ("a", 9, 5), ("b", 0, 0), ("b", 5, 0), ("b", 20, 20)]


def at(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s int")
    return df.select(F.lit("10.0.0.1").alias("src"), F.timestamp_seconds("s").alias("ts"), "s")


def test_threshold_edges(spark):
    limit = numbered(at(spark, [0, 10, 299, 300]), ["src"], "ts", 300).where("n <= 1")
    assert sorted(r.s for r in limit.collect()) == [0, 300]
    both = numbered(at(spark, [0, 30, 59, 61, 70]), ["src"], "ts", 60).where("n = 3")
    assert [r.s for r in both.collect()] == [59]
    shifted = at(spark, [50, 65, 80])
    assert [r.s for r in numbered(shifted, ["src"], "ts", 60).where("n = 3").collect()] == [80]
    assert numbered(shifted, ["src"], "ts", 60, anchor="calendar").where("n = 3").count() == 0


def test_throttle_keeps_spacing(spark):
    kept = throttle(at(spark, [0, 30, 60, 61, 119, 121]), ["src"], "ts", 60)
    assert sorted(r.s for r in kept.collect()) == [0, 60, 121]
    strict = throttle(at(spark, [0, 30, 60, 61, 119, 121]), ["src"], "ts", 60, strict=True)
    assert sorted(r.s for r in strict.collect()) == [0, 61]


def test_same_result_without_broadcast_joins(spark):
    """Large tables join by sort-merge; groups must stay whole there too."""
    data = series(5)
    rows = [(k, x, i) for k, xs in data.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "key string, x long, i long").repartition(5)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = anchored_windows(df, ["key"], "x", 50, ["i"])
        got = {(r.key, r.i): r.win_start for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {(k, i): s for k, xs in data.items() for i, s in enumerate(brute(xs, 50))}
    assert "SortMergeJoin" in plan
