"""Regularity of the gaps between a key's events, and the beacon detectors built on it.

A busy pair may hold a large part of all events, so gaps are taken inside
(key, time slice) partitions and only the slice edges are joined up per key.  Everything a
detector needs but the medians merges from slice summaries; medians are computed for the keys
that passed every other gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.functions.net import outbound
from netsift.operators.anchored import throttle, time_windows

PAIR = ["id_orig_h", "id_resp_h"]
TRIPLE = ["id_orig_h", "id_resp_h", "id_resp_p"]
SLICE_SECONDS = 600


def _timed(df: DataFrame, keys: list[str], ts: str, slice_seconds: int) -> DataFrame:
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    # explicit null filters: joins on these columns then add none of their own, and both reads of the
    # shuffle by (key, slice) stay identical, so that Spark runs it once
    rows = df.select(*keys, t.alias("t")).withColumn("slice", F.expr(f"t div {slice_seconds * 1_000_000}L"))
    for c in [*keys, "t", "slice"]:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def _key_slices(timed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (key, slice) with the gap across its leading edge and the totals of the key.

    The rows are shuffled once, by (key, slice); only the slice summaries are shuffled by key.
    """
    in_slice = Window.partitionBy(*keys, "slice").orderBy("t")
    along = Window.partitionBy(*keys).orderBy("slice")
    whole = Window.partitionBy(*keys)
    gap = F.col("gap") / 1e6
    edges = timed.withColumn("gap", F.col("t") - F.lag("t").over(in_slice)).groupBy(*keys, "slice").agg(
        F.count("*").alias("s_n"), F.min("t").alias("t_first"), F.max("t").alias("t_last"),
        F.count("gap").alias("s_gaps"), F.avg(gap).alias("s_mean"), F.var_pop(gap).alias("s_var"),
        F.min(gap).alias("s_min"), F.max(gap).alias("s_max"))
    totals = (edges.withColumn("seam", F.col("t_first") - F.lag("t_last").over(along))
              .withColumn("n", F.sum("s_n").over(whole)).withColumn("from_us", F.min("t_first").over(whole))
              .withColumn("to_us", F.max("t_last").over(whole)))
    seam = F.col("seam") / 1e6
    mean = F.try_divide((F.col("to_us") - F.col("from_us")) / 1e6, (F.col("n") - 1).cast("double"))
    spread = (F.coalesce(F.col("s_gaps") * (F.col("s_var") + F.pow(F.col("s_mean") - F.col("mean"), 2)), F.lit(0.0))
              + F.coalesce(F.pow(seam - F.col("mean"), 2), F.lit(0.0)))
    var = F.try_divide(F.sum(spread).over(whole), (F.col("n") - 1).cast("double"))
    return (totals.withColumn("mean", mean).withColumn("var", var)
            .withColumn("min", F.min(F.least("s_min", seam)).over(whole))
            .withColumn("max", F.max(F.greatest("s_max", seam)).over(whole))
            .select(*keys, "slice", "seam", "n", (F.col("n") - 1).alias("n_gaps"), "mean", "var",
                    F.sqrt("var").alias("std"), "min", "max", "from_us", "to_us"))


def gap_stats(df: DataFrame, keys: list[str], ts: str = "ts", slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Per key: n events, n_gaps, mean, var and std (population), min, max in seconds, from_us, to_us."""
    slices = _key_slices(_timed(df, keys, ts, slice_seconds), keys)
    return slices.where("seam IS NULL").drop("slice", "seam")   # the first slice of each key


def _cv(mean: Column, std: Column, when_zero: float) -> Column:
    return F.when(mean > 0, std / mean).otherwise(F.lit(when_zero))


def _gap_medians(timed: DataFrame, slices: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """Exact median gap and median absolute deviation (seconds) of the keys in ``slices``.

    Equal gaps are counted before anything is gathered by key: a key of time span T has at most
    sqrt(2T) distinct gap lengths, a few million microsecond values in a year, however many rows it has.
    """
    group = [*keys, *carry]
    in_slice = Window.partitionBy(*keys, "slice").orderBy("t")
    gap = F.coalesce(F.col("t") - F.lag("t").over(in_slice), F.col("seam"))
    rows = timed.join(slices.select(*group, "slice", "seam"), [*keys, "slice"]).withColumn("gap", gap)
    counts = rows.where("gap IS NOT NULL").groupBy(*group, "gap").agg(F.count("*").alias("c"))
    whole = Window.partitionBy(*keys)

    def so_far(col: str) -> Column:
        return F.sum("c").over(whole.orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow))

    low, high = F.expr("n div 2"), F.expr("(n - 1) div 2 + 1")   # the middle ranks among n - 1 gaps

    def middle(col: str, cum: str, pick) -> Column:
        return (pick(F.when(F.col(cum) >= low, F.col(col))) + pick(F.when(F.col(cum) >= high, F.col(col)))) / 2

    centred = counts.withColumn("cum", so_far("gap")).withColumn(
        "median", middle("gap", "cum", lambda c: F.min(c).over(whole)))
    deviating = (centred.withColumn("dev", F.abs(F.col("gap") - F.col("median")))
                 .withColumn("cum_dev", so_far("dev")))
    return deviating.groupBy(*group).agg(
        (F.first("median") / 1e6).alias("median"), (middle("dev", "cum_dev", F.min) / 1e6).alias("mad"))


def beacons(df: DataFrame, cv_threshold: float = 0.3, min_connections: int = 10, min_interval: float = 5.0,
            max_interval: float = 7200.0, keys: list[str] = TRIPLE, ts: str = "ts",
            slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Regular connection series per source, destination and port, best confidence first."""
    timed = _timed(df, keys, ts, slice_seconds)
    passed = (_key_slices(timed, keys).where(F.col("n") >= min_connections)
              .withColumn("raw_cv", _cv(F.col("mean"), F.col("std"), 999.0))
              .where(F.round("mean", 3).between(min_interval, max_interval)
                     & (F.round("raw_cv", 4) <= cv_threshold)))
    scored = _gap_medians(timed, passed, keys, ["n", "mean", "std", "raw_cv", "from_us", "to_us"])
    jitter = F.when(F.col("median") > 0, F.col("mad") / F.col("median")).otherwise(F.lit(999.0))
    confidence = F.least(
        F.lit(100.0),
        F.greatest(F.lit(0.0), 1 - F.col("raw_cv")) * 100 + F.least(F.lit(10.0), (F.col("n") - 10) * 0.5))
    return scored.select(
        *[F.col(k).alias(a) for k, a in zip(keys, ["src_ip", "dst_ip", "dst_port"])],
        F.col("n").alias("connection_count"),
        F.round("mean", 3).alias("interval_mean"), F.round("std", 3).alias("interval_std"),
        F.round("median", 3).alias("interval_median"), F.round("mad", 3).alias("interval_mad"),
        F.round("raw_cv", 4).alias("cv"), F.round(jitter, 4).alias("jitter_score"),
        F.round(confidence, 1).alias("confidence"),
        F.timestamp_micros("from_us").alias("first_seen"), F.timestamp_micros("to_us").alias("last_seen"),
    ).orderBy(F.desc("confidence"), "src_ip", "dst_ip", "dst_port")


def interval_summary(df: DataFrame, keys: list[str] = PAIR, ts: str = "ts", digits: int = 4) -> DataFrame:
    """mean, std, cv, count (of gaps), min, max, variance, and the documented max-min jitter, per key."""
    s = gap_stats(df, keys, ts).where("n >= 2")
    r = lambda c: F.round(c, digits)
    return s.select(
        *keys, r("mean").alias("mean"), r("std").alias("std"),
        r(_cv(F.col("mean"), F.col("std"), 9999.0)).alias("cv"), F.col("n_gaps").alias("count"),
        r("min").alias("min"), r("max").alias("max"), r("var").alias("variance"),
        r(F.col("max") - F.col("min")).alias("jitter_range"))


def interval_score(cv: Column, count: Column, cv_threshold: float = 0.3) -> Column:
    """0-100: half from a low rounded cv, half from the number of gaps."""
    regular = F.greatest(F.lit(0.0), (cv_threshold - cv) / cv_threshold) * 50
    return F.round(regular + F.least(F.lit(50.0), count.cast("double")), 2)


def analyze_intervals(df: DataFrame, cv_threshold: float = 0.3, min_connections: int = 10,
                      keys: list[str] = PAIR, ts: str = "ts") -> DataFrame:
    """Regular pairs with a score and verdict; needs ``min_connections`` events."""
    s = interval_summary(df, keys, ts).where((F.col("count") + 1 >= min_connections) & (F.col("cv") < cv_threshold))
    score = interval_score(F.col("cv"), F.col("count"), cv_threshold)
    return s.select(
        F.col(keys[0]).alias("src"), F.col(keys[1]).alias("dst"), F.col("mean").alias("interval_mean_s"),
        F.col("std").alias("interval_std_s"), "cv", (F.col("count") + 1).alias("connection_count"),
        score.alias("confidence_score"),
        F.when(score > 70, "BEACON_HIGH").otherwise("BEACON_MEDIUM").alias("verdict"),
    ).orderBy(F.desc("confidence_score"), "src", "dst")


def predict_intervals(df: DataFrame, cv_threshold: float = 0.3, min_connections: int = 10,
                      keys: list[str] = PAIR, ts: str = "ts") -> DataFrame:
    """One row per key with ``is_beacon``; here the number of gaps must reach ``min_connections``."""
    s = interval_summary(df, keys, ts)
    return s.select(*keys, ((F.col("count") >= min_connections) & (F.col("cv") < cv_threshold)).alias("is_beacon"))


def pair_features(df: DataFrame, min_events: int = 5, keys: list[str] = PAIR, ts: str = "ts",
                  bytes_col: str = "orig_bytes", duration_col: str | None = "duration") -> DataFrame:
    """Nine numeric features per pair for outlier models."""
    duration = F.avg(duration_col) if duration_col else F.lit(0.0)
    volume = df.dropna(subset=keys).groupBy(*keys).agg(
        F.avg(bytes_col).alias("b_mean"), F.stddev_samp(bytes_col).alias("b_std"), duration.alias("d_mean"))
    s = gap_stats(df, keys, ts).where(F.col("n") >= min_events)
    r = lambda c, d: F.round(F.coalesce(c, F.lit(0.0)), d)
    return s.join(volume, keys).select(
        F.col(keys[0]).alias("src"), F.col(keys[1]).alias("dst"),
        F.round("mean", 4).alias("interval_mean"), F.round("std", 4).alias("interval_std"),
        F.round(_cv(F.col("mean"), F.col("std"), 9999.0), 4).alias("interval_cv"),
        F.round("min", 4).alias("interval_min"), F.round("max", 4).alias("interval_max"),
        F.col("n").alias("connection_count"), r(F.col("b_mean"), 2).alias("bytes_mean"),
        r(F.col("b_std"), 2).alias("bytes_std"), r(F.col("d_mean"), 4).alias("duration_mean"))


def sensor_beacons(df: DataFrame, cv_threshold: float = 0.3, min_connections: int = 10, min_gap: float = 5.0,
                   max_gap: float = 3600.0, window_seconds: int = 7200, throttle_seconds: int = 1800,
                   keys: list[str] = TRIPLE, ts: str = "ts", order: list[str] = (),
                   anchor: str = "first_event") -> DataFrame:
    """Beacon alerts as a live sensor raises them.

    Local to external TCP/UDP only.  History of a key starts at its first event and is dropped
    ``window_seconds`` later; gaps outside the limits are ignored, and a key alerts at
    most once per ``throttle_seconds``.
    """
    order = list(order)
    live = df.where(outbound("id_orig_h", "id_resp_h") & F.lower("proto").isin("tcp", "udp"))
    seen = time_windows(live.select(*keys, ts, *order), keys, ts, window_seconds, order, anchor)
    w = Window.partitionBy(*keys, "win_start").orderBy(ts, *order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    gaps = (seen.withColumn("connection_count", F.row_number().over(w))
            .withColumn("gap", (t - F.lag(t).over(w)) / 1e6)
            .withColumn("gap", F.when(F.col("gap").between(min_gap, max_gap), F.col("gap"))))
    stats = (gaps.withColumn("kept", F.count("gap").over(run)).withColumn("interval_mean", F.avg("gap").over(run))
             .withColumn("interval_std", F.stddev_pop("gap").over(run))
             .withColumn("interval_cv", _cv(F.col("interval_mean"), F.col("interval_std"), 9999.0)))
    hits = stats.where((F.col("connection_count") >= min_connections) & (F.col("kept") >= min_connections - 1)
                       & (F.col("interval_cv") <= cv_threshold))
    alerts = throttle(hits, keys, ts, throttle_seconds, order)
    regular = F.when(F.col("interval_cv") < cv_threshold,
                     (cv_threshold - F.col("interval_cv")) / cv_threshold * 50).otherwise(F.lit(0.0))
    score = regular + F.least(F.lit(50.0), F.col("connection_count") / 2)
    high = score > 70
    return alerts.select(
        ts, F.col(keys[0]).alias("src"), F.col(keys[1]).alias("dst"), F.col(keys[2]).alias("dport"), *order,
        "interval_mean", "interval_std", "interval_cv", "connection_count", score.alias("confidence_score"),
        F.when(high, "BEACON_HIGH").otherwise("BEACON_MEDIUM").alias("verdict"),
        F.when(high, "C2_Beaconing_High_Confidence").otherwise("C2_Beaconing_Detected").alias("note"),
        F.concat_ws("-", F.lit("beacon"), *[F.col(k).cast("string") for k in keys]).alias("identifier"))
