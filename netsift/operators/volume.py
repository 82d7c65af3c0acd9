"""Outbound-volume detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.functions.net import is_local, outbound
from netsift.functions.text import megabytes
from netsift.functions.time import floor_to
from netsift.operators.anchored import anchored_windows, throttle, time_windows
from netsift.operators.common import dashed, findings

HUNDRED_MB = 104_857_600


def outbound_volume(conn: DataFrame, window_seconds: int = 3600, mode: str = "prefix") -> DataFrame:
    """Bytes sent per source, external destination and time bucket (partial sums before the shuffle)."""
    return (conn.dropna(subset=["id_orig_h", "id_resp_h", "orig_bytes"]).where(~is_local("id_resp_h", mode))
            .groupBy(F.col("id_orig_h").alias("src"), F.col("id_resp_h").alias("dst"),
                     floor_to("ts", window_seconds).alias("window"))
            .agg(F.sum("orig_bytes").alias("bytes_out")))


def volume_exfil(conn: DataFrame, threshold_mb: float = 100.0, mode: str = "prefix") -> DataFrame:
    """Source-destination hours at or above ``threshold_mb``, largest first."""
    mb = megabytes("bytes_out")
    return (outbound_volume(conn, 3600, mode).where(mb >= threshold_mb)
            .select(F.lit("VOLUME_EXFIL").alias("type"), F.lit("HIGH").alias("severity"), "src", "dst", "bytes_out",
                    F.round(mb, 2).alias("mb_out"), F.col("window").alias("hour"),
                    F.format_string("%.1f MB sent from %s → %s in 1 hour", mb, "src", "dst").alias("detail"))
            .orderBy(F.desc("bytes_out"), "src", "dst", "hour"))


def volume_score(bytes_out: Column, threshold_bytes: int = HUNDRED_MB) -> Column:
    return F.round(F.least(F.lit(100.0), bytes_out / F.lit(float(threshold_bytes)) * 50), 2)


def analyze_volume(conn: DataFrame, threshold_bytes: int = HUNDRED_MB, window_seconds: int = 3600,
                   mode: str = "prefix") -> DataFrame:
    """Scored suspects at or above the threshold, largest first."""
    filled = conn.withColumn("orig_bytes", F.coalesce("orig_bytes", F.lit(0)))
    return (outbound_volume(filled, window_seconds, mode).where(F.col("bytes_out") >= threshold_bytes)
            .select("src", "dst", "window", "bytes_out", megabytes("bytes_out").alias("mb_out"),
                    volume_score(F.col("bytes_out"), threshold_bytes).alias("score"))
            .orderBy(F.desc("bytes_out"), "src", "dst", "window"))


def volume_baseline(conn: DataFrame) -> DataFrame:
    """Mean, sample deviation and maximum of bytes sent per source."""
    return conn.groupBy(F.col("id_orig_h").alias("src")).agg(
        F.avg("orig_bytes").alias("mean"), F.stddev_samp("orig_bytes").alias("std"),
        F.max("orig_bytes").alias("max"))


def transfer_size_regularity(conn: DataFrame, min_events: int = 10, max_cv: float = 0.1) -> DataFrame:
    """Pairs whose transfers are nearly all of one size."""
    cv = F.try_divide(F.col("size_std"), F.col("size_mean"))
    return (conn.where("orig_bytes IS NOT NULL").groupBy(F.col("id_orig_h").alias("src"), F.col("id_resp_h").alias("dst"))
            .agg(F.count("*").alias("n"), F.avg("orig_bytes").alias("size_mean"),
                 F.stddev_pop("orig_bytes").alias("size_std"))
            .where(F.col("n") >= min_events).withColumn("size_cv", cv).where(F.col("size_cv") <= max_cv))


def sensor_volume_exfil(conn: DataFrame, threshold_bytes: int = HUNDRED_MB, window_seconds: int = 3600,
                        throttle_seconds: int = 3600, order: list[str] = (), anchor: str = "first_event") -> DataFrame:
    """Running total per local-to-external pair; at the threshold it alerts and starts again from 0.

    The total lives ``window_seconds`` from the pair's first transfer; a pair alerts again
    only after more than ``throttle_seconds``.
    """
    order, pair = list(order), ["id_orig_h", "id_resp_h"]
    live = (conn.where(outbound("id_orig_h", "id_resp_h") & F.col("orig_bytes").isNotNull())
            .select(*pair, "ts", *order, "orig_bytes"))
    window = [*pair, "win_start"]
    seen = time_windows(live, pair, "ts", window_seconds, order, anchor)
    run = Window.partitionBy(*window).orderBy("ts", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = (seen.withColumn("total", F.sum("orig_bytes").over(run)).withColumnRenamed("win_start", "opened")
             .withColumn("pair_window", dashed(*pair, "opened")))
    crossed = (anchored_windows(total, ["pair_window"], "total", threshold_bytes, ["ts", *order], opens_at_width=True)
               .where("win_first"))
    prior = F.lag("total", 1, 0).over(Window.partitionBy("pair_window").orderBy("total", "ts"))
    alerts = throttle(crossed.withColumn("bytes_out", F.col("total") - prior), pair, "ts", throttle_seconds, order,
                      strict=True)
    mb = megabytes("bytes_out")
    return findings(
        alerts, "Exfil_High_Volume_Outbound",
        F.format_string("%.1f MB outbound from %s to %s in last hour", mb, "id_orig_h", "id_resp_h"),
        dashed(F.lit("exfil-vol"), *pair), "VOLUME_EXFIL", keep=["bytes_out", *order])
