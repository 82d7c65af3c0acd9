"""Continuous correlation: scores per source and time bucket, kept up to date in a Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.operators.incidents import verdict
from netsift.session import checkpoint_dir


def running_scores(alerts: DataFrame, bucket: str = "1 hour", watermark: str = "10 minutes", threshold: int = 70) -> DataFrame:
    """Score, alert count and techniques per source and bucket over a stream of normalised alerts.

    ``alerts`` has the columns of ``incidents.from_notices``; use output mode ``update``.
    """
    score = F.least(F.lit(100), F.sum("weight")).cast("int")
    return (alerts.withWatermark("ts", watermark).groupBy(F.window("ts", bucket).alias("w"), "src")
            .agg(score.alias("threat_score"), F.count("*").alias("alerts_seen"),
                 F.sort_array(F.collect_set("mitre")).alias("mitre_ttps"))
            .select("src", F.col("w.start").alias("bucket"), "threat_score", "alerts_seen", "mitre_ttps",
                    verdict(F.col("threat_score"), threshold).alias("verdict"))
            .where(F.col("threat_score") >= threshold))


def upsert(scores: DataFrame, path: str, name: str) -> StreamingQuery:
    """Write every changed row under its batch number, so a repeated batch replaces itself.

    ``name`` is the query's own folder under the checkpoint folder; a restart continues from it.
    ``current`` over ``spark.read.parquet(path)`` gives the latest version of each row.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (scores.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{checkpoint_dir(scores.sparkSession)}/{name}")
            .trigger(availableNow=True).start())


def current(changes: DataFrame) -> DataFrame:
    """Latest version of each (src, bucket)."""
    rest = [c for c in changes.columns if c not in ("src", "bucket", "epoch")]
    return (changes.groupBy("src", "bucket").agg(F.max_by(F.struct(*rest), "epoch").alias("last"))
            .select("src", "bucket", "last.*"))
