"""Entropy reports and the unified pair score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import text
from netsift.operators.intervals import PAIR, interval_score, interval_summary
from netsift.operators.volume import HUNDRED_MB, volume_score


def entropy_baseline(benign: DataFrame, column: str, min_length: int = 6) -> DataFrame:
    """One row: mean and population deviation of the entropy of benign strings (2.5 and 0.5 without any)."""
    e = text.entropy(column, digits=4)
    return benign.where(F.length(column) >= min_length).agg(
        F.coalesce(F.avg(e), F.lit(2.5)).alias("base_mean"), F.coalesce(F.stddev_pop(e), F.lit(0.5)).alias("base_std"))


def entropy_score(entropy: Column, threshold: float = 3.5, base_mean: Column | None = None,
                  base_std: Column | None = None) -> Column:
    """0-100: excess over the threshold, or the z-score against a baseline (3 deviations = 100)."""
    if base_mean is None:
        raw = F.greatest(F.lit(0.0), (entropy - threshold) / threshold)
    else:
        z = (entropy - base_mean) / F.greatest(base_std, F.lit(0.01))
        raw = F.least(F.lit(1.0), F.greatest(F.lit(0.0), z / 3))
    return F.round(raw * 100, 2)


def _with_baseline(df: DataFrame, baseline: DataFrame | tuple[float, float] | None) -> tuple[DataFrame, Column | None, Column | None]:
    """The rows with the baseline's mean and deviation; a baseline in a DataFrame is one row, sent to every task."""
    if baseline is None:
        return df, None, None
    if not isinstance(baseline, DataFrame):
        return df, F.lit(baseline[0]), F.lit(baseline[1])
    row = baseline.agg(F.first("base_mean").alias("_mean"), F.first("base_std").alias("_std")).withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(row), "_one"), F.col("_mean"), F.col("_std")


def entropy_domains(domains: DataFrame, column: str = "domain", threshold: float = 3.5, min_length: int = 6,
                    baseline: DataFrame | tuple[float, float] | None = None) -> DataFrame:
    """Names whose first label reaches the entropy threshold, best score first.

    ``baseline`` is the row of ``entropy_baseline``, joined in the plan, or two numbers.
    """
    label = text.first_label(column)
    e = F.col("entropy")
    hits = (domains.select(F.col(column).alias("domain"), label.alias("label")).where(F.length("label") >= min_length)
            .withColumn("entropy", text.entropy("label", digits=4)).where(e >= threshold))
    hits, mean, std = _with_baseline(hits, baseline)
    scored = hits.withColumn("score", entropy_score(e, threshold, mean, std))
    return scored.select(
        "domain", "label", "entropy", text.consonants_per_vowel("label", 3).alias("cv_ratio"),
        F.length("label").alias("length"), text.base64_like("label").alias("base64"), "score",
        F.when(F.col("score") > 50, "DGA_SUSPECT").otherwise("REVIEW").alias("verdict"),
    ).orderBy(F.desc("score"), "domain")


def unified_scores(conn: DataFrame, pair_domains: DataFrame | None = None, cv_threshold: float = 0.3,
                   min_connections: int = 10, entropy_threshold: float = 3.5, volume_threshold: int = HUNDRED_MB,
                   weights: tuple[float, float, float] = (0.4, 0.3, 0.3),
                   baseline: DataFrame | tuple[float, float] | None = None) -> DataFrame:
    """Interval, entropy and volume signals of each source-destination pair in one score.

    ``pair_domains`` maps pairs to a domain (``id_orig_h, id_resp_h, domain``), the caller's
    knowledge; a pair without one scores 0 there.  Volume is the pair's sum of bytes sent.
    """
    s = interval_summary(conn, PAIR)
    enough = F.col("count") + 1 >= min_connections
    beacon = s.select(*PAIR, F.when(enough, interval_score(F.col("cv"), F.col("count"), cv_threshold))
                      .otherwise(F.lit(0.0)).alias("beacon_score"))
    volume = conn.dropna(subset=PAIR).groupBy(*PAIR).agg(F.sum("orig_bytes").alias("b")).select(
        *PAIR, volume_score(F.coalesce("b", F.lit(0)), volume_threshold).alias("volume_score"))
    joined = volume.join(beacon, PAIR, "full_outer")
    if pair_domains is None:
        joined = joined.withColumn("entropy_score", F.lit(0.0))
    else:
        e = text.entropy(text.first_label("domain"), digits=4)
        pair_domains, mean, std = _with_baseline(pair_domains, baseline)
        named = pair_domains.select(*PAIR, entropy_score(e, entropy_threshold, mean, std).alias("e")).groupBy(*PAIR).agg(
            F.max("e").alias("entropy_score"))
        joined = joined.join(named, PAIR, "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    unified = (zero("beacon_score") * weights[0] + zero("entropy_score") * weights[1]
               + zero("volume_score") * weights[2])
    return joined.select(
        F.col(PAIR[0]).alias("src"), F.col(PAIR[1]).alias("dst"), zero("beacon_score").alias("beacon_score"),
        zero("entropy_score").alias("entropy_score"), zero("volume_score").alias("volume_score"),
        F.round(unified, 2).alias("unified_score"),
        F.when(unified > 80, "CRITICAL").when(unified > 60, "HIGH").when(unified > 40, "MEDIUM").otherwise("LOW")
        .alias("verdict"), (F.round(unified, 2) >= 60).alias("is_anomalous"))
