"""Connected components by alternating star contractions; all state stays in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.scratch import written


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in ``links(u, v)``; ids without a link are absent.

    Each round points the larger neighbours of every node at its smallest neighbour, then the smaller ones,
    until nothing changes; the number of rounds grows with the logarithm of the input.  A round is two
    partial aggregations and two joins, and is written to the shared folder.
    """
    state = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                    "links")
    mark = _mark(state)
    while mark[0]:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        state = written(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "links")
        now = _mark(state)
        if now == mark:
            break
        mark = now
    members = state.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(state.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _mark(state: DataFrame) -> tuple:
    """Row count and order-free checksum."""
    return tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
