"""Isolation forest over pair features (Liu, Ting and Zhou 2008).

Each tree grows from a bounded random sample, so growing is one small task per tree whatever
the table's size; scoring is a narrow pass with the trees shipped as a bounded broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.operators.intervals import pair_features

FEATURES = ["interval_mean", "interval_std", "interval_cv", "interval_min", "interval_max", "connection_count",
            "bytes_mean", "bytes_std", "duration_mean"]
NODES = "tree int, node int, feature int, split double, left int, right int, size long"


def _path_length(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    deep = 2.0 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))


def _grow(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[list] = []
    todo = [(x, 0, None, None)]
    while todo:
        rows, depth, parent, side = todo.pop()
        at = len(nodes)
        nodes.append([tree, at, -1, 0.0, -1, -1, len(rows)])
        if parent is not None:
            nodes[parent][side] = at
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            continue
        feature = int(rng.choice(usable))
        split = float(rng.uniform(low[feature], high[feature]))
        nodes[at][2:4] = [feature, split]
        below = rows[:, feature] < split
        todo.append((rows[below], depth + 1, at, 4))
        todo.append((rows[~below], depth + 1, at, 5))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "left", "right", "size"])


def _depths(nodes: list[pd.DataFrame], x: np.ndarray) -> np.ndarray:
    """Mean path length of each row over the trees."""
    total = np.zeros(len(x))
    for t in nodes:
        feature, split = t["feature"].to_numpy(), t["split"].to_numpy()
        left, right, size = t["left"].to_numpy(), t["right"].to_numpy(), t["size"].to_numpy()
        at, depth = np.zeros(len(x), dtype=int), np.zeros(len(x))
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                break
            f = np.maximum(feature[at], 0)
            step = np.where(x[np.arange(len(x)), f] < split[at], left[at], right[at])
            at = np.where(inner, step, at)
            depth += inner
        total += depth + _path_length(size[at])
    return total / len(nodes)


@dataclass
class IsolationForest:
    """Trees as a table plus the sample size and the training cut-off."""

    trees: DataFrame
    sample: int
    cutoff: float | None = None

    def score(self, rows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
        """Add ``anomaly_score`` in (-1, 0); lower is more unusual."""
        table = self.trees.orderBy("tree", "node").toPandas()      # at most trees x 2 x sample rows
        nodes = [g.reset_index(drop=True) for _, g in table.groupby("tree")]
        shared = rows.sparkSession.sparkContext.broadcast(nodes)
        unit = float(_path_length(self.sample))

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x = pdf[features].fillna(0).to_numpy(dtype=float)
                yield pdf.assign(anomaly_score=-np.power(2.0, -_depths(shared.value, x) / unit))

        from pyspark.sql import types as T

        schema = T.StructType([*rows.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
        return rows.mapInPandas(add, schema)

    def save(self, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        spark = self.trees.sparkSession
        spark.createDataFrame([(self.sample, self.cutoff)], "sample int, cutoff double").write.mode(
            "overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        meta = spark.read.parquet(f"{path}/meta").first()
        return IsolationForest(spark.read.parquet(f"{path}/trees"), meta.sample, meta.cutoff)


def fit(rows: DataFrame, trees: int = 200, sample: int = 256, contamination: float = 0.05, seed: int = 42,
        keys: list[str] = ("src", "dst"), features: list[str] = FEATURES) -> IsolationForest:
    """Grow the trees and set the cut-off at the ``contamination`` quantile of the training scores."""
    rows = rows.select(*keys, *features)
    # every row may enter every tree: twice the sample is let through by hash, the smallest hashes stay
    share = min(1.0, 2 * sample / max(rows.count(), 1))
    wanted = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                      lambda t: F.pmod(F.xxhash64(F.lit(seed), t, *keys), F.lit(1 << 30)) < int(share * (1 << 30)))
    draw = rows.withColumn("tree", F.explode(wanted))
    w = Window.partitionBy("tree").orderBy(F.pmod(F.xxhash64(F.lit(seed), "tree", *keys), F.lit(1 << 30)), *keys)
    samples = draw.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample).drop("r")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(keys))
        return _grow(int(pdf["tree"].iloc[0]), pdf[features].fillna(0).to_numpy(dtype=float), seed)

    spark = rows.sparkSession
    grown = samples.groupBy("tree").applyInPandas(grow, NODES).toPandas()    # bounded: trees x 2 x sample
    if grown.empty:
        raise ValueError("no pair has enough events to train on")
    used = int(grown.loc[grown["node"] == 0, "size"].max())
    model = IsolationForest(spark.createDataFrame(grown, NODES), used)
    scores = model.score(rows, features)
    model.cutoff = scores.agg(F.percentile_approx("anomaly_score", contamination, 100_000)).first()[0]
    return model


def detect(conn: DataFrame, model: IsolationForest) -> DataFrame:
    """Unusual pairs with ``anomaly_score`` and a 0-100 confidence, most confident first."""
    scored = model.score(pair_features(conn)).withColumn("is_beacon", F.col("anomaly_score") <= model.cutoff)
    confidence = F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), (-F.col("anomaly_score") - 0.1) * 100)), 2)
    return (scored.where("is_beacon").withColumn("isolation_pred", F.lit(-1)).withColumn("confidence", confidence)
            .orderBy(F.desc("confidence"), "src", "dst"))
