"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time options the operators rely on; leaves cluster sizing alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("netsift")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the one the cluster names; a new local one only where the master is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="netsift-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
