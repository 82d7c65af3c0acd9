"""A table that a stream keeps adding to, folded as it grows.

Each batch becomes one small folder of partial rows.  A manifest names the folders that make up the table; it is written
beside and renamed into place, so readers see whole generations only.  Once more than ``parts`` folders are named,
they are folded into one base.  Folders that neither the present nor the last manifest names are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.functions import text
from netsift.operators import incidents
from netsift.session import checkpoint_dir


class MergedTable:
    """``fold`` merges partial rows (in any order and grouping); ``path`` is a folder that only one stream writes."""

    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], parts: int = 8):
        self.spark, self.path, self.fold, self.parts = spark, path.rstrip("/"), fold, parts

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, below: str) -> list[str]:
        place, fs = self._fs()
        root = place(f"{self.path}{below}")
        return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []

    def _manifests(self) -> list[str]:
        return [n for n in self._names("/_manifest") if n.endswith(".json")]

    def _load(self, name: str) -> list[str]:
        rows = self.spark.read.option("wholetext", True).text(f"{self.path}/_manifest/{name}").collect()
        return json.loads(rows[0][0])

    def add(self, batch: DataFrame, epoch: int) -> None:
        """Add the partial rows of a batch; a batch that comes again after a restart changes nothing."""
        known = self._manifests()
        if known and int(known[-1].removesuffix(".json")) >= epoch:
            return
        folders = self._load(known[-1]) if known else []
        name = f"part-{epoch:012d}"
        self.fold(batch).write.mode("overwrite").parquet(f"{self.path}/{name}")
        folders.append(name)
        if len(folders) > self.parts:
            base = f"base-{epoch:012d}"
            self.fold(self._rows(folders)).write.mode("overwrite").parquet(f"{self.path}/{base}")
            folders = [base]
        place, fs = self._fs()
        draft = place(f"{self.path}/_manifest/.{epoch:012d}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        if not fs.rename(draft, place(f"{self.path}/_manifest/{epoch:012d}.json")):
            raise OSError(f"manifest {epoch} of {self.path} exists: two streams write to it")
        keep = self._manifests()[-2:]
        named = {f for m in keep for f in self._load(m)}
        for old in self._names(""):
            if old.startswith(("part-", "base-")) and old not in named:
                fs.delete(place(f"{self.path}/{old}"), True)
        for old in self._manifests():
            if old not in keep:
                fs.delete(place(f"{self.path}/_manifest/{old}"), False)

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders])

    def current(self) -> DataFrame | None:
        """All rows folded, as of the last manifest; None before the first batch."""
        known = self._manifests()
        return self.fold(self._rows(self._load(known[-1]))) if known else None

    def feed(self, stream: DataFrame, name: str) -> StreamingQuery:
        """Start adding a stream's batches; ``name`` is its folder under the checkpoint folder."""
        return (stream.writeStream.foreachBatch(lambda batch, epoch: self.add(batch, epoch))
                .option("checkpointLocation", f"{checkpoint_dir(self.spark)}/{name}").trigger(availableNow=True).start())


# --- what is kept this way -------------------------------------------------------

def incident_table(spark: SparkSession, path: str, parts: int = 8) -> MergedTable:
    """Alert kinds of each source and bucket, for alerts that come at any time and in any order."""
    return MergedTable(spark, path, incidents.merge_kinds, parts)


def feed_incidents(table: MergedTable, alerts: DataFrame, name: str, bucket_seconds: int | None = None) -> StreamingQuery:
    """Correlate a stream of normalised alerts (``incidents.from_notices``, ``from_alerts``)."""
    return table.feed(incidents.kinds(alerts, bucket_seconds), name)


def incidents_now(table: MergedTable, threshold: int = 70) -> DataFrame:
    """``incidents.score_sources`` of all alerts so far: capped scores, each kind of alert listed once."""
    return incidents.gather(table.current(), threshold)


def _baseline_sums(benign: DataFrame) -> DataFrame:
    return benign.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"),
                      F.coalesce(F.sum("squares"), F.lit(0.0)).alias("squares"))


def baseline_table(spark: SparkSession, path: str, parts: int = 8) -> MergedTable:
    """Count, sum and sum of squares of the entropies of benign strings."""
    return MergedTable(spark, path, _baseline_sums, parts)


def feed_baseline(table: MergedTable, benign: DataFrame, column: str, name: str, min_length: int = 6) -> StreamingQuery:
    e = text.entropy(column, digits=4)
    sums = benign.where(F.length(column) >= min_length).select(F.lit(1).cast("long").alias("n"), e.alias("total"), (e * e).alias("squares"))
    return table.feed(sums, name)


def baseline_now(table: MergedTable) -> DataFrame:
    """The row that ``score.entropy_baseline`` gives for all benign strings so far."""
    mean = F.try_divide("total", "n")
    spread = F.sqrt(F.greatest(F.try_divide("squares", "n") - mean * mean, F.lit(0.0)))
    return table.current().select(F.coalesce(mean, F.lit(2.5)).alias("base_mean"), F.coalesce(spread, F.lit(0.5)).alias("base_std"))
