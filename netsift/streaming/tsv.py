"""TSV logs as a stream: lines and the header of their file may arrive in any batches.

A table folder holds three parts: ``headers`` (the ``#fields`` line of each file, folded as it grows), ``rows`` (typed rows, one
folder a batch) and ``pending`` (lines whose header is not known yet, rewritten each batch).  Headers stay in tables:
a line finds its columns by their places in its own header, so any number of files and of headers may be in one batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift import schemas
from netsift.session import checkpoint_dir
from netsift.sources import logs
from netsift.streaming.merged import MergedTable


def file_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of a folder that files are added to, with the file each comes from."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"))


def _headers(found: DataFrame) -> DataFrame:
    """Smallest and largest header of each file; they differ where a file changes its columns."""
    return found.groupBy("file").agg(F.min("low").alias("low"), F.max("high").alias("high"))


class TsvTable:
    """Typed rows of one log kind, fed by one stream of ``(file, value)`` lines.

    Columns are those the kind declares, then ``extra`` (undeclared names, as text); all other fields are kept in the map
    ``other``.  A line with another number of fields than its header is dropped, as are other ``#`` lines and null lines; a
    column that a file lacks is null.  Lines of a file without a header stay pending.  A file with two different headers
    stops the stream with ValueError before rows of that batch are written, as the batch reader refuses it.  Repeated
    lines are repeated rows.  A batch that comes again after a restart replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str, extra: list[str] = (), parts: int = 8):
        self.spark, self.path, self.kind, self.extra = spark, path.rstrip("/"), kind, list(extra)
        self.headers = MergedTable(spark, f"{self.path}/headers", _headers, parts)

    def _names(self) -> list[str]:
        return [*schemas.columns(self.kind), *self.extra]

    def _typed(self, joined: DataFrame) -> DataFrame:
        lines = joined.select(F.split("value", "\t", -1).alias("parts"),
                              F.expr("slice(split(low, '\t', -1), 2, size(split(low, '\t', -1)) - 1)").alias("fields"))
        lines = lines.where(F.size("parts") == F.size("fields"))

        def value(name: str) -> Column:
            """The field of that name; of a repeated name the last one, as the batch reader takes."""
            place = F.size("fields") - F.array_position(F.reverse("fields"), F.lit(name))
            return F.nullif(F.get("parts", place.cast("int")), F.lit(logs.UNSET))

        pairs = F.filter(F.arrays_zip("fields", "parts"), lambda p: ~p["fields"].isin(*self._names()) & (p["parts"] != logs.UNSET))
        # of a repeated name the last value
        other = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(
            F.map_filter(m, lambda k, _: k != p["fields"]), F.create_map(p["fields"], p["parts"])))
        return lines.select(*logs.coerce({n: value(n) for n in self._names()}, self.kind), other.alias("other"))

    def add(self, batch: DataFrame, epoch: int) -> None:
        """Add a batch of lines."""
        is_header = F.startswith("value", F.lit("#fields"))
        self.headers.add(batch.where(is_header).select("file", F.col("value").alias("low"), F.col("value").alias("high")), epoch)
        known = self.headers.current()
        for bad in known.where("low <> high").limit(1).collect():
            raise ValueError(f"{bad.file} changes its #fields within the file; split it at its headers")
        waiting = batch.where(~F.startswith("value", F.lit("#"))).select("file", "value")
        held = [e for e in self._pending() if e < epoch]
        if held:
            waiting = waiting.unionByName(self.spark.read.parquet(self._place(held[-1])))
        joined = waiting.join(known.select("file", "low"), "file", "left")
        self._typed(joined.where("low IS NOT NULL")).write.mode("overwrite").parquet(f"{self.path}/rows/batch={epoch}")
        joined.where("low IS NULL").select("file", "value").write.mode("overwrite").parquet(self._place(epoch))
        place, fs = self.headers._fs()
        for old in [e for e in self._pending() if e < epoch][:-1]:      # a batch that comes again needs the last one
            fs.delete(place(self._place(old)), True)

    def _place(self, epoch: int) -> str:
        return f"{self.path}/pending/{epoch:012d}"

    def _pending(self) -> list[int]:
        place, fs = self.headers._fs()
        root = place(f"{self.path}/pending")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(root)) if fs.exists(root) else []

    def feed(self, lines: DataFrame, name: str) -> StreamingQuery:
        """Start adding a stream of lines; ``name`` is its folder under the checkpoint folder."""
        return (lines.writeStream.foreachBatch(lambda batch, epoch: self.add(batch, epoch))
                .option("checkpointLocation", f"{checkpoint_dir(self.spark)}/{name}").trigger(availableNow=True).start())

    def rows(self) -> DataFrame:
        """All typed rows so far."""
        return self.spark.read.parquet(f"{self.path}/rows").drop("batch")

    def pending(self) -> DataFrame:
        """Lines whose file has shown no header yet."""
        return self.spark.read.parquet(self._place(self._pending()[-1]))
