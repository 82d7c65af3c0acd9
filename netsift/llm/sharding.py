"""Two-pass external shuffle of a table into numbered shards.

Pass one scatters the rows by a seeded hash into buckets of about ``bucket_bytes``, one shuffle partition each.  The hash
is of a row's place in its input split, so a bucket holds the same share of any hot key, source or group of copies.  Pass two
holds one bucket in memory, Fisher-Yates shuffles it with a generator seeded by (seed, bucket) and writes it.  Buckets end
to end are one random order of all rows; shards are equal stretches of it (counts at most one apart), cut by a last
narrow pass that needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.llm.scratch import folder

BUCKET_BYTES = 32 << 20
FIRSTS_SENT = 1_000_000     # rows of 24 bytes


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text plus 8; a null text has no bytes."""
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 8


def _unclashing(rows: DataFrame, taken: tuple[str, ...]) -> DataFrame:
    """Columns named like the ones to be added get underscores behind their names until they are free."""
    names = [c.lower() for c in rows.columns]
    out = []
    for c in rows.columns:
        new = c
        while new.lower() in taken or (new != c and new.lower() in names):
            new += "_"
        out.append(F.col(f"`{c}`").alias(new))
    return rows.select(*out)


def _shuffled(batches: Iterator[pa.RecordBatch], seed: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """All rows of one bucket in Fisher-Yates order, numbered by ``__pos``.

    They are first put in order of their input places: the network may bring them in any order, and a
    task run again must give the same one.
    """
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    del held
    bucket = table.column("__bucket")[0].as_py()
    at = np.argsort(table.column("__at").to_numpy(), kind="stable")
    order = at[np.random.default_rng([seed, bucket]).permutation(len(at))]     # numpy's permutation is Fisher-Yates
    step = 1024
    for k in range(0, len(order), step):
        part = table.take(pa.array(order[k:k + step])).combine_chunks()
        part = part.append_column("__pos", pa.array(np.arange(k, k + part.num_rows)))
        yield from part.select(names).to_batches()


def write(rows: DataFrame, path: str, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES,
          size: Column | None = None) -> str:
    """Write all rows of the table in random order as ``path/shard=K``; returns the path.

    Every column is kept and ``slot`` (from 0, gapless in a shard) is added; input columns called ``shard``, ``slot``,
    ``__bucket``, ``__at`` or ``__pos`` get an underscore behind their names.  Repeated rows, nulls in any column and
    empty texts are rows like all others; an empty table gives a path without shards.  A row larger than a bucket fills one. The order depends on
    the seed, the table and how it is split for reading; ``size`` (default ``record_size()``) only sets the number
    of buckets.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum(record_size() if size is None else size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = _unclashing(rows, ("shard", "slot", "__bucket", "__at", "__pos"))
    columns = rows.columns
    place = rows.withColumn("__at", F.monotonically_increasing_id())
    place = place.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), "__at"), F.lit(buckets)).cast("int"))
    schema = T.StructType([*rows.schema.fields, T.StructField("__bucket", T.IntegerType()),
                           T.StructField("__pos", T.LongType())])
    names = schema.names
    mixed = place.repartitionById(buckets, F.col("__bucket")).mapInArrow(lambda it: _shuffled(it, seed, names), schema)
    scattered = folder(spark, "buckets")
    mixed.write.option("compression", "zstd").parquet(scattered)
    mixed = spark.read.schema(schema).parquet(scattered)

    # one row a bucket: its first place in the whole order
    counts = mixed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")
    firsts = counts.select("__bucket", before.alias("__first"), F.sum("__n").over(Window.partitionBy()).alias("__all"))
    if buckets <= FIRSTS_SENT:      # one row a bucket; more of them are joined
        firsts = F.broadcast(firsts)
    place = F.col("__first") + F.col("__pos")
    shard = F.expr(f"((__first + __pos + 1) * {shards} - 1) div __all").cast("int")
    dealt = (mixed.join(firsts, "__bucket").withColumn("shard", shard)
             .withColumn("slot", place - F.expr(f"(shard * __all) div {shards}")).select(*columns, "shard", "slot"))
    (dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path))
    return path


def read(rows: DataFrame, path: str) -> DataFrame:
    """The shards that ``write(rows, path, ...)`` left: the columns of ``rows``, ``slot`` and ``shard``."""
    fields = _unclashing(rows, ("shard", "slot", "__bucket", "__at", "__pos")).schema.fields
    schema = T.StructType([*fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return rows.sparkSession.read.schema(schema).parquet(path)


def assignments(docs: DataFrame, shards: int = 24, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, from the shards once written.

    One row per input row: repeated or null ids stay rows of their own, a null text has size 8 and checksum 0.
    """
    rows = docs.select("doc_id", "text")
    path = write(rows, folder(docs.sparkSession, "shards"), shards, seed, bucket_bytes)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return read(rows, path).select("doc_id", record_size().alias("size"), F.crc32(text).alias("text_crc32"),
                                   F.lit("rows").alias("law"), "shard", "slot",
                                   F.lit(None).cast("int").alias("grown_shard"))
