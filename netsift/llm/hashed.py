"""Hashed word and character n-gram features shared by the text classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm import kernel

U = np.uint64
GRAMS = (1, 2, 3, 4)
PARTS = 64


class Features:
    """Positions of features in a slice of texts: per kind (buckets, bounds per text, width)."""

    def __init__(self, bits: int, grams: tuple[int, ...] = GRAMS, fold: bool = True):
        self.bits, self.grams, self.fold = bits, grams, fold

    def __call__(self, data: np.ndarray, off: np.ndarray):
        d = kernel.LOWER[data] if self.fold else data
        d = np.where(kernel.SPACE[d], np.uint8(32), d)
        shift = U(64 - self.bits)
        start, end, first = kernel.words(data, off)
        yield (kernel.span_hash(kernel.prefix(d), start, end) >> shift).astype(np.int64), first, 1
        gram = np.zeros(len(d), np.uint64)
        for n in range(1, max(self.grams) + 1):
            gram = (gram[:len(d) - n + 1] << U(8)) | d[n - 1:]
            if n in self.grams:
                yield (((gram + U(n)) * U(0x9E3779B97F4A7C15)) >> shift).astype(np.int64), off, n

    def means(self, tables: list[np.ndarray], data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per text, the mean of each table over the buckets of all its features."""
        return self.means_and_counts(tables, data, off)[0]

    def means_and_counts(self, tables: list[np.ndarray], data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``means`` and the number of features of each text."""
        sums = np.zeros((len(off) - 1, len(tables)))
        count = np.zeros(len(off) - 1)
        for bucket, bounds, width in self(data, off):
            size = np.maximum(bounds[1:] - bounds[:-1] - width + 1, 0)
            count += size
            for k, table in enumerate(tables):
                sums[:, k] += kernel.per_text(table[bucket], bounds, width - 1)
        return sums / np.maximum(count, 1)[:, None], count

    def bags(self, data: np.ndarray, off: np.ndarray, null=None) -> tuple[list[bytes], list[bytes]]:
        """Per text: bucket numbers (int32) and their shares (float32), as bytes."""
        kinds = list(self(data, off))
        index, share = [], []
        for k in range(len(off) - 1):
            own = [b[bounds[k]:max(bounds[k + 1] - width + 1, bounds[k])] for b, bounds, width in kinds]
            ids, n = np.unique(np.concatenate(own), return_counts=True)
            index.append(ids.astype("<i4").tobytes())
            share.append((n / max(n.sum(), 1)).astype("<f4").tobytes())
        return index, share


def training_bags(docs: DataFrame, label: str, per_label: int, features: Features, labels: DataFrame | None = None) -> list:
    """Bags of at most ``per_label`` rows of each label, chosen by a hash of doc_id over all rows.

    The first rows of each label are found within ``PARTS`` parts of it and then among what the parts hand on,
    so that no task sees more than PARTS x per_label rows of a common label.  Ids repeated in the input count once.
    Labels come from ``docs`` or, joined by id alone, from ``labels(doc_id, label)``: texts are never shuffled.
    The result is bounded by labels x per_label rows and comes to the driver sorted by doc_id.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    if labels is None:
        named = usable.select("doc_id", label)
    else:
        named = usable.select("doc_id").join(labels.select("doc_id", label), "doc_id")
    ids = named.where(F.col(label).isNotNull()).withColumn("__h", F.xxhash64("doc_id"))
    part = Window.partitionBy(label, F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS))).orderBy("__h", "doc_id")
    order = Window.partitionBy(label).orderBy("__h", "doc_id")
    chosen = (ids.withColumn("__n", F.row_number().over(part)).where(F.col("__n") <= per_label)
              .withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= per_label)
              .select("doc_id", label).distinct())
    # at most labels x per_label ids: small enough to send to every executor
    on, columns = (["doc_id", label], ["doc_id", "text", label]) if labels is None else (["doc_id"], ["doc_id", "text"])
    rows = usable.select(*columns).join(F.broadcast(chosen), on)
    bags = kernel.map_texts(rows, lambda: features.bags, "idx binary, share binary", keep=("doc_id", label))
    one = bags.groupBy("doc_id", label).agg(F.min(F.struct("idx", "share")).alias("bag"))
    # in doc_id order, one partition at a time: the driver never holds all bags twice, nor the JVM all at once
    got = one.select("doc_id", F.col(label).alias("label"), "bag.idx", "bag.share").orderBy(
        "doc_id", F.col("label").cast("string"))
    return list(got.toLocalIterator(prefetchPartitions=False))


def ragged(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bags end to end: buckets, shares, offsets."""
    idx = [np.frombuffer(r["idx"], "<i4") for r in rows]
    off = np.concatenate([[0], np.cumsum([len(i) for i in idx])]).astype(np.int64)
    share = [np.frombuffer(r["share"], "<f4") for r in rows]
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), off
    return np.concatenate(idx), np.concatenate(share), off


def batch_of(picked: np.ndarray, idx, share, off):
    """The bags of the picked rows: buckets, shares, row number of each entry."""
    size = off[picked + 1] - off[picked]
    row = np.repeat(np.arange(len(picked)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(off[picked], size)
    return idx[at], share[at], row
