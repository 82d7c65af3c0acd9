"""Median of everything before each row, for long series, without a growing frame.

The series of a key is cut into blocks of positions.  While a block of b rows goes by, the median of what came before
can move by at most b ranks.  So counts per (block, bin of values) are summed over the blocks, which tells per block the few
bins where its median can lie and how much lies below them; only the earlier values of those bins are sent to the
block, as counts of equal values.  Each block is then finished alone on a tree of counts.  No task holds a whole series, and
the work is n log n but for the values of the middle bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.operators.anchored import _key, group_bounds, ordered, whole_groups

BLOCK = 4096     # positions per block
BINS = 128       # bins of about equally many values per key


def _binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_k, _block, v, c, edges) -> the same with the bin of v in place of the edges."""
    for b in batches:
        edges, v = b.column(4), b.column(2).to_numpy()
        flat, off = edges.flatten().to_numpy(), edges.offsets.to_numpy() - edges.offsets[0].as_py()
        found = np.empty(len(v), np.int32)
        same = np.flatnonzero(np.append(True, np.diff(pa.compute.dictionary_encode(b.column(0)).indices.to_numpy()) != 0))
        for s, e in zip(same.tolist(), [*same[1:].tolist(), len(v)]):     # runs of one key share their edges
            found[s:e] = np.searchsorted(flat[off[s]:off[s + 1]], v[s:e], side="right")
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(found)], ["_k", "_block", "v", "c", "bin"])


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_k, _block, bin, c) in order -> per block: first and last bin the median may lie in, count of all below it, of all before."""
    key, block, counts, rows = None, None, np.zeros(0, np.int64), []
    own = np.zeros(BINS + 1, np.int64)

    def close():
        before, b = int(counts.sum()), int(own.sum())
        if before:
            up = np.cumsum(counts)
            low, high = max((before - 1) // 2 - b, 0), min((before + b) // 2 + 1, before - 1)
            first, last = int(np.searchsorted(up, low, side="right")), int(np.searchsorted(up, high, side="right"))
            rows.append((key, block, first, last, int(up[first] - counts[first]), before))

    for batch in batches:
        for k, at, b, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (k, at) != (key, block):
                if key is not None or block is not None:
                    close()
                counts = counts + own if k == key else np.zeros(BINS + 1, np.int64)
                key, block, own = k, at, np.zeros(BINS + 1, np.int64)
            own[b] += c
        if rows:
            yield _block_rows(rows)
            rows = []
    if block is not None:
        close()
    if rows:
        yield _block_rows(rows)


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["_k", "_block", "first", "last", "below", "before"])


def running_medians(values: np.ndarray, known: np.ndarray, weight: np.ndarray, below: int, before: int) -> np.ndarray:
    """For each value the median of the ``before`` earlier ones and the values before it.

    Of the earlier ones ``below`` are smaller than the known ones, which have weights; the rest are larger.
    """
    all_values = np.unique(np.concatenate([known, values]))
    size = len(all_values)
    counts = np.zeros(size + 1, np.int64)              # place 0: the small ones
    counts[0] = below
    np.add.at(counts, np.searchsorted(all_values, known) + 1, weight)
    tree = [0, *counts.tolist()]                       # Fenwick tree over places 0..size
    for i in range(1, size + 2):
        j = i + (i & -i)
        if j <= size + 1:
            tree[j] += tree[i]
    top = 1 << (size + 1).bit_length()

    def at_rank(r: int) -> float:
        place, step = 0, top
        while step:
            nxt = place + step
            if nxt <= size + 1 and tree[nxt] <= r:
                place, r = nxt, r - tree[nxt]
            step >>= 1
        return float(all_values[place - 1])

    total = before
    out = np.full(len(values), np.nan)
    for k, place in enumerate((np.searchsorted(all_values, values) + 2).tolist()):
        if total:
            one = at_rank((total - 1) // 2)
            out[k] = one if total % 2 else (one + at_rank(total // 2)) / 2
        while place <= size + 1:
            tree[place] += 1
            place += place & -place
        total += 1
    return out


def growing_median(df: DataFrame, keys: list[str], position: str, value: str, name: str) -> DataFrame:
    """``keys, position, value`` and the median (``name``, double) of the values at smaller positions of the key.

    Positions are whole numbers, unique in a key, and values are numbers; the first row of a key has null.  Rows without
    a position or a value are left out.  Medians of an even count lie midway, as ``percentile(0.5)`` does.
    """
    rows = (df.select(*keys, F.col(position).cast("long").alias(position), F.col(value).alias(value)).withColumns({
        "_k": _key(keys), "_block": F.expr(f"floor(`{position}` / {BLOCK})").cast("long"), "_v": F.col(value).cast("double")})
        .where(F.col(position).isNotNull() & F.col(value).isNotNull() & F.col("_k").isNotNull()).repartition("_k", "_block"))
    same = rows.groupBy("_k", "_block", F.col("_v").alias("v")).agg(F.count("*").alias("c"))
    shares = [k / BINS for k in range(1, BINS)]
    edges = same.groupBy("_k").agg(F.array_sort(F.array_distinct(F.percentile_approx("v", shares, 2000))).alias("edges"))
    binned = same.join(edges, "_k").select("_k", "_block", "v", "c", "edges").mapInArrow(
        _binned, "_k string, _block long, v double, c long, bin int")
    sums = binned.groupBy("_k", "_block", "bin").agg(F.sum("c").alias("c"))
    middle = (sums.repartition("_k").sortWithinPartitions("_k", "_block", "bin")
              .mapInArrow(_middles, "_k string, _block long, first int, last int, below long, before long"))
    wanted = middle.select("_k", F.col("_block").alias("block"), F.explode(F.sequence("first", "last")).alias("bin"))
    sent = (binned.withColumnRenamed("_block", "early").join(wanted, ["_k", "bin"]).where("early < block")
            .groupBy("_k", F.col("block").alias("_block"), "v").agg(F.sum("c").alias("c")))
    null = lambda t: F.lit(None).cast(t)
    schema = rows.schema
    blank = [null(schema[c].dataType).alias(c) for c in [*keys, position, value]]
    known = sent.select(*blank, "_k", "_block", F.col("v").alias("_v"), F.col("c").alias("_c"), null("long").alias("_below"))
    below = middle.select(*blank, "_k", "_block", F.col("before").cast("double").alias("_v"), null("long").alias("_c"),
                          F.col("below").alias("_below"))
    own = rows.select(*keys, position, value, "_k", "_block", "_v", null("long").alias("_c"), null("long").alias("_below"))
    keep = [*keys, position, value]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            starts, ends, _ = group_bounds(table)
            weight, small = table.column("_c"), table.column("_below")
            v = table.column("_v").to_numpy()
            is_known, is_small = weight.is_valid().to_numpy(), small.is_valid().to_numpy()
            own_rows, medians = [], []
            for s, e in zip(starts.tolist(), ends.tolist()):
                mine = np.arange(s, e)
                k, b = mine[is_known[s:e]], mine[is_small[s:e]]
                o = mine[~is_known[s:e] & ~is_small[s:e]]
                own_rows.append(o)
                medians.append(running_medians(v[o], v[k], weight.take(pa.array(k)).to_numpy().astype(np.int64),
                                               small[int(b[0])].as_py() if len(b) else 0, int(v[b[0]]) if len(b) else 0))
            out = table.select(keep).take(pa.array(np.concatenate(own_rows)))
            found = np.concatenate(medians)
            yield from out.append_column(name, pa.array(found, mask=np.isnan(found))).to_batches()

    both = own.unionByName(known).unionByName(below)
    out = T.StructType([*[schema[c] for c in keep], T.StructField(name, T.DoubleType())])
    return ordered(both, ["_k", "_block"], [F.col(position).asc_nulls_first()]).mapInArrow(finish, out)
