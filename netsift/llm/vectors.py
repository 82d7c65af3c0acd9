"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted, and quantised to cells of ``cell``; ``hashes``
of these make a table's bucket, and there are ``tables`` tables.  For a pair at distance c, one hash agrees
with probability p(cell / c) and a table with p^hashes; with the defaults a pair at cosine 0.93 is missed
with probability 6e-4 and one at 0.95 with 3e-6.

Equal vectors of a label fold into one class first.  Buckets are cut into tiles of at most ``tile`` vectors and
pairs of tiles go to different tasks, which count links and keep one spanning forest per tile pair; no
list of pairs leaves a task.  A pair that meets in several tables counts in the first of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm import graph, kernel
from netsift.llm.scratch import written

U = np.uint64


def unit_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a list column (all of one length) in double precision, scaled to length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    return v / np.linalg.norm(v, axis=1, keepdims=True), v


def buckets(unit: np.ndarray, tables: int, hashes: int, cell: float, seed: int) -> np.ndarray:
    """One 64-bit bucket per row and table."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    direction = rng.normal(size=(unit.shape[1], tables * hashes))
    shift = rng.uniform(0, cell, tables * hashes)
    out = np.empty((len(unit), tables), np.uint64)
    for a in range(0, len(unit), 4096):
        q = np.floor((unit[a:a + 4096] @ direction + shift) / cell).astype(np.int64).view(np.uint64).reshape(-1, tables, hashes)
        h = np.arange(tables, dtype=np.uint64)[None, :] * U(0x9E3779B97F4A7C15)
        for k in range(hashes):
            h = kernel.mix(h * U(0xD6E8FEB86659FD93) ^ q[:, :, k])
        out[a:a + 4096] = h
    return out


def _links(unit, ids, weight, sig, table_no, side, threshold):
    """Links inside one bucket (or between its two sides): i, j as row numbers; each pair in its first table only."""
    n = len(ids)
    pairs_i, pairs_j = [], []
    for a in range(0, n, 512):
        block = unit[a:a + 512] @ unit.T
        i, j = np.nonzero(block >= threshold)
        i += a
        ok = i < j
        if side is not None:
            ok &= side[i] != side[j]
        pairs_i.append(i[ok])
        pairs_j.append(j[ok])
    i, j = np.concatenate(pairs_i), np.concatenate(pairs_j)
    seen = np.zeros(len(i), bool)
    for t in range(table_no):
        seen |= sig[i, t] == sig[j, t]
    return i[~seen], j[~seen]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tables: int = 48, hashes: int = 12, cell: float = 2.0,
                    tile: int = 2048, seed: int = 5) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Only vectors of equal, non-null label (and equal length) are compared.  Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without an id, link with nothing; a row without an id is kept.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    able = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & sound, F.lit(False))
    marked = rows.withColumn("able", able).withColumn("dim", F.size("v"))
    good = marked.where("able")
    classes = written(good.groupBy("label", "dim", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")), "classes")
    width = {r["dim"] for r in classes.select("dim").distinct().collect()}  # one number per vector length in use

    def tabulate(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                unit, _ = unit_rows(part.column(2))
                sig = buckets(unit, tables, hashes, cell, seed).view(np.int64)
                n = len(unit)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(n), tables))),
                     pa.array(np.tile(np.arange(tables), n)), pa.array(sig.ravel())], ["id", "t", "cell"])

    id_type = classes.schema["id"].dataType.simpleString()
    hashed = classes.select("id", "dim", "v").mapInArrow(tabulate, f"id {id_type}, t long, cell long")
    keys = hashed.join(classes.select("id", "label", "dim"), "id").select(
        "id", "t", F.xxhash64("label", "dim", "t", "cell").alias("bucket")) if width else hashed.select("id", "t", F.col("cell").alias("bucket"))
    keys = written(keys, "keys")
    sizes = keys.groupBy("bucket").count().where("count > 1").select("bucket", F.ceil(F.col("count") / tile).alias("tiles"))
    own = F.pmod(F.xxhash64("id"), F.col("tiles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    dealt = keys.join(sizes, "bucket").select("id", "t", "bucket", own.alias("own"), other.alias("other")).select(
        "id", "t", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own")
    spread = max(2, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    together = dealt.join(classes.select("id", "dim", "weight", "v"), "id").repartition(
        spread, "bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")

    def compare(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key = [held.column(c).to_numpy() for c in ("bucket", "a", "b")]
            last = np.flatnonzero(np.logical_and.reduce([k == k[-1] for k in key]))[0]
            if last:
                yield from groups(held.slice(0, last), [k[:last] for k in key])
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from groups(held, [held.column(c).to_numpy() for c in ("bucket", "a", "b")])

    def groups(t, key):
        t = t.combine_chunks()
        edge = np.ones(t.num_rows, bool)
        edge[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], t.num_rows)
        dim = t.column("dim").to_numpy()
        ids, weight = t.column("id").to_numpy(), t.column("weight").to_numpy()
        table_no, own = t.column("t").to_numpy(), t.column("own").to_numpy()
        unit = np.zeros((t.num_rows, dim.max()))
        sig = np.zeros((t.num_rows, tables), np.uint64)
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            unit[at, :d], _ = unit_rows(t.column("v").take(pa.array(at)).combine_chunks())
            sig[at] = buckets(unit[at][:, :d], tables, hashes, cell, seed)
        out = []
        size = end - begin
        for two in (True, False):
            if two:  # all buckets of two at once
                x = begin[(size == 2) & (key[1][begin] == key[2][begin])]
                cosine = np.einsum("ij,ij->i", unit[x], unit[x + 1])
                x = x[cosine >= threshold]
                earlier = np.arange(tables)[None, :] < table_no[x][:, None]
                x = x[~((sig[x] == sig[x + 1]) & earlier).any(axis=1)]
                out.append((x, x + 1))
                continue
            for x, y in zip(begin, end):
                split = key[1][x] != key[2][x]
                if y - x < 2 or (y - x == 2 and not split):
                    continue
                i, j = _links(unit[x:y], ids[x:y], weight[x:y], sig[x:y], int(table_no[x]), own[x:y] if split else None, threshold)
                out.append((i + x, j + x))
        i, j = (np.concatenate(z) for z in zip(*out))
        if not len(i):
            return
        # links per id, and a spanning forest of these rows by falling labels
        n_links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        label = ids.copy()
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            if np.array_equal(before, label):
                break
        hit = np.flatnonzero(n_links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[hit]), pa.array(n_links[hit].astype(np.int64)), pa.array(label[hit])], ["id", "n", "low"])

    found = written(together.mapInArrow(compare, f"id {id_type}, n long, low {id_type}"), "links")
    groups_ = graph.components(found.select(F.col("id").alias("u"), F.col("low").alias("v")))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    known = classes.join(counts, "id", "left").join(groups_, "id", "left").select(
        "label", "dim", "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    placed = good.join(known, ["label", "dim", "v"]).select("vec_id", "n_links", "component_id")
    rest = marked.where("not able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
