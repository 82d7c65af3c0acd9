"""Best-fit packing of token sequences by linear grouping.

Pieces longer than an eighth of a sequence are large.  Sorted by length they fall into groups of equal
cardinality; every length is rounded up to its group's largest.  Over these few sizes, fill patterns
(configurations) are chosen one after another: the largest size left with the fullest completion found by
dynamic programming, used as often as supply allows.  The actual pieces then take their group's slots, and
the small pieces, largest first, go best-fit into the room that is really left.

Both plans work on histograms of at most ``size`` lengths and are made of intervals of ranks, so what the
driver holds does not grow with the number of pieces.  Ranks and places are computed in Spark.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm import kernel, tokens
from netsift.llm.scratch import written

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids with ``end_id`` behind, cut only if longer than ``size``.

    Of a text that is cut, the first piece takes the odd rest and all others are full.  Null text counts as empty.
    """
    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa

        encode = tokens.encoder(tokenizer)
        for b in batches:
            for i, j, data, off, _ in kernel.parts(b.column(1)):
                ids, bounds = encode(data, off)
                rows = [[], [], [], [], []]
                for k in range(j - i):
                    own = np.append(ids[bounds[k]:bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                    cuts = [0, len(own)]
                    if len(own) > size:
                        cuts = [0, *range(len(own) % size or size, len(own) + 1, size)]
                    for p, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        for col, v in zip(rows, (i + k, p, x, y - x, zlib.crc32(own[x:y].tobytes()))):
                            col.append(v)
                at = pa.array(rows[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:])],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, PIECES.format(id=kind))


def grouped_plan(lengths: np.ndarray, counts: np.ndarray, size: int, groups: int) -> tuple[int, list, int]:
    """Group cardinality, slot intervals (group, from, to, first sequence, slots per sequence) and sequences used."""
    total = int(counts.sum())
    if not total:
        return 1, [], 0
    card = -(-total // groups)
    upto = np.cumsum(counts)
    n_groups = -(-total // card)
    last = np.minimum((np.arange(n_groups) + 1) * card, total)
    width = lengths[np.searchsorted(upto, last)]  # the largest length in each group
    left = np.diff(np.concatenate([[0], last]))
    taken, plan, sequence = np.zeros(n_groups, np.int64), [], 0
    while left.any():
        top = int(np.flatnonzero(left)[-1])
        use = _completion(width, left, top, size)
        times = int(min(left[g] // c for g, c in use.items()))
        for g, c in use.items():
            plan.append((g, int(taken[g]), int(taken[g] + times * c), sequence, c))
            taken[g] += times * c
            left[g] -= times * c
        sequence += times
    return card, plan, sequence


def _completion(width: np.ndarray, left: np.ndarray, top: int, size: int) -> dict[int, int]:
    """``top`` once, and the sizes that fill the rest of a sequence best (larger sizes preferred)."""
    room = size - int(width[top])
    use = {top: 1}
    best = np.full(room + 1, -1, np.int64)  # per fill: the last size taken
    best[0] = -2
    for g in range(top, -1, -1):
        have, w = int(left[g]) - (g == top), int(width[g])
        if have <= 0 or w > room:
            continue
        fresh = np.flatnonzero(best != -1)
        for _ in range(min(have, room // w)):
            fresh = fresh[fresh + w <= room] + w
            fresh = fresh[best[fresh] == -1]
            if not len(fresh):
                break
            best[fresh] = g
    fill = int(np.flatnonzero(best != -1)[-1])
    while fill > 0:
        g = int(best[fill])
        use[g] = use.get(g, 0) + 1
        fill -= int(width[g])
    return use


def best_fit_plan(rooms: dict[int, int], small: dict[int, int], size: int) -> tuple[list, int]:
    """Intervals (length, from, to, room, first rank) placing small pieces into sequences, and sequences opened.

    Sequences are known by their room and their rank among those of equal room; opened ones have room ``size``.
    """
    open_at: dict[int, list] = {r: [(r, 0, n)] for r, n in rooms.items() if n}
    plan, opened = [], 0
    for length in sorted(small, reverse=True):
        done = 0
        while done < small[length]:
            fits = [r for r in open_at if r >= length and open_at[r]]
            if not fits:
                more = -(-(small[length] - done) // (size // length))
                open_at.setdefault(size, []).append((-1, opened, opened + more))
                opened += more
                continue
            room = min(fits)
            origin, a, b = open_at[room].pop()
            n = min(small[length] - done, b - a)
            plan.append((length, done, done + n, origin, a))
            if n < b - a:
                open_at[room].append((origin, a + n, b))
            open_at.setdefault(room - length, []).append((origin, a, a + n))
            done += n
    return plan, opened


def ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... within each value of ``by``, dealt over hashed sub-groups so that no value needs one task."""
    salt = max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.withColumn("__b", F.pmod(F.xxhash64(*df.columns), F.lit(salt)))
    sizes = rows.groupBy(by, "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(by, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    order = Window.partitionBy(by, "__b").orderBy(*[c for c in df.columns if c != by])
    out = rows.withColumn("__r", F.row_number().over(order) - 1).join(base, [by, "__b"])
    return out.withColumn(name, F.col("__base") + F.col("__r")).drop("__b", "__r", "__base")


def _table(spark, rows: list, schema: str) -> DataFrame:
    """A plan table; its rows are bounded by the number of lengths and groups, whatever the input's size."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def place(pieces: DataFrame, size: int = 2048, groups: int = 256) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``size``."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.where(F.col("length") < size).groupBy("length").count().collect()}
    limit = size // 8
    lengths = np.array(sorted(x for x in histogram if x > limit), np.int64)
    counts = np.array([histogram[x] for x in lengths], np.int64)
    card, plan, used = grouped_plan(lengths, counts, size, groups)
    before = np.cumsum(counts) - counts
    base = _table(spark, [(int(x), int(n)) for x, n in zip(lengths, before)], "length long, __before long")
    slots = _table(spark, plan, "g long, a long, b long, first long, c long")
    rows = ranked(pieces.where(F.col("length") < size), "length", "r")
    order = F.col("__before") + F.col("r")
    large = (rows.join(base, "length").withColumn("g", F.floor(order / card)).withColumn("k", order % card)
             .join(slots, "g").where("k >= a and k < b")
             .withColumn("sequence", F.col("first") + F.floor((F.col("k") - F.col("a")) / F.col("c")))
             .select(*pieces.columns, "sequence"))
    large = written(large, "large")
    room = ranked(large.groupBy("sequence").agg((size - F.sum("length")).alias("room")), "room", "rank")
    room = written(room, "room")
    rooms = {r["room"]: r["count"] for r in room.groupBy("room").count().collect()}
    fits, _ = best_fit_plan(rooms, {x: n for x, n in histogram.items() if x <= limit}, size)
    fit = _table(spark, fits, "length long, a long, b long, origin long, first long")
    small = (rows.join(fit, "length").where("r >= a and r < b")
             .withColumn("rank", F.col("first") + F.col("r") - F.col("a")))
    fresh = small.where("origin = -1").select(*pieces.columns, (F.col("rank") + used).alias("sequence"))
    topped = small.where("origin >= 0").select(*pieces.columns, F.col("origin").alias("room"), "rank").join(
        room, ["room", "rank"]).select(*pieces.columns, "sequence")
    shared = large.unionByName(topped).unionByName(fresh)
    inside = Window.partitionBy("sequence").orderBy(F.desc("length"), *[c for c in pieces.columns if c != "length"])
    shared = shared.withColumn("offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
    alone = pieces.where(F.col("length") == size).select(
        *pieces.columns, (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.select(*pieces.columns, (F.col("sequence") * 2).alias("sequence_id"), "offset").unionByName(alone)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, groups: int = 256) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Sequence numbers are arbitrary; a sequence's pieces lie end to end from offset 0.  A full piece has a sequence
    of its own.  Every input row is packed, also if ids repeat.
    """
    return place(written(cut_pieces(docs, tokenizer, size, end_id), "pieces"), size, groups)
