"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

Two small collections of ``m`` half bands, each of ``a`` minhashes, are computed per document (2ma minhashes
in all); every pairing of a half band of the first with one of the second is a table key, so m*m tables of
2a minhashes cost about the square root of the usual work.  Two texts of similarity s meet in some table
with probability (1 - (1 - s^a)^m)^2: 0.9996 at s = 0.8 with the defaults, over 0.99999 from 0.87.

Texts with equal sets fold into one class first.  In a table, every class is compared with the smallest one
(the pivot).  Classes that share a pivot and end in different groups are compared with each other too,
unless the triangle inequality of the Jaccard distance rules a link out, so no pair that met is left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.llm import graph, kernel
from netsift.llm.scratch import written

U = np.uint64
BITMAP = 26  # log2 of the bits that tell which rows' sets are wanted
TILE = 1 << 20  # shingles held per side when two groups of classes are compared in a task


def shingles(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed word shingles, sorted within each text, and bounds per text.

    ASCII capitals are folded.  A text with fewer words than ``width`` has one shingle, its whole sequence;
    a text without words has none.
    """
    n = len(off) - 1
    start, end, first = kernel.words(data, off)
    h = kernel.span_hash(kernel.prefix(kernel.LOWER[data]), start, end)
    size = np.diff(first)
    owner = np.repeat(np.arange(n), size)
    window = kernel.window_hash(h, width)
    whole = owner[:len(window)] == owner[width - 1:] if len(window) else np.zeros(0, bool)
    values, own = [window[whole]], [owner[:len(window)][whole]]
    for words in range(1, width):
        short = np.flatnonzero(size == words)
        if len(short):
            joined = np.zeros(len(short), np.uint64)
            for k in range(words):
                joined = kernel.mix(joined + U(words)) ^ h[first[short] + k]
            values.append(kernel.mix(joined ^ U(0x5851F42D4C957F2D)))
            own.append(short)
    values, own = np.concatenate(values), np.concatenate(own)
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    values, own = values[new], own[new]
    return values, np.searchsorted(own, np.arange(n + 1))


def _lists(values: np.ndarray, bounds: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def signatures(docs: DataFrame, width: int, a: int, m: int, keep=("doc_id",)) -> DataFrame:
    """kept columns, n_shingles, set fingerprints f1 and f2, and the half bands left and right (m longs each)."""

    def make():
        rng = np.random.default_rng(20011)
        factor = rng.integers(1, 2**63, 2 * m * a, dtype=np.uint64) * U(2) + U(1)
        turn = rng.integers(0, 2**63, 2 * m * a, dtype=np.uint64)

        def work(data, off, null):
            values, bounds = shingles(data, off, width)
            size = np.diff(bounds)
            full = np.flatnonzero(size)
            half = np.zeros((len(size), 2 * m), np.uint64)
            for k in range(2 * m * a):
                if len(full):
                    low = np.minimum.reduceat((values ^ turn[k]) * factor[k], bounds[full])
                    slot = k // a
                    half[full, slot] = kernel.mix((half[full, slot] + U(slot)) * U(0x9E3779B97F4A7C15) ^ low)
            prints = [kernel.per_text(kernel.mix(values ^ U(c)).view(np.int64), bounds)
                      for c in (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85)]
            at = np.arange(len(size) + 1) * m
            return [size, *prints, _lists(half[:, :m].ravel(), at), _lists(half[:, m:].ravel(), at)]

        return work

    return kernel.map_texts(docs, make, "n_shingles long, f1 long, f2 long, left array<long>, right array<long>", keep)


def sets(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """doc_id, shingles (sorted distinct hashes) of the rows whose id is in ``wanted(id)``, and of a few others.

    The ids go out as a bit map of fixed size, so texts are not shuffled; where it fills up, more of the other
    rows come along, and the joins that follow drop them.
    """
    spark = docs.sparkSession
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << BITMAP))
    words = (wanted.select(F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, int(pmod(xxhash64(id), 64)))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    sent = spark.sparkContext.broadcast((words.column(0).to_numpy(), words.column(1).to_numpy()))

    def run(batches):
        import pyarrow as pa

        at, bits = sent.value
        bitmap = np.zeros(1 << BITMAP >> 6, np.int64)
        bitmap[at] = bits
        for batch in batches:
            where = batch.column(1).to_numpy()
            keep = np.flatnonzero((bitmap[where >> 6] >> (where & 63)) & 1)
            some = batch.take(pa.array(keep))
            for i, j, data, off, _ in kernel.parts(some.column(2)):
                yield pa.RecordBatch.from_arrays([some.column(0).slice(i, j - i), _lists(*shingles(data, off, width))], ["id", "shingles"])

    known = docs.where("doc_id is not null").select(
        F.col("doc_id").alias("id"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP)).alias("bit"), F.col("text").cast("string").alias("text"))
    kind = known.schema["id"].dataType.simpleString()
    return known.mapInArrow(run, f"id {kind}, shingles array<long>")


def stars(classes: DataFrame, one_task: int = 1_000_000) -> DataFrame:
    """pivot, id: every class with the smallest class of each table key it shares.

    Half bands of more than ``one_task`` rows and more than a thousandth of all classes (no more than 1000 m of them)
    take a way that joins and can be split; the keys of all others are grouped by one shuffle, since up to a million
    rows of two numbers are no burden for a task.
    """
    halves = classes.select("id", F.explode("left").alias("l"), "right")
    often = halves.groupBy("l").count().where(F.col("count") > max(classes.count() / 1000, one_task)).select("l")
    often = F.broadcast(written(often, "often"))

    def keyed(rows):
        return rows.select("id", "l", F.explode("right").alias("r")).select("id", F.xxhash64("l", "r").alias("key"))

    first = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    usual = keyed(halves.join(often, "l", "left_anti")).withColumn("pivot", F.first("id").over(first))
    hot = keyed(halves.join(often, "l"))
    pivots = hot.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    hot = hot.join(pivots, "key")
    return usual.select("pivot", "id").where("id <> pivot").unionByName(hot.select("pivot", "id").where("id <> pivot")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, a: int = 3, m: int = 12) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    Rows link when 100 * intersection >= percent * union of their shingle sets.  Null and empty texts, and
    rows without an id, link with nothing; a row without an id has no component and is kept.  Rows that repeat
    an id share one component; all of them are kept if that id is its smallest.
    """
    docs = docs.select("doc_id", "text")
    signed = written(signatures(docs, width, a, m), "signatures")
    able = signed.where("n_shingles > 0 and doc_id is not null")
    classes = written(able.groupBy("n_shingles", "f1", "f2").agg(F.min(F.struct("doc_id", "left", "right")).alias("r"))
                      .select("n_shingles", "f1", "f2", F.col("r.doc_id").alias("id"), "r.left", "r.right"), "classes")
    star = written(stars(classes), "star")
    met = star.select("id").unionByName(star.select(F.col("pivot").alias("id")))
    full = written(sets(docs, width, met), "sets")
    shared = F.size(F.array_intersect("shingles", "other"))
    union = F.size("shingles") + F.size("other") - F.col("shared")
    compared = written(
        star.join(full, "id").join(full.select(F.col("id").alias("pivot"), F.col("shingles").alias("other")), "pivot")
        .withColumn("shared", shared)
        .select("pivot", "id", F.size("shingles").alias("size"), "shared", union.alias("union"),
                (F.col("shared") * 100 >= union * percent).alias("linked")), "compared")

    linked = compared.where("linked").select(F.col("pivot").alias("u"), F.col("id").alias("v"))
    groups = graph.components(linked)
    more = written(_among_partners(compared, groups, full, percent), "more")
    if more.limit(1).count():
        groups = graph.components(linked.unionByName(more))
    classes = classes.join(groups, "id", "left").select(
        "n_shingles", "f1", "f2", F.coalesce("component", "id").alias("component_id"))
    placed = able.join(classes, ["n_shingles", "f1", "f2"]).select("doc_id", "n_shingles", "component_id")
    rest = signed.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _among_partners(compared: DataFrame, groups: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links u, v between classes that met the same pivot and lie in different groups so far.

    With d the Jaccard distance, d(x, y) <= 1 - percent/100 needs |d(x, pivot) - d(y, pivot)| within that bound.
    So a class that is not in the pivot's group is compared with all the other such classes and with those of
    the pivot's group that do not link to the pivot itself; with those that do, only if some such class is nearer
    to the pivot than twice the bound.
    """
    known = groups.select("id", "component")
    rows = (compared.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
            .join(known.select(F.col("id").alias("pivot"), F.col("component").alias("home")), "pivot", "left")
            .withColumn("home", F.coalesce("home", "pivot"))
            .withColumn("away", F.col("component") != F.col("home"))
            .withColumn("chained", ~F.col("away") & ~F.col("linked"))
            .withColumn("near", F.col("shared") * 100 >= F.col("union") * (2 * percent - 100)))
    load = F.sum(F.when(F.col("away"), F.col("size")))
    stats = rows.groupBy("pivot").agg(
        F.sum(F.col("away").cast("long")).alias("n_away"),
        F.max(F.col("away") & F.col("near")).alias("reaches"), F.max("chained").alias("chains"),
        F.ceil(F.sum("size") / TILE).alias("tiles"), F.ceil(F.coalesce(load, F.lit(0)) / TILE).alias("away_tiles"),
    ).where("n_away > 1 or reaches or n_away > 0 and chains")
    rows = rows.join(stats, "pivot").where(F.col("away") | F.col("chained") | F.col("reaches")).join(full, "id")
    native = rows.select("pivot", F.pmod(F.xxhash64("id"), "tiles").alias("t"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("away_tiles") - 1)).alias("a"),
                         "id", "component", "shingles", F.lit(False).alias("probe"))
    probe = rows.where("away").select(
        "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("t"),
        F.pmod(F.xxhash64("id"), "away_tiles").alias("a"), "id", "component", "shingles", F.lit(True).alias("probe"))
    kind = T.StructType([T.StructField("u", compared.schema["id"].dataType), T.StructField("v", compared.schema["id"].dataType)])

    def compare(table):
        import pyarrow as pa

        ids = table.column("id").to_numpy()
        component = table.column("component").to_numpy()
        probe = table.column("probe").to_numpy()
        lists = table.column("shingles").combine_chunks()
        values, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        size = np.diff(bounds)
        native = np.flatnonzero(~probe)
        spots = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in native]) if len(native) else np.zeros(0, int)
        owner = np.repeat(native, size[native])
        order = np.argsort(values[spots], kind="stable")
        sorted_values, sorted_owner = values[spots][order], owner[order]
        us, vs = [], []
        for k in np.flatnonzero(probe):
            own = values[bounds[k]:bounds[k + 1]]
            lo, hi = np.searchsorted(sorted_values, own), np.searchsorted(sorted_values, own, "right")
            n = hi - lo
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            both = np.bincount(sorted_owner[at], minlength=len(ids))
            hit = np.flatnonzero((both * 100 >= percent * (size + size[k] - both)) & ~probe & (component != component[k]))
            _, one = np.unique(component[hit], return_index=True)
            us.append(np.repeat(ids[k], len(one)))
            vs.append(ids[hit[one]])
        empty = np.zeros(0, ids.dtype)
        return pa.table({"u": np.concatenate([empty, *us]), "v": np.concatenate([empty, *vs])})

    return native.unionByName(probe).groupBy("pivot", "t", "a").applyInArrow(compare, kind)


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without all but the smallest id of each group; rows without an id stay.

    Rows that repeat an id are copies of one document and one of them stays.
    """
    found = near_duplicates(docs, percent, width)
    gone = found.where("not kept").select("doc_id").distinct()
    stay = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    twice = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not twice.limit(1).count():
        return stay
    once = stay.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return stay.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
