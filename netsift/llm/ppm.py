"""Prediction by partial matching over bytes, next to a smoothed word model.

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts of what followed them in all
training texts.  A byte's probability comes from the longest context known; if the byte was not seen there, an
escape (as probable as the context has different followers) leads to the next shorter one, where the symbols
already ruled out are excluded from all counts; below the empty context all symbols left are equally likely.
A text starts after ``ORDER`` start marks and ends with an end mark, and its code length is the sum over it.

The trie lives in Spark tables of (ORDER + 1)-grams.  Scoring sends out the grams and words that make up at least
1 / HEAVY of all occurrences, of which there can be at most HEAVY; all rarer ones are joined by key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.llm import kernel
from netsift.llm.scratch import written

U = np.uint64
ORDER = 5
START, END, SYMBOLS = 0xFF, 0xFE, 257
HEAVY = {1: 1 << 21, 2: 1 << 22}
WORD, GRAM = 1, 2
END_WORD = int(kernel.mix(np.array([0x454E44], np.uint64)).view(np.int64)[0])


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all (ORDER + 1)-grams, one per byte and end mark, and bounds per text."""
    n = len(off) - 1
    size = np.diff(off)
    step = ORDER + 1
    wide = np.full(len(data) + step * n, START, np.uint8)
    wide[np.arange(len(data)) + np.repeat(np.arange(n) * step + ORDER, size)] = kernel.LOWER[data]
    last = off[1:] + np.arange(n) * step + ORDER
    wide[last] = END
    key = np.zeros(len(wide), np.uint64)
    for k in range(step):
        key[ORDER:] = (key[ORDER:] << U(8)) | wide[k:len(wide) - ORDER + k]
    mark = np.ones(len(wide), bool)
    for k in range(ORDER):
        mark[off[:-1] + np.arange(n) * step + k] = False
    return key[mark].view(np.int64), off + np.arange(n + 1)


def word_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an end word behind each text, and bounds per text."""
    start, end, first = kernel.words(data, off)
    h = kernel.span_hash(kernel.prefix(kernel.LOWER[data]), start, end).view(np.int64)
    n = len(off) - 1
    return np.insert(h, first[1:], END_WORD), first + np.arange(n + 1)


def _merged(parts: list) -> list:
    keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return [(keys[edge], np.add.reduceat(n, edge) if len(edge) else n)]


def gather(docs: DataFrame, learn: Column) -> DataFrame:
    """kind, key, n: counts over the rows where ``learn`` holds, of all words in these and of all grams in any row."""
    rows = docs.select(F.coalesce(learn, F.lit(False)).alias("learn"), F.col("text").cast("string").alias("text"))

    def run(batches):
        held: dict[int, list] = {WORD: [], GRAM: []}
        waiting = 0

        def flush():
            for kind, parts in held.items():
                if parts:
                    keys, n = _merged(parts)[0]
                    for a in range(0, len(keys), 100_000):
                        m = len(keys[a:a + 100_000])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, kind, np.int32)), pa.array(keys[a:a + m]), pa.array(n[a:a + m])], ["kind", "key", "n"])
                    parts.clear()

        for b in batches:
            learned = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, off, _ in kernel.parts(b.column(1)):
                for kind, keys, bounds in ((WORD, *word_keys(data, off)), (GRAM, *grams(data, off))):
                    use = np.repeat(learned[i:j], np.diff(bounds)).astype(np.int64)
                    if kind == WORD:
                        keys, use = keys[use > 0], use[use > 0]
                    held[kind] += _merged([(keys, use)])
                    waiting += len(held[kind][-1][0])
            if waiting > 500_000:
                for kind in held:
                    if held[kind]:
                        held[kind] = _merged(held[kind])
                waiting = 0
                if sum(len(p[0]) for parts in held.values() for p in parts) > 1_000_000:
                    yield from flush()
        yield from flush()

    return written(rows.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def gram_scores(counted: DataFrame) -> DataFrame:
    """key, score: log10 of the probability of a gram's last symbol after its context."""
    seen = counted.where("n > 0")
    by_order = {ORDER: seen.select("key", "n")}
    for k in range(ORDER - 1, -1, -1):
        by_order[k] = by_order[k + 1].groupBy(F.col("key").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("key")).agg(F.sum("n").alias("n"))
    by_order = {k: written(t, f"order{k}") for k, t in by_order.items()}
    known = by_order[ORDER].withColumn("c", F.shiftrightunsigned("key", 8))
    known = known.join(known.groupBy("c").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")), "c").select(
        "key", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("score"))

    # grams of no training text go through the escapes; only their contexts are looked at from here on
    want = counted.where("n = 0").select("key", F.shiftrightunsigned("key", 8).alias("c5"))
    contexts = want.select("c5").distinct()
    for k in range(ORDER, 0, -1):
        needed = contexts.select(F.col("c5").bitwiseAND((1 << 8 * k) - 1).alias("own")).distinct()
        rows = by_order[k].withColumn("own", F.shiftrightunsigned("key", 8)).join(needed, "own", "left_semi")
        # what a longer context's followers weigh one order below: they are excluded there
        below = by_order[k - 1].select(F.col("key").alias("low"), F.col("n").alias("m"))
        own = rows.withColumn("low", F.col("key").bitwiseAND((1 << 8 * k) - 1)).join(below, "low").groupBy("own").agg(
            F.sum("n").alias(f"t{k}"), F.count("*").alias(f"d{k}"), F.sum("m").alias(f"x{k}"))
        contexts = contexts.join(own, F.col("c5").bitwiseAND((1 << 8 * k) - 1) == F.col("own"), "left").drop("own")
    root = by_order[0].agg(F.sum("n").alias("t0"), F.count("*").alias("d0")).first()
    contexts = contexts.withColumns({"t0": F.lit(root["t0"] or 0).cast("long"), "d0": F.lit(root["d0"] or 0).cast("long")})
    zero = F.lit(0).cast("long")
    # from the longest context down: room (counts plus escape) at each order, and the escapes taken so far
    escape = F.lit(0.0)
    longer_kinds, longer_excluded = zero, zero
    steps = {}
    for k in range(ORDER, -1, -1):
        total, kinds = F.coalesce(f"t{k}", zero), F.coalesce(f"d{k}", zero)
        left, fresh = total - longer_excluded, kinds - longer_kinds
        steps[f"e{k}"], steps[f"r{k}"] = escape, (left + fresh).cast("double")
        escape = escape + F.when(fresh > 0, F.log10(fresh / (left + fresh))).otherwise(0.0)
        longer_kinds = kinds
        longer_excluded = F.coalesce(f"x{k}", zero) if k else zero
    steps["e_"], steps["r_"] = escape, (SYMBOLS - F.coalesce("d0", zero)).cast("double")
    contexts = written(contexts.select("c5", *[v.alias(n) for n, v in steps.items()]), "contexts")

    rows = want.join(contexts, "c5")
    for k in range(ORDER, -1, -1):
        own = by_order[k].select(F.col("key").alias("low"), F.col("n").alias(f"n{k}"))
        own = F.broadcast(own) if k < 2 else own  # at most 256 or 65,536 rows
        rows = rows.join(own, F.col("key").bitwiseAND((1 << 8 * (k + 1)) - 1) == F.col("low"), "left").drop("low")
    score = F.col("e_") - F.log10(F.greatest("r_", F.lit(1.0)))
    for k in range(ORDER + 1):
        score = F.when(F.col(f"n{k}").isNotNull(), F.col(f"e{k}") + F.log10(F.col(f"n{k}") / F.col(f"r{k}"))).otherwise(score)
    return written(known.unionByName(rows.select("key", score.alias("score"))), "scores")


class Lookup:
    """Open hash table from 64-bit keys to values, probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        self.mask = (1 << self.bits) - 1
        self.at = np.full(self.mask + 1, -1, np.int32)
        self.keys, self.values = keys, values
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]
            won = self.at[slot] == left
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys):
        return (kernel.mix(keys.view(np.uint64)) >> U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        slot = self._slot(keys)
        out = self.at[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            out[open_] = self.at[slot[open_]]
            open_ = open_[(out[open_] >= 0) & (self.keys[out[open_]] != keys[open_])]
        return out


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """doc_id, learned, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    ``learn`` says which rows the models learn from (null: not).  ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1)))
    over words and the end word; ``score`` is the log10 probability of the text, capitals folded, under the byte
    model.  Null text counts as empty.
    """
    docs = docs.select("doc_id", "text").withColumn("learn", F.coalesce(learn, F.lit(False)))
    spark = docs.sparkSession
    counts = gather(docs, F.col("learn"))
    words, known_grams = counts.where(F.col("kind") == WORD), counts.where(F.col("kind") == GRAM)
    n_words, kinds, n_grams = counts.agg(F.sum(F.when(F.col("kind") == WORD, F.col("n"))), F.sum((F.col("kind") == WORD).cast("long")),
                                         F.sum(F.when(F.col("kind") == GRAM, F.col("n")))).first()
    n_words, kinds, n_grams = n_words or 0, kinds or 0, n_grams or 0
    room = n_words + 0.1 * (kinds + 1)
    unknown = float(np.log10(0.1 / room))
    word_scores = words.select("key", F.log10((F.col("n") + 0.1) / F.lit(room)).alias("score"), F.lit(1).cast("long").alias("known"))
    scored = gram_scores(known_grams)

    def heavy(table: DataFrame, most: int, total: int) -> DataFrame:
        return table.where(F.col("n") * most >= max(total, 1))

    top_words = heavy(words, HEAVY[WORD], n_words).select("key", F.log10((F.col("n") + 0.1) / F.lit(room)).alias("score")).toArrow()
    top_grams = heavy(known_grams, HEAVY[GRAM], n_grams).join(scored, "key").select("key", "score").toArrow()
    sent = spark.sparkContext.broadcast([(t.column(0).to_numpy(), t.column(1).to_numpy()) for t in (top_words, top_grams)])

    def run(batches):
        (word_key, word_score), (gram_key, gram_score) = sent.value
        tables = {WORD: (Lookup(word_key), word_score), GRAM: (Lookup(gram_key), gram_score)}
        names = ["rid", "doc_id", "learn", "kind", "key", "n", "n_tokens", "n_known", "base", "score"]
        for b in batches:
            for i, j, data, off, _ in kernel.parts(b.column(3)):
                m = j - i
                rid = b.column(0).slice(i, m)
                sums, rare = {}, []
                for kind, keys, bounds in ((WORD, *word_keys(data, off)), (GRAM, *grams(data, off))):
                    table, value = tables[kind]
                    at = table.find(keys)
                    hit = at >= 0
                    got = np.where(hit, value[np.maximum(at, 0)], 0.0) if len(value) else np.zeros(len(keys))
                    sums[kind] = (np.diff(bounds), kernel.per_text(hit.astype(np.int64), bounds), kernel.per_text(got, bounds))
                    lost = np.flatnonzero(~hit)
                    owner = np.searchsorted(bounds, lost, "right") - 1
                    order = np.lexsort((keys[lost], owner))
                    k, o = keys[lost][order], owner[order]
                    edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])) if len(k) else np.zeros(0, int)
                    rare.append((kind, k[edge], o[edge], np.diff(np.append(edge, len(k)))))
                none = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rid, b.column(1).slice(i, m), b.column(2).slice(i, m), pa.array(np.zeros(m, np.int32)), none, none,
                     pa.array(sums[WORD][0]), pa.array(sums[WORD][1]), pa.array(sums[WORD][2]), pa.array(sums[GRAM][2])], names)
                for kind, k, o, n in rare:
                    if len(k):
                        r = len(k)
                        yield pa.RecordBatch.from_arrays(
                            [rid.take(pa.array(o)), pa.nulls(r, b.column(1).type), pa.nulls(r, pa.bool_()), pa.array(np.full(r, kind, np.int32)),
                             pa.array(k), pa.array(n), pa.nulls(r, pa.int64()), pa.nulls(r, pa.int64()), pa.nulls(r, pa.float64()),
                             pa.nulls(r, pa.float64())], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    passed = written(docs.withColumn("rid", F.monotonically_increasing_id()).select(
        "rid", "doc_id", "learn", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"rid long, doc_id {kind}, learn boolean, kind int, key long, n long, n_tokens long, n_known long, base double, score double"), "passed")
    sent.unpersist()
    rare_words = passed.where(F.col("kind") == WORD).select("rid", "key", "n").join(word_scores, "key", "left").groupBy("rid").agg(
        F.sum(F.col("n") * F.coalesce("score", F.lit(unknown))).alias("base"), F.sum(F.col("n") * F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(0.0).alias("score"))
    rare_grams = passed.where(F.col("kind") == GRAM).select("rid", "key", "n").join(scored, "key").groupBy("rid").agg(
        F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("n_known"), F.sum(F.col("n") * F.col("score")).alias("score"))
    whole = passed.where("kind = 0").select("rid", "doc_id", "learn", "n_tokens", "n_known", "base", "score")
    more = rare_words.unionByName(rare_grams).select(
        "rid", F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("boolean").alias("learn"), F.lit(None).cast("long").alias("n_tokens"),
        "n_known", "base", "score")
    return whole.unionByName(more).groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("learn").alias("learned"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(n_words).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("score").alias("score")).drop("rid")
