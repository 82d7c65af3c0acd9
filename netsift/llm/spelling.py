"""Spelling variants: words one edit apart, found by probing generated edits in Bloom filters of the vocabulary.

The vocabulary is counted in Spark.  Each length has its own stretch of 512-bit blocks in one blocked Bloom filter (lengths from
``LONG`` on share one).  The filter is broadcast in pieces of at most ``FILTER_BYTES``, one round a piece, so what an
executor holds does not grow with the vocabulary.  Every deletion and every replacement by a larger letter of every
word is probed (an insertion is a deletion seen from the other word, a smaller letter a larger one), from rolling hashes: the
edited words themselves are built only for positives.  Only positives shuffle, to an exact join with the vocabulary that removes
the filter's false ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.kernel import mix
from netsift.llm.scratch import written

U = np.uint64
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.int64)    # A-Z never occur: they are lower-cased
RUN = "[A-Za-zÀ-ÿ]"
SHORT, LONG = 6, 64            # words have at least SHORT code points
BITS_PER_WORD, PROBES, LANES = 16, 6, 8
FILTER_BYTES = 32 << 20
WORDS_PER_TASK = 5_000
CHUNK = 1 << 13                # positions worked at once, each with all letters
BASE = 0x9E3779B97F4A7C55
BACK = pow(BASE, -1, 1 << 64)
JUMPS = 5                      # a form has at least five times the count: chains are shorter than 2 ** 5


def vocabulary(docs: DataFrame, slip: int = 199, least: int = 5) -> DataFrame:
    """word, n: runs of letters after the planted slips, of at least ``SHORT`` code points and ``least`` occurrences.

    With h = crc32("<doc_id>:<run>"), a run with h divisible by ``slip`` loses its code point h % length.  A null id is
    written as nothing, a null or empty text has no runs, repeated rows count again.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # a shorter run cannot become a word: slips only shorten
    runs = docs.select(doc.alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{SHORT},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, lower)).otherwise(F.col("run")))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= SHORT).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least))


# --- hashes of words and of their edits ----------------------------------------

def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points end to end, first position of each word, length of each word."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return code, np.cumsum(size) - size, size


def _hash(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(total ^ (size.astype(np.uint64) * U(0xA0761D6478BD642F)))


class Hashed:
    """Words of a batch with their rolling hashes."""

    def __init__(self, words: list[str]):
        self.code, self.first, self.size = _flat(words)
        self.owner = np.repeat(np.arange(len(words)), self.size)
        self.within = np.arange(len(self.code)) - self.first[self.owner]
        power = np.full(int(self.size.max(initial=0)) + 1, BASE, np.uint64)
        power[0] = 1
        self.power = np.cumprod(power)[self.within]
        self.sums = np.zeros(len(self.code) + 1, np.uint64)
        np.cumsum(self.code.astype(np.uint64) * self.power, out=self.sums[1:])
        self.total = self.sums[self.first + self.size] - self.sums[self.first]

    def whole(self) -> np.ndarray:
        return _hash(self.total, self.size)

    def deleted(self, at: np.ndarray) -> np.ndarray:
        word = self.owner[at]
        before = self.sums[at] - self.sums[self.first[word]]
        after = self.sums[(self.first + self.size)[word]] - self.sums[at + 1]
        return _hash(before + after * U(BACK), self.size[word] - 1)

    def replaced(self, at: np.ndarray, letter: np.ndarray) -> np.ndarray:
        word = self.owner[at]
        step = (letter - self.code[at]).astype(np.uint64)
        return _hash(self.total[word] + step * self.power[at], self.size[word])


class Layout:
    """Blocks of each length: ``first[k]`` and ``blocks[k]`` for the lengths' shards."""

    def __init__(self, words_by_shard: dict[int, int]):
        count = np.array([words_by_shard.get(k, 0) for k in range(LONG + 1)], np.int64)
        self.blocks = -(-count * BITS_PER_WORD // 512)
        self.first = np.cumsum(self.blocks) - self.blocks
        self.total = int(self.blocks.sum())

    def places(self, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each hash (-1 where its length has no word) and the hash that picks bits inside it."""
        shard = np.minimum(size, LONG)
        blocks = self.blocks[shard]
        block = self.first[shard] + (h % np.maximum(blocks, 1).astype(np.uint64)).astype(np.int64)
        return np.where(blocks > 0, block, -1), mix(h ^ U(BASE))


def _bit(inside: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lane and bit of the k-th probe."""
    nine = ((inside >> U(9 * k)) & U(511)).astype(np.int64)
    return nine >> 6, (nine & 63).astype(np.uint64)


def _masks(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Words -> (lane number in the whole filter, bits to set)."""
    for b in batches:
        words = Hashed(b.column(0).to_pylist())
        block, inside = layout.places(words.whole(), words.size)
        for k in range(PROBES):
            lane, bit = _bit(inside, k)
            yield pa.RecordBatch.from_arrays([pa.array(block * LANES + lane), pa.array((U(1) << bit).view(np.int64))],
                                             ["lane", "mask"])


def _positives(batches: Iterator[pa.RecordBatch], layout: Layout, low: int, lanes) -> Iterator[pa.RecordBatch]:
    """Words -> (word, n, edited word) whose edit the piece of the filter from block ``low`` on may hold."""
    filled = lanes.value
    high = low + len(filled) // LANES

    def hits(h: np.ndarray, size: np.ndarray) -> np.ndarray:
        block, inside = layout.places(h, size)
        left = np.flatnonzero((block >= low) & (block < high))
        for k in range(PROBES):
            lane, bit = _bit(inside[left], k)
            left = left[(filled[(block[left] - low) * LANES + lane] >> bit) & U(1) == 1]
        return left

    for b in batches:
        names = b.column(0).to_pylist()
        words = Hashed(names)
        word, edit = [], []
        for begin in range(0, len(words.code), CHUNK):
            at = np.arange(begin, min(begin + CHUNK, len(words.code)))
            # of a run of equal letters any deletion gives the same word: take the first
            same = (words.within[at] > 0) & (words.code[at] == words.code[np.maximum(at - 1, 0)])
            gone = at[~same & (words.size[words.owner[at]] > SHORT)]
            for p in gone[hits(words.deleted(gone), words.size[words.owner[gone]] - 1)].tolist():
                w, i = int(words.owner[p]), int(words.within[p])
                word.append(w)
                edit.append(names[w][:i] + names[w][i + 1:])
            row, column = np.nonzero(LETTERS[None, :] > words.code[at][:, None])
            spot, letter = at[row], LETTERS[column]
            for j in hits(words.replaced(spot, letter), words.size[words.owner[spot]]).tolist():
                w, i = int(words.owner[spot[j]]), int(words.within[spot[j]])
                word.append(w)
                edit.append(names[w][:i] + chr(letter[j]) + names[w][i + 1:])
        if word:
            picked = pa.array(word, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(picked), b.column(1).take(picked), pa.array(edit, pa.string())],
                                             ["word", "n", "edit"])


# --- the operator --------------------------------------------------------------

def neighbours(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, near, near_n: every ordered pair of words exactly one edit apart.

    ``words(word, n)`` holds distinct words of at least ``SHORT`` letters of a-z and U+00C0 to U+00FF; empty gives empty.
    """
    spark = words.sparkSession
    shard = F.least(F.char_length("word"), F.lit(LONG))
    by_shard = {r[0]: r[1] for r in words.groupBy(shard.alias("s")).count().collect()}     # at most LONG rows
    layout = Layout(by_shard)
    tasks = max(1, -(-sum(by_shard.values()) // WORDS_PER_TASK))
    dealt = words.select("word", "n").repartition(tasks)
    masks = words.select("word").mapInArrow(lambda it: _masks(it, layout), "lane long, mask long")
    masks = masks.groupBy("lane").agg(F.bit_or("mask").alias("mask"))
    per_round = max(1, filter_bytes // (LANES * 8))
    if layout.total > per_round:
        masks = written(masks, "filter")
    found = None
    for low in range(0, layout.total, per_round):
        high = min(low + per_round, layout.total)
        part = masks.where(F.col("lane").between(low * LANES, high * LANES - 1)).toArrow()    # at most filter_bytes of bits
        filled = np.zeros((high - low) * LANES, np.uint64)
        filled[part.column("lane").to_numpy() - low * LANES] = part.column("mask").to_numpy().view(np.uint64)
        lanes = spark.sparkContext.broadcast(filled)
        maybe = dealt.mapInArrow(lambda it, a=low, v=lanes: _positives(it, layout, a, v), "word string, n long, edit string")
        if layout.total > per_round:
            maybe = written(maybe, "positives")
            lanes.destroy()
        found = maybe if found is None else found.unionByName(maybe)
    if found is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    pairs = written(found.join(known, "edit").select("word", "n", F.col("edit").alias("near"), "near_n"), "near")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                                          F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for each row of ``forms(word, form)``: the end of its chain, by ``JUMPS`` pointer doublings."""
    step = written(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(JUMPS):
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(step.join(ahead, "root", "left")
                        .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return step


def variants(docs: DataFrame, slip: int = 199, least: int = 5, ratio: int = 5, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if that n is at least ``ratio`` times the
    word's, else null; ``root`` is where the forms lead, the word itself without one.  An empty table gives an
    empty result; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent as its variants")
    words = written(vocabulary(docs, slip, least), "vocabulary")
    near = neighbours(words, filter_bytes)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("top"))
    formed = F.when(-F.col("top.m") >= F.col("n") * ratio, F.col("top.near"))
    table = written(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                            formed.alias("form"), (-F.col("top.m")).alias("top_n")), "forms")
    led = roots(table.where("form is not null").select("word", "form"))
    return (table.join(led, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                    F.when(F.col("form").isNotNull(), F.col("top_n")).alias("form_n")))
