"""Token ids in binary files, compressed by Re-Pair grammars that are built per shard.

Writing: documents are dealt by ranges of doc_id, sorted, encoded, and gathered into shards of about
``shard_tokens`` ids.  In a shard the frequent pairs of neighbouring symbols are replaced by new symbols, a
batch of pairs at a time, until no pair is frequent enough or symbol numbers run out; pairs never reach
across a document's end.  A file holds the rules, every rule's expansion length, the symbols, and per
document its id, its place among the symbols and its number of ids, so one document can be decoded alone.

Files are written under names of their own per task attempt; the table of written files, committed by Spark,
names those that count, so tasks can be repeated.  The folder may be in any file system that pyarrow opens.
"""

from __future__ import annotations

import io
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm import kernel, tokens
from netsift.llm.scratch import folder, written

MAGIC = b"RPGRAM01"
FREE = 65_535  # symbols are stored as 16-bit numbers; this one ends a document
LIMIT = 65_534


def compress(seq: np.ndarray, vocabulary: int, min_count: int = 5, batch: int = 2500) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (pairs of symbols) of a sequence in which ``FREE`` separates documents.

    A rule takes 8 bytes and saves 2 at each place, so from five places on it pays.  A vocabulary that leaves no
    16-bit numbers free is stored without rules; one whose ids do not fit 16 bits beside ``FREE`` is refused.
    """
    rules = [np.zeros((0, 2), np.int64)]
    following = vocabulary
    seq = seq.astype(np.uint16)
    while True:
        room = min(batch, LIMIT - following + 1)
        if room <= 0 or len(seq) < 2:
            break
        key = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
        open_ = (seq[:-1] != FREE) & (seq[1:] != FREE)
        ranked = np.sort(key[open_])
        if not len(ranked):
            break
        edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        count = np.diff(np.append(edge, len(ranked)))
        often = np.flatnonzero(count >= min_count)
        if not len(often):
            break
        if len(often) > room:
            often = often[np.argpartition(-count[often], room - 1)[:room]]
        pairs = np.sort(ranked[edge[often]])
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1) if len(pairs) < 64 else _lookup(pairs, key)
        hit = np.flatnonzero((at >= 0) & (pairs[at] == key) & open_)
        # of neighbouring occurrences that overlap, every other one is replaced
        first = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
        run = np.arange(len(hit)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        hit = hit[run % 2 == 0]
        used, name = np.unique(at[hit], return_inverse=True)
        rules.append(np.stack([pairs[used] >> 16, pairs[used] & 0xFFFF], axis=1).astype(np.int64))
        seq[hit] = (following + name).astype(np.uint16)
        seq = np.delete(seq, hit + 1)
        following += len(used)
    return seq, np.concatenate(rules).astype(np.uint16)


def _lookup(pairs: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each key in ``pairs`` or -1, by a table over hashes; the rare clashes are looked up one by one."""
    bits = 20
    h = lambda x: (x * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    slot = h(pairs)
    table = np.full(1 << bits, -1, np.int32)
    table[slot] = np.arange(len(pairs))
    lost = np.flatnonzero(table[slot] != np.arange(len(pairs)))
    found = table[h(key)]
    for p in lost:
        found[key == pairs[p]] = p
    return found


def lengths_of(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """Number of ids each rule stands for; a rule only uses ids and earlier rules."""
    size = np.ones(vocabulary + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        size[vocabulary + k] = size[a] + size[b]
    return size[vocabulary:]


def expand(symbols: np.ndarray, rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids that symbols stand for."""
    seq = symbols.astype(np.int64)
    while True:
        deep = seq >= vocabulary
        if not deep.any():
            return seq.astype(np.uint32)
        out = np.repeat(seq, deep + 1)
        first = np.flatnonzero(deep) + np.arange(deep.sum())
        pair = rules[seq[deep] - vocabulary]
        out[first], out[first + 1] = pair[:, 0], pair[:, 1]
        seq = out


@dataclass
class Shard:
    """A file's content; ``ids(k)`` decodes its k-th document alone."""

    vocabulary: int
    end_id: int
    rules: np.ndarray
    rule_size: np.ndarray
    symbols: np.ndarray
    doc_id: pa.Array
    place: np.ndarray  # first symbol of each document, then the end
    size: np.ndarray  # ids of each document, with the end id

    def ids(self, k: int) -> np.ndarray:
        own = expand(self.symbols[self.place[k]:self.place[k + 1]], self.rules, self.vocabulary)
        return np.append(own, np.uint32(self.end_id)).astype("<u4")


def pack_shard(doc_id: pa.Array, ids: list[np.ndarray], vocabulary: int, end_id: int) -> bytes:
    """File content for documents given without their end ids."""
    if vocabulary > FREE or any(len(own) and int(own.max()) >= vocabulary for own in ids):
        raise ValueError(f"ids must be below the vocabulary's size, and that at most {FREE}")
    flat = np.full(sum(map(len, ids)) + len(ids), FREE, np.uint16)
    at = 0
    for own in ids:
        flat[at:at + len(own)] = own
        at += len(own) + 1
    symbols, rules = compress(flat, vocabulary)
    ends = np.flatnonzero(symbols == FREE)
    place = np.concatenate([[0], ends - np.arange(len(ends))])
    arrays = [rules.ravel(), lengths_of(rules, vocabulary).astype("<u4"), symbols[symbols != FREE],
              place.astype("<i8"), np.array([len(x) + 1 for x in ids], "<i8")]
    out = io.BytesIO()
    out.write(MAGIC)
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", doc_id.type)])) as w:
        w.write_batch(pa.record_batch([doc_id], ["doc_id"]))
    head = np.array([vocabulary, end_id, *map(len, arrays), len(sink.getvalue())], "<i8")
    out.write(head.tobytes())
    for a in arrays:
        out.write(a.tobytes())
    out.write(sink.getvalue())
    return out.getvalue()


def read_shard(content: bytes) -> Shard:
    if content[:8] != MAGIC:
        raise ValueError("not a grammar file")
    head = np.frombuffer(content, "<i8", 8, 8)
    at, arrays = 8 + 64, []
    for n, kind in zip(head[2:7], ("<u2", "<u4", "<u2", "<i8", "<i8")):
        arrays.append(np.frombuffer(content, kind, n, at))
        at += int(n) * np.dtype(kind).itemsize
    table = pa.ipc.open_stream(content[at:at + int(head[7])]).read_all()
    return Shard(int(head[0]), int(head[1]), arrays[0].reshape(-1, 2), arrays[1], arrays[2],
                 table.column(0).combine_chunks(), arrays[3], arrays[4])


def write(docs: DataFrame, tokenizer: str, end_id: int = 2, shard_tokens: int = 2_000_000, vocabulary: int = 50_257) -> DataFrame:
    """Write all rows of ``docs``; returns the committed table of files: partition, shard, path, n_docs, n_tokens."""
    target = folder(docs.sparkSession, "tokens")
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first()))

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root)
        encode, part = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        attempt, number = uuid.uuid4().hex[:12], 0
        held_ids: list[pa.Array] = []
        held: list[np.ndarray] = []
        n = 0

        def flush():
            nonlocal n, number
            path = f"{root}/part-{part:06d}-{number:05d}-{attempt}.rpg"
            with store.open_output_stream(path) as f:
                f.write(pack_shard(pa.concat_arrays(held_ids), held, vocabulary, end_id))
            row = pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, number, path, len(held), n)],
                                             ["partition", "shard", "path", "n_docs", "n_tokens"])
            held.clear()
            held_ids.clear()
            n, number = 0, number + 1
            return row

        for b in batches:
            for i, j, data, off, _ in kernel.parts(b.column(1)):
                ids, bounds = encode(data, off)
                held_ids.append(b.column(0).slice(i, j - i))
                held.extend(ids[bounds[k]:bounds[k + 1]] for k in range(j - i))
                n += len(ids) + j - i
                if n >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    made = rows.mapInArrow(run, "partition long, shard long, path string, n_docs long, n_tokens long")
    return written(made.withColumn("root", F.lit(target)), "files")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files that ``write`` returned, decoded from them.

    ``start`` counts the ids of all documents before it.  Partition totals (one number per partition) pass the driver.
    """
    spark = files.sparkSession
    totals = sorted((r["partition"], r["n"]) for r in files.groupBy("partition").agg(F.sum("n_tokens").alias("n")).collect())
    bases, at = [], 0
    for part, n in totals:
        bases.append((part, at))
        at += n
    base = F.broadcast(spark.createDataFrame(bases, "partition long, base long"))
    before = Window.partitionBy("partition").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.join(base, "partition").select(
        "path", "root", (F.col("base") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).alias("start"))
    kind = files.select(F.lit(0).cast("long").alias("doc_id"))

    def run(batches):
        from pyarrow import fs

        for b in batches:
            for path, root, start in zip(*(c.to_pylist() for c in b.columns)):
                store, _ = fs.FileSystem.from_uri(root)
                with store.open_input_stream(path) as f:
                    shard = read_shard(f.read())
                whole = expand(shard.symbols, shard.rules, shard.vocabulary).astype("<u4")
                cut = np.cumsum(shard.size - 1) - (shard.size - 1)
                end = np.array([shard.end_id], "<u4").tobytes()
                crc = [zlib.crc32(end, zlib.crc32(whole[a:a + n - 1].tobytes())) for a, n in zip(cut, shard.size)]
                yield pa.RecordBatch.from_arrays(
                    [shard.doc_id, pa.array(start + np.cumsum(shard.size) - shard.size), pa.array(shard.size),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = f"doc_id {kind.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long"
    spread = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartition(spread, "path").mapInArrow(run, schema)
