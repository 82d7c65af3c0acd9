"""Prefix trie of conversations by collapsing whole sequences.

1. Turns are numbered and each becomes a 128-bit fingerprint (SHA-256 of role and text).  Texts are never shuffled.
2. A prefix of d turns has a 128-bit key: the exclusive or of its turns' fingerprints, each hashed with its position.
   Keys and lengths run along a conversation by cells of ``CELL`` turns whose totals are carried on, so a conversation
   of any length is spread over many tasks.
3. Identical conversations collapse to one weighted sequence with the list of its ends.  Only one conversation of each, the
   smallest, goes on; a group of copies of any size costs one row a turn.
4. Sequences that are proper prefixes of others leave by an anti-join; what stays are the leaves.
5. Weighted prefixes of the sequences are aggregated to nodes.

``saved_tokens`` needs no walk over the tree.  With w a sequence's weight, L its length in code points and B(v) the
length before node v's last turn, the sum of n * chars over v's subtree is the sum of w * (L - B(v)) over the sequences
through v.  Each node belongs to the sequence of its smallest member, which owns the nodes of its path from some depth on; with
A the length before the first of them, the sum of chars over v's subtree is the sum of L - max(A, B(v)).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm.scratch import written

CELL = 1024
ENDS = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


def _halves(of: Column) -> tuple[Column, Column]:
    """Two 64-bit halves of a SHA-256."""
    digest = F.sha2(of, 256)
    half = lambda k: F.conv(F.substring(digest, k, 16), 16, -10).cast("long")
    return half(1), half(17)


def turns(talks: DataFrame) -> DataFrame:
    """conv_id, n (from 0), a, b (fingerprint), chars of each turn, ordered by turn (null first).

    Null roles and texts count as empty; rows at one turn are ordered by their fingerprint, equal rows stay separate
    turns.  Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the role's length before the role: no two pairs give one string
    a, b = _halves(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    marked = talks.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), a.alias("a"),
                                                       b.alias("b"), F.char_length(text).cast("long").alias("chars"))
    same = marked.groupBy("conv_id", "turn", "a", "b", "chars").agg(F.count("*").alias("m"))
    same = same.withColumn("cell", F.coalesce(F.floor(F.col("turn") / CELL).cast("long"), F.lit(-(1 << 63))))
    order = Window.partitionBy("conv_id", "cell").orderBy(F.col("turn").asc_nulls_first(), "a", "b", "chars")
    inside = same.withColumn("n", F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("m"))
    totals = same.groupBy("conv_id", "cell").agg(F.sum("m").alias("all"))
    before = totals.select("conv_id", "cell", (F.sum("all").over(Window.partitionBy("conv_id").orderBy("cell"))
                                               - F.col("all")).alias("before"))
    first = F.col("before") + F.col("n")
    return (inside.join(before, ["conv_id", "cell"])
            .select("conv_id", F.explode(F.sequence(first, first + F.col("m") - 1)).alias("n"), "a", "b", "chars"))


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id) and the turns (conv_id, n, a, b, chars) of each as rebuilt.

    Conversation c is the first h turns of conversation c - c % 100, then its own after its first h, with
    h = crc32(c as text) % 6.  Of a base only its first five turns, for at most 100 conversations, are ever sent.
    """
    talks = own.groupBy("conv_id").agg(F.count_if(F.col("n") < 5).alias("opening"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    talks = talks.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % 100})
    base = talks.select(F.col("conv_id").alias("base"), F.col("opening").alias("at_base"))
    talks = talks.join(base, "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("at_base", F.lit(0))).alias("taken"))
    head = (talks.join(own.where("n < 5 and conv_id % 100 = 0").withColumnRenamed("conv_id", "base"), "base")
            .where("n < h").select("conv_id", "n", "a", "b", "chars"))
    tail = (own.join(talks, "conv_id").where("n >= h")
            .select("conv_id", (F.col("n") - F.col("h") + F.col("taken")).alias("n"), "a", "b", "chars"))
    return talks.select("conv_id"), head.unionByName(tail)


def paths(talk_turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), key (p, q), the parent's key (up_p, up_q), chars, length before the turn of each prefix."""
    placed = talk_turns.withColumns({"x": F.xxhash64("a", "b", "n"), "y": F.xxhash64("b", "n", "a", F.lit(1)),
                                     "cell": F.expr(f"n div {CELL}")})
    order = Window.partitionBy("conv_id", "cell").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumns({"px": F.bit_xor("x").over(order), "py": F.bit_xor("y").over(order),
                              "so_far": F.sum("chars").over(order)})
    totals = placed.groupBy("conv_id", "cell").agg(F.bit_xor("x").alias("tx"), F.bit_xor("y").alias("ty"),
                                                   F.sum("chars").alias("tc"))
    cells = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    nil = F.lit(0).cast("long")
    carried = totals.select("conv_id", "cell", F.coalesce(F.bit_xor("tx").over(cells), nil).alias("cx"),
                            F.coalesce(F.bit_xor("ty").over(cells), nil).alias("cy"),
                            F.coalesce(F.sum("tc").over(cells), nil).alias("cc"))
    p, q = F.col("px").bitwiseXOR(F.col("cx")), F.col("py").bitwiseXOR(F.col("cy"))
    return run.join(carried, ["conv_id", "cell"]).select(
        "conv_id", (F.col("n") + 1).alias("depth"), p.alias("p"), q.alias("q"), p.bitwiseXOR(F.col("x")).alias("up_p"),
        q.bitwiseXOR(F.col("y")).alias("up_q"), "chars", (F.col("so_far") + F.col("cc") - F.col("chars")).alias("before"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, p, q, k, ids) sorted by node and k: one SHA-256 a node, fed part by part."""
    node, digest, done = None, None, []
    for b in batches:
        for depth, p, q, _, ids in zip(*(c.to_pylist() for c in b.columns)):
            if (depth, p, q) == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, p, q), hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield _rows(done)
            done = []
    if node is not None:
        yield _rows([(*node, digest.hexdigest())])


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c) for c in zip(*found)]
    return pa.RecordBatch.from_arrays(columns, ["depth", "p", "q", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending ids of each node's ends (conv_id, depth, p, q).

    Ids are joined in blocks of ``ENDS`` numbers by as many tasks as there are blocks; the digest itself is one
    sequence by definition and streams over the blocks without holding them.
    """
    node = ["depth", "p", "q"]
    block = ends.withColumn("k", F.floor(F.col("conv_id") / ENDS).cast("long"))
    parts = block.groupBy(*node, "k").agg(F.concat_ws(",", F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))
    placed = parts.repartition(*node).sortWithinPartitions(*node, "k").select(*node, "k", "ids")
    return placed.mapInArrow(_digests, "depth long, p long, q long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  Null roles and texts are empty, rows without conv_id are left out, equal turns of one
    conversation follow one another by fingerprint, turnless conversations end at the root; repeated rows are repeated
    turns; other columns are ignored.  An empty table has no node, not even the root.
    """
    own = written(turns(conversations), "turns")
    talks, rows = rebuilt(own)
    walk = written(paths(rows), "paths")
    talks = written(talks, "talks")
    nil = F.lit(0).cast("long")
    root = {"depth": nil, "p": nil, "q": nil}

    # whole sequences: the key of the longest prefix; a conversation without turns is the empty sequence
    last = walk.groupBy("conv_id").agg(F.max(F.struct("depth", "p", "q", (F.col("before") + F.col("chars")).alias("length"))).alias("z"))
    ends = talks.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col("z")[c], nil).alias(c) for c in ("depth", "p", "q", "length")])
    ends = written(ends, "ends")
    node = ["depth", "p", "q"]
    sequences = written(ends.groupBy(*node).agg(F.count("*").alias("w"), F.min("conv_id").alias("conv_id"),
                                                F.max("length").alias("length")), "sequences")

    # prefixes of the weighted sequences, the empty one included
    above = walk.join(sequences.select("conv_id", "w", "length", F.col("depth").alias("whole")), "conv_id")
    start = sequences.select("conv_id", *[c.alias(k) for k, c in root.items()], F.lit(None).cast("long").alias("up_p"),
                             F.lit(None).cast("long").alias("up_q"), nil.alias("chars"), nil.alias("before"), "w", "length",
                             F.col("depth").alias("whole"))
    above = written(above.unionByName(start), "prefixes")
    proper = above.where("depth < whole").select(*node).distinct()
    leaves = sequences.join(proper, node, "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    smallest = above.groupBy(*node).agg(F.min("conv_id").alias("owner"))
    owned = (above.join(smallest, node).where("conv_id = owner")
             .groupBy("conv_id").agg(F.min("before").alias("own_from")))
    # a sequence that owns no node shares all of them with smaller ones: nothing of it is counted once more
    weighted = (above.join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
                .withColumn("own_from", F.coalesce("own_from", "length")))
    nodes = weighted.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), F.min("up_p").alias("up_p"), F.min("up_q").alias("up_q"),
        F.sum("w").alias("n_convs"), F.count("leaf").alias("n_leaves"),
        F.sum(F.col("w") * (F.col("length") - F.col("before"))
              - (F.col("length") - F.greatest("own_from", "before"))).alias("saved_tokens"))
    nodes = written(nodes, "nodes")

    up = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_p").alias("p"),
                                          F.col("up_q").alias("q")).agg(F.count("*").alias("n_children"))
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("up_p"), F.col("q").alias("up_q"),
                          F.col("conv_id").alias("parent_conv_id"))
    done = (nodes.join(up, node, "left").join(end_digests(ends), node, "left")
            .join(parent, ["depth", "up_p", "up_q"], "left"))
    return done.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", nil).alias("n_children"),
                       "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
