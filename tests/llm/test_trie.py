"""The conversation trie against a plain tree, with nulls, ties, repeats, copies, prefixes and turnless conversations."""

import hashlib
import zlib

import pytest

from netsift.llm import prefixes
from netsift.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def mark(role, text):
    h = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return signed(int(h[:16], 16)), signed(int(h[16:32], 16))


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c, t in own.items():
        t.sort(key=lambda r: (r[0] is not None, r[0] or 0, mark(r[1], r[2])))
        own[c] = [r[1:] for r in t]
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + mine[h:])
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    out = []
    for seq, mem in members.items():
        below = [s for s in members if s[:len(seq)] == seq]
        kids = [s for s in below if len(s) == len(seq) + 1]
        ends = ",".join(map(str, sorted(c for c in mem if len(built[c]) == len(seq))))
        parent = min(members[seq[:-1]]) if seq else None
        out.append((min(mem), len(seq), parent, len(mem), len(kids),
                    sum(not any(len(t) == len(s) + 1 and t[:len(s)] == s for t in members) for s in below),
                    sum((len(members[s]) - 1) * len(s[-1][1]) for s in below if s), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=str)


@pytest.mark.parametrize("cell", [1024, 2])
def test_trie_equals_plain_tree(spark, cell, monkeypatch):
    monkeypatch.setattr(prefixes, "CELL", cell)
    monkeypatch.setattr(prefixes, "ENDS", 7)
    rows = [(c, t, "ab"[t % 2], "x" * ((c % 3) * t % 5) + "é😀") for c in range(0, 12) for t in range(c % 4 + 3)]
    rows += [(100 + c, t, None if t == 1 else "a", None if t == 2 else "copy") for c in range(30) for t in range(6)]   # copies
    rows += [(200 + c, t, "a", "copy" + "!" * (t > c)) for c in range(8) for t in range(9)]                            # shared prefixes
    rows += [(900 + c, t, "a", "no base") for c in range(1, 9) for t in range(c)]                                      # base absent
    rows += [(300, None, "a", "z"), (300, None, "a", "b"), (300, None, "a", "b"), (300, 4, "r", "t"), (300, 4, "q", "t"), (300, -7, "", "")]
    rows += [(301, t, "a", "w" * 3000) for t in range(40)] + [(None, 1, "a", "lost"), (302, 5, None, None)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, n int")
    want = brute(rows)
    assert found(prefixes.trie(df)) == want
    assert len(want) > 80


def test_trie_of_nothing(spark):
    assert prefixes.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_trie_of_the_given_table(spark):
    talks = spark.read.parquet(f"{SF}/conversations.parquet")
    assert found(prefixes.trie(talks)) == brute([tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()])


def test_query_equals_sql(spark):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[1]))
    from oracle import compare, duck

    got, want = compare(spark, duck(SF), SF, QUERIES["op13_conversation_trie"], ORACLES["op13_conversation_trie"])
    assert got == want
