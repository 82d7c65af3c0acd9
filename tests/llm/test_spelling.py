"""Spelling variants against a plain search, over odd texts, one and many filter pieces."""

import collections
import re
import zlib

import pytest

from netsift.llm import spelling

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = [chr(c) for c in spelling.LETTERS]


def brute(rows):
    count = collections.Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    form, near = {}, {}
    for w, n in words.items():
        edits = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + a + w[i:] for i in range(len(w) + 1) for a in LETTERS}
        edits |= {w[:i] + a + w[i + 1:] for i in range(len(w)) for a in LETTERS}
        near[w] = {e for e in edits if e in words and e != w}
        best = min(near[w], key=lambda e: (-words[e], e), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def found(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    out = [(1, None), (2, ""), (3, " \n 12 <> \U0001f600"), (None, "letters letters letterz"), (4, "Letters LETTERS letters lettres")]
    for k, (word, n) in enumerate([("colour", 700), ("color", 9), ("colours", 120), ("colourss", 20), ("colouré", 6), ("cölours", 24),
                                   ("aaaaaaa", 40), ("aaaaaaaa", 8), ("aaaaaaaaa", 8), ("aaaaaab", 40), ("×÷×÷×÷", 30),
                                   ("×÷×÷×÷÷", 5), ("four44", 50), ("lonely" + "y" * 300, 5),
                                   ("lonely" + "y" * 301, 30), ("x" * 70 + "q", 5), ("x" * 70 + "r", 26), ("ÀBÇDEFG", 10), ("àbçdefg", 60)]):
        out += [(1000 * k + i // 50, " ".join([word] * min(50, n - i))) for i in range(0, n, 50)]
    out += [(7, "same row words words") for _ in range(20)] + [(50_000 + i, "wordsmith Wordsmyth") for i in range(600)]
    return out + [(90_000, "hidden " * 30_000)]


@pytest.mark.parametrize("filter_bytes", [32 << 20, 64, 256])
def test_variants_equal_plain_search(spark, rows, filter_bytes):
    df = spark.createDataFrame([(*r, "w", 3) for r in rows], "doc_id long, text string, word string, n int")
    got = found(spelling.variants(df, filter_bytes=filter_bytes))
    assert got == brute(rows)
    assert any(r[1] and r[2] != r[1] for r in got)          # a chain of forms


def test_hashes_of_edits_are_those_of_the_edited_words():
    words = spelling.Hashed(["colour", "aaaéÿ", "x" * 200])
    import numpy as np
    for p in (0, 3, 5, 6, 9, 10, 11, 150, 210):
        w = ["colour", "aaaéÿ", "x" * 200][words.owner[p]]
        i = int(words.within[p])
        at = np.array([p])
        assert words.deleted(at)[0] == spelling.Hashed([w[:i] + w[i + 1:]]).whole()[0]
        assert words.replaced(at, np.array([0xfe]))[0] == spelling.Hashed([w[:i] + "þ" + w[i + 1:]]).whole()[0]


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "rare words only")], "doc_id long, text string")).count() == 0


def test_variants_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert found(spelling.variants(docs)) == brute([tuple(r) for r in docs.collect()])
