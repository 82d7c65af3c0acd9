"""Shards of the two-pass shuffle: whole, even, gapless, mixed, the same when run again."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.llm import sharding
from netsift.llm.scratch import folder

SF = "/root/testdata/sf0.001"


def check(rows, want, shards):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(want, key=str)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def wanted(texts):
    data = [(i, (t or "").encode()) for i, t in texts]
    return [(i, len(b) + 8, zlib.crc32(b)) for i, b in data]


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_odd_rows(spark, sent, monkeypatch):
    monkeypatch.setattr(sharding, "FIRSTS_SENT", sent)
    texts = [(None, None), (None, ""), (1, "é😀"), (1, "é😀"), (2, "long " * 40_000)] + [(7, "hot")] * 300 + [(k, f"t{k}") for k in range(200)]
    df = spark.createDataFrame([(*t, 1, "x") for t in texts], "doc_id long, text string, slot int, Shard string")
    check(sharding.assignments(df, 24, bucket_bytes=4096).collect(), wanted(texts), 24)
    path = sharding.write(df, folder(spark, "test"), 3, bucket_bytes=4096)
    back = sharding.read(df, path)
    assert back.columns == ["doc_id", "text", "slot_", "Shard_", "slot", "shard"]
    assert back.where("slot_ = 1 and Shard_ = 'x'").count() == len(texts)
    # hot rows are spread: no shard holds much more than its third of them
    hot = [r["count"] for r in back.where("doc_id = 7 and text = 'hot'").groupBy("shard").count().collect()]
    assert len(hot) == 3 and max(hot) < 140


def test_fewer_rows_than_shards_and_none(spark):
    df = spark.createDataFrame([(k, "t") for k in range(5)], "doc_id long, text string")
    check(sharding.assignments(df, 24).collect(), wanted([(k, "t") for k in range(5)]), 24)
    assert sharding.assignments(df.where("false"), 24).count() == 0


def test_given_table_is_mixed_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = {r.doc_id: (r.shard, r.slot) for r in sharding.assignments(docs, 4, seed=5, bucket_bytes=1 << 16).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in sharding.assignments(docs, 4, seed=5, bucket_bytes=1 << 16).collect()}
    other = {r.doc_id: (r.shard, r.slot) for r in sharding.assignments(docs, 4, seed=6, bucket_bytes=1 << 16).collect()}
    assert one == two != other
    ids = sorted(one)
    assert abs(np.corrcoef(range(len(ids)), [one[i][0] * 1000 + one[i][1] for i in ids])[0, 1]) < 0.3
    check(sharding.assignments(docs, 24).collect(), wanted([tuple(r) for r in docs.select("doc_id", "text").collect()]), 24)
    # rows of a shard stand in the order of their slots
    path = sharding.write(docs, folder(spark, "test"), 2, bucket_bytes=1 << 16)
    files = sharding.read(docs, path).withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    assert files.groupBy("f").agg(F.sort_array(F.collect_list(F.struct("i", "slot"))).alias("s")).where(
        "s.slot <> array_sort(s.slot)").isEmpty()
