"""The numbered operators applied to whole tables with their production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm import language, minhash, packing, pieces, pii, ppm, prefixes, quality, repair, sharding, spelling, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def TOKENIZER() -> str:
    """Place of the byte-level BPE's file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # whole texts travel in Arrow batches: few rows a batch keep the workers small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(n: int, column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


@query
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(remainder(4) != 2))
    held = F.coalesce(remainder(4) == 2, F.lit(False))
    return language.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")


@query
def op2_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    scored = ppm.score(table(spark, sf, "documents"), remainder(10) != 0)
    held = F.coalesce(remainder(10) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_warc_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return warc.payloads(warc.write(warc.records(table(spark, sf, "pages"))))


@query
def op4_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf, "embeddings"), threshold=0.93)


@query
def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), TOKENIZER(), size=2048, end_id=0)


@query
def op6_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_data(table(spark, sf, "documents"))


@query
def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return repair.read(repair.write(table(spark, sf, "documents"), TOKENIZER(), end_id=2))


@query
def op8_pieces(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(table(spark, sf, "documents"), model, digest=True)


@query
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.judge(docs, quality.train(docs, table(spark, sf, "labels")))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), percent=80, width=2)


@query
def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


@query
def op12_shard_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assignments(table(spark, sf, "documents"), shards=24)


#: crc32 of a number's decimal form; DuckDB has no such function
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""

ORACLES["op13_conversation_trie"] = f"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS n,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC.format("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (SELECT c.conv_id, 0 AS part, o.n, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.n < c.h
  UNION ALL SELECT c.conv_id, 1, o.n, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.n >= c.h),
seqs AS (SELECT c.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY part, n) FILTER (WHERE n IS NOT NULL), []) AS s
  FROM convs c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
steps AS (SELECT conv_id, len(s) AS whole, s, unnest(range(len(s) + 1)) AS depth FROM seqs),
nodes AS (SELECT depth, s[1:depth] AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole = depth), '')) AS ends_sha256
  FROM steps GROUP BY ALL),
kids AS (SELECT k[1:depth - 1] AS k, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, k)),
below AS (SELECT k, (n_children = 0)::BIGINT AS leaf, CASE WHEN depth > 0 THEN (n_convs - 1) * length(k[depth].t) ELSE 0 END AS gain,
    unnest(range(depth + 1)) AS top FROM counted),
sums AS (SELECT top AS depth, k[1:top] AS k, sum(leaf)::BIGINT AS n_leaves, sum(gain)::BIGINT AS saved_tokens FROM below GROUP BY ALL)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (depth, k) LEFT JOIN nodes p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.k = c.k[1:c.depth - 1]"""


@query
def op13_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.trie(table(spark, sf, "conversations"))
