"""A training corpus from ``documents``: five stages, each applying one operator to all that the last one kept.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and reread as the
next one's input.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm import language, minhash, packing, pii, quality
from netsift.llm.queries import TOKENIZER, remainder, table
from netsift.llm.scratch import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the classifier accepts; it learns from three quarters of the labelled rows."""
    model = language.train(docs.where(remainder(4) != 2))
    return language.accepted_rows(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the calibrated classifier."""
    return quality.kept_rows(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (five-word shingles, similarity 0.8)."""
    return minhash.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; every span found is replaced by the name of its kind."""
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER())


STAGES = [
    ("language ID", identify_language),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("PII", mask_personal_data),
    ("best-fit packing", pack),
]

#: The first stage's trained model has no SQL form; the tests of each operator hold plain
#: versions, that of the stages only looks at columns, row counts and that all ids are packed.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
