"""Domain word lists: one name per line, ``#`` comments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_words(spark: SparkSession, path: str | list[str], label: int) -> DataFrame:
    word = F.trim("value")
    return spark.read.text(path).where((word != "") & ~F.startswith(word, F.lit("#"))).select(
        word.alias("domain"), F.lit(label).alias("label"))


def labelled(spark: SparkSession, benign: str | list[str], generated: str | list[str], *more: DataFrame) -> DataFrame:
    """Union of the benign (0) and generated (1) lists and any further labelled rows."""
    return reduce(DataFrame.unionByName, [read_words(spark, benign, 0), read_words(spark, generated, 1), *more])
