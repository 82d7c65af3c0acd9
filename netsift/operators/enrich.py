"""Joins with reference data: indicators, address ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.constants import INDICATORS
from netsift.functions.net import ip_to_long
from netsift.functions.text import labels


def published_indicators(spark: SparkSession) -> DataFrame:
    """The fixed indicator list: type, value, family, role, confidence."""
    return spark.createDataFrame(INDICATORS, "type string, value string, family string, role string, confidence string")


def match_values(df: DataFrame, indicators: DataFrame, kind: str, column: str) -> DataFrame:
    """Rows whose ``column`` equals an indicator of that kind, with the indicator's details.

    The side is not hinted: Spark broadcasts it only while its size is under the session's limit.
    """
    wanted = indicators.where(F.col("type") == kind).select(
        F.col("value").alias(column), F.col("type").alias("ioc_type"), F.col("family").alias("ioc_family"),
        F.col("role").alias("ioc_role"), F.col("confidence").alias("ioc_confidence"))
    return df.join(wanted.distinct(), column)


def match_domains(df: DataFrame, indicators: DataFrame, column: str = "query") -> DataFrame:
    """Rows whose name is, or lies under, an indicator domain; one row per matching indicator.

    Each name is expanded to its suffixes of two or more labels, so the match is an equi join.
    """
    parts = labels(F.lower(column))
    suffixes = F.when(F.size(parts) >= 2, F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    wanted = indicators.where(F.col("type") == "domain").select(
        F.lower("value").alias("ioc_value"), F.col("family").alias("ioc_family"), F.col("role").alias("ioc_role"))
    return df.withColumn("ioc_value", F.explode(suffixes)).join(wanted.distinct(), "ioc_value")


def addresses_in_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Every dotted IPv4 written in a text, one row per occurrence."""
    found = F.regexp_extract_all(F.col(column), F.lit(r"\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b"), F.lit(1))
    return df.withColumn("ip", F.explode(found))


def located(addresses: DataFrame, ranges: DataFrame, ip: str) -> DataFrame:
    """``ip``, country, lat, lon of each distinct address that a range covers.

    ``ranges`` holds disjoint ``ip_start, ip_end, country, lat, lon`` with numeric ends.  Range starts and addresses are merged in
    order and each address takes the last start before it.  The merge is cut at every 65,536 addresses: ranges are
    clipped there, so no part depends on another, and as addresses are distinct and ranges disjoint a part has at most
    131,072 rows, however crowded it is.
    """
    block = lambda c: F.shiftright(c, 16)
    clipped = ranges.select("ip_start", "ip_end", F.struct("ip_end", "country", "lat", "lon").alias("range"),
                            F.explode(F.sequence(block("ip_start"), block("ip_end"))).alias("block"))
    starts = clipped.select("block", F.greatest("ip_start", F.col("block") * 65536).alias("at"), F.lit(0).alias("side"), "range",
                            F.lit(None).cast("string").alias(ip))
    single = addresses.select(ip, ip_to_long(ip).alias("at")).where("at is not null").distinct()
    points = single.select(block("at").alias("block"), "at", F.lit(1).alias("side"),
                           F.lit(None).cast(clipped.schema["range"].dataType).alias("range"), ip)
    order = Window.partitionBy("block").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    near = starts.unionByName(points).withColumn("range", F.last("range", ignorenulls=True).over(order))
    return near.where((F.col("side") == 1) & (F.col("range.ip_end") >= F.col("at"))).select(
        ip, F.col("range.country").alias("country"), F.col("range.lat").alias("lat"), F.col("range.lon").alias("lon"))


def _joined(df: DataFrame, found: DataFrame, ip: str, prefix: str) -> DataFrame:
    side = found.select(F.col("_address").alias(ip), *[F.col(c).alias(f"{prefix}_{c}") for c in ("country", "lat", "lon")])
    return df.join(side, ip, "left").select(*df.columns, *side.columns[1:])


def locate(df: DataFrame, ranges: DataFrame, ip: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_country``, ``_lat`` and ``_lon`` from address ranges; null where none covers the address.

    Distinct addresses are located once (``located``) and joined back by equality.
    """
    return _joined(df, located(df.select(F.col(ip).alias("_address")), ranges, "_address"), ip, prefix)


def locate_both(df: DataFrame, ranges: DataFrame, src: str = "id_orig_h", dst: str = "id_resp_h") -> DataFrame:
    both = df.select(F.explode(F.array_distinct(F.array(src, dst))).alias("_address"))
    found = located(both, ranges, "_address")
    return _joined(_joined(df, found, dst, "dst_geo"), found, src, "src_geo")
