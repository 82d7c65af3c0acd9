"""Readers for sensor logs: header-driven TSV and JSON lines."""

from __future__ import annotations

import os
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift import schemas

UNSET = "-"


def _as_type(c: Column, kind: str) -> Column:
    """Text to a log type; what cannot be read becomes null."""
    if kind == "time":
        return F.timestamp_micros((c.try_cast("decimal(20,6)") * 1_000_000).cast("long"))
    if kind == "interval":
        return c.try_cast("double")
    if kind == "count":
        return F.coalesce(c.try_cast("long"), c.try_cast("double").try_cast("long"))
    if kind == "port":
        return c.try_cast("int")
    if kind == "bool":
        return F.when(c.isin("T", "true"), True).when(c.isin("F", "false"), False)
    return c


def coerce(values: dict[str, Column], kind: str) -> list[Column]:
    """Typed columns with underscored names; undeclared columns stay text."""
    declared = schemas.columns(kind)
    return [_as_type(c, declared.get(name, "string")).alias(name.replace(".", "_")) for name, c in values.items()]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def _headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Field names of each distinct header with the files that carry it; only headers reach the driver."""
    found = (_lines(spark, path).where(F.startswith("value", F.lit("#fields")))
             .groupBy("file").agg(F.collect_set("value").alias("headers")).collect())
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, headers in found:
        if len(headers) > 1:
            raise ValueError(f"{file} changes its #fields within the file; split it at its headers")
        groups.setdefault(tuple(headers[0].split("\t")[1:]), []).append(unquote(file))
    return groups


def read_tsv(spark: SparkSession, path: str | list[str], kind: str | None = None) -> DataFrame:
    """TSV logs whose columns come from each file's own ``#fields`` line.

    Lines with another number of fields than their header are dropped, as are other ``#`` lines and files without
    a header.  Files may differ in columns; a column a file lacks is null for its rows.  Files of one header are
    read together, so lines are neither joined nor shuffled.  A file whose headers differ raises ValueError.
    """
    kind = kind or kind_of(path)
    groups = _headers(spark, path)
    if not groups:
        return spark.createDataFrame([], T.StructType([]))
    declared = list(schemas.columns(kind))
    names = sorted({n for fields in groups for n in fields},
                   key=lambda n: (declared.index(n) if n in declared else len(declared), n))
    whole = None
    for fields, files in groups.items():
        rows = spark.read.text(files).where(~F.startswith("value", F.lit("#"))).select(
            F.split("value", "\t", -1).alias("parts")).where(F.size("parts") == len(fields))
        place = {n: i for i, n in enumerate(fields)}
        values = {n: F.nullif(F.get("parts", F.lit(place[n])), F.lit(UNSET)) if n in place else F.lit(None).cast("string")
                  for n in names}
        part = rows.select(*coerce(values, kind))
        whole = part if whole is None else whole.unionByName(part)
    return whole


def json_schema(kind: str, extra: list[str] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*schemas.columns(kind), *extra]])


def _from_json(df: DataFrame, kind: str) -> DataFrame:
    values = {n: F.nullif(F.col(f"`{n}`"), F.lit(UNSET)) for n in df.columns}
    return df.select(*coerce(values, kind))


def undeclared(spark: SparkSession, path: str | list[str], kind: str) -> list[str]:
    """Names of the fields in JSON lines that the log kind does not declare, from all lines."""
    names = spark.read.text(path).select(F.explode(F.map_keys(F.from_json("value", "map<string,string>"))).alias("n")).distinct()
    return sorted(r.n for r in names.where(~F.col("n").isin(*schemas.columns(kind))).collect())


def read_json(spark: SparkSession, path: str | list[str], kind: str | None = None, extra: list[str] | None = None) -> DataFrame:
    """JSON-lines logs: the declared columns, and all others as text; unreadable lines are dropped.

    The names of other fields are looked up in one pass over the lines; naming them in ``extra`` saves that pass.
    """
    kind = kind or kind_of(path)
    extra = undeclared(spark, path, kind) if extra is None else extra
    raw = spark.read.schema(json_schema(kind, extra)).json(path, mode="DROPMALFORMED")
    return _from_json(raw, kind)


def read_json_with_rejects(spark: SparkSession, path: str | list[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """The readable rows, and the rejected lines with an error message."""
    schema = json_schema(kind).add("_corrupt_record", T.StringType())
    parsed = spark.read.text(path).where(F.trim("value") != "").select(
        "value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    bad = F.col("r._corrupt_record").isNotNull()
    rejects = parsed.where(bad).select(F.col("value").alias("line"), F.lit("unreadable line").alias("error_message"),
                                       F.lit(kind).alias("dataset"))
    return _from_json(parsed.where(~bad).select("r.*").drop("_corrupt_record"), kind), rejects


def kind_of(path: str | list[str]) -> str:
    """Log kind from the file name: the text before its first dot."""
    first = path if isinstance(path, str) else path[0]
    return os.path.basename(first.rstrip("/")).split(".")[0]


def formats(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """Files with a ``#fields`` line, and the other files that hold JSON objects."""
    kinds = _lines(spark, path).groupBy("file").agg(
        F.max(F.startswith("value", F.lit("#fields"))).alias("tsv"), F.max(F.startswith(F.ltrim("value"), F.lit("{"))).alias("json")).collect()
    return [unquote(r.file) for r in kinds if r.tsv], [unquote(r.file) for r in kinds if r.json and not r.tsv]


def read_log(spark: SparkSession, path: str | list[str], kind: str | None = None) -> DataFrame:
    """Read logs in either format, file by file; a column that one format lacks is null for its rows."""
    kind = kind or kind_of(path)
    tsv, objects = formats(spark, path)
    if not objects:
        return read_tsv(spark, tsv or path, kind)
    found = read_json(spark, objects, kind)
    return read_tsv(spark, tsv, kind).unionByName(found, allowMissingColumns=True) if tsv else found


def _loader(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def load(spark: SparkSession, path: str | list[str]) -> DataFrame:
        return read_log(spark, path, kind)

    load.__name__, load.__doc__ = kind, f"Read a {kind} log."
    return load


conn, dns, http, ssl, notice, files, weird = map(_loader, ("conn", "dns", "http", "ssl", "notice", "files", "weird"))
