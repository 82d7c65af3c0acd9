"""Reader for the alert engine's JSON event stream.

Declared fields become typed columns; every other field, nested ones included, stays in the VARIANT column ``extra`` at the
path it had.  ``field`` reads from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift import schemas


def coerce(df: DataFrame) -> DataFrame:
    """Numeric fields and the timestamp to their types, keeping the nesting; bad values become null."""

    def cast(path: list[str], field: T.StructField) -> Column:
        here = [*path, field.name]
        c = F.col(".".join(here))
        if isinstance(field.dataType, T.StructType):
            inner = F.struct(*[cast(here, f).alias(f.name) for f in field.dataType.fields])
            return F.when(c.isNotNull(), inner)
        kind = schemas.EVENT_NUMBERS.get(".".join(here))
        return c.try_cast(kind) if kind else c

    out = df.select(*[cast([], f).alias(f.name) for f in df.schema.fields])
    return out.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def _object(event: Column, path: str) -> Column:
    """The fields at a path as a map; null where there is no object."""
    return F.try_variant_get(event, path, "map<string,variant>")


def _declared(event: Column, schema: T.StructType, path: str = "$") -> list[Column]:
    """Declared fields as they are in the schema, scalars read as text; a struct is null where the event has no object."""
    out = []
    for f in schema.fields:
        here = f"{path}.{f.name}"
        if isinstance(f.dataType, T.StructType):
            value = F.when(_object(event, here).isNotNull(), F.struct(*_declared(event, f.dataType, here)))
        else:
            value = F.try_variant_get(event, here, "string").try_cast(f.dataType)
        out.append(value.alias(f.name))
    return out


def _leftover(event: Column, schema: T.StructType, path: str = "$") -> Column:
    """Map of all fields that the schema lacks; a declared object contributes what is undeclared inside it."""
    inner = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, T.StructType)}
    scalars = [f.name for f in schema.fields if f.name not in inner]
    whole = _object(event, path)

    def kept(k: Column, v: Column) -> Column:
        """Undeclared, or a declared object that is something else in this event."""
        odd = v.try_cast("map<string,variant>").isNull() & ~F.is_variant_null(v)
        return ~k.isin(*scalars, *inner) | (k.isin(*inner) & odd)

    parts = [F.map_filter(whole, kept)]
    for name, kind in inner.items():
        rest = _leftover(event, kind, f"{path}.{name}")
        parts.append(F.when(F.size(rest) > 0, F.create_map(F.lit(name), F.to_variant_object(rest).cast("variant"))).otherwise(
            F.create_map().cast("map<string,variant>")))
    return F.map_concat(*parts) if len(parts) > 1 else parts[0]


def field(path: str, kind: str = "string", column: str = "extra") -> Column:
    """An undeclared field by its dotted path, such as ``fileinfo.sha256``; null where absent or not of that type."""
    return F.try_variant_get(F.col(column), f"$.{path}", kind)


def as_events(raw: DataFrame, event: str = "event") -> DataFrame:
    """Declared fields of a VARIANT column as typed columns, the rest in ``extra`` (null where there is none)."""
    schema = T.StructType.fromDDL(schemas.EVENTS)
    kept = raw.select(event, _leftover(F.col(event), schema).alias("rest"))
    rest = F.when(F.size("rest") > 0, F.to_variant_object("rest")).alias("extra")
    return coerce(kept.select(*_declared(F.col(event), schema), rest))


def parsed(lines: DataFrame, text: str = "value") -> DataFrame:
    """Events of JSON texts, one per row; texts that are no JSON object are left out.

    A text that names a field twice has no VARIANT form: its declared fields are read (the last one counts), others are lost.
    """
    twice = F.to_variant_object(F.from_json(text, schemas.EVENTS))
    # explode keeps the filters on the event behind the parser, so that each text is parsed once
    events = lines.select(F.explode(F.array(F.coalesce(F.try_parse_json(text), twice))).alias("event"))
    return as_events(events.where(_object(F.col("event"), "$").isNotNull()))


def _of_types(events: DataFrame, event_types: list[str] | None) -> DataFrame:
    return events.where(F.col("event_type").isin(event_types or schemas.EVENT_TYPES))


def read_events(spark: SparkSession, path: str | list[str], event_types: list[str] | None = None,
                max_rows: int | None = None, array_file: bool = False) -> DataFrame:
    """Events of the supported (or given) types.

    ``array_file`` reads a file that holds one JSON array; such a file is read by a single task.
    ``max_rows`` caps the rows only when asked for.  ``extra`` is a VARIANT: drop it before ``distinct`` or grouping by all columns.
    """
    raw = spark.read.text(path, wholetext=array_file)
    if array_file:
        twice = F.transform(F.from_json("value", f"array<struct<{_fields()}>>"), F.to_variant_object)
        every = F.coalesce(F.from_json("value", "array<variant>"), twice, F.array(F.try_parse_json("value")))
        events = as_events(raw.select(F.explode(every).alias("event")))
    else:
        events = parsed(raw)
    kept = _of_types(events, event_types)
    return kept if max_rows is None else kept.limit(max_rows)


def _fields() -> str:
    return T.StructType.fromDDL(schemas.EVENTS).simpleString().removeprefix("struct<").removesuffix(">")


def read_alerts(spark: SparkSession, path: str | list[str], array_file: bool = False) -> DataFrame:
    return read_events(spark, path, ["alert"], array_file=array_file)
