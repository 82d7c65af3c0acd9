"""Indicator values inside running text and URLs.

All values go into one Aho-Corasick automaton per task, which reads a whole text once whatever their number.  Values travel
to the tasks in pieces of at most ``PIECE_BYTES``, one pass over the texts a piece, so what a task holds does not grow with
the list.  What the automaton finds is confirmed by its neighbours and joined exactly to the list's details.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_BYTES = 8 << 20
FOLDED = ("domain", "hash", "ip", "ja3")     # compared without regard to case


def _word(c: str) -> bool:
    return c.isalnum() or c in "-_"


def confirmed(kind: str, text: str, start: int, end: int) -> bool:
    """A value counts where it is not part of a longer word; a domain or address also not where more labels follow.

    A domain may follow a dot (a name under it); an address may not.
    """
    before, after = text[start - 1] if start else " ", text[end] if end < len(text) else " "
    if kind == "url":      # a URL ends where white space, a quote or the text ends
        return not _word(before) and (after.isspace() or after in "\"'<>)")
    if _word(before) or _word(after) or (kind == "ip" and before == "."):
        return False
    return kind not in ("domain", "ip") or not (after == "." and end + 1 < len(text) and text[end + 1].isalnum())


def _scan(batches: Iterator[pa.RecordBatch], values: list[tuple[str, str]], keys: int) -> Iterator[pa.RecordBatch]:
    import ahocorasick

    folded, plain = ahocorasick.Automaton(), ahocorasick.Automaton()
    for kind, value in values:
        machine, form = (folded, value.lower()) if kind in FOLDED else (plain, value)
        machine.add_word(form, [*machine.get(form, []), (kind, value)])
    for m in (folded, plain):
        m.make_automaton()
    for b in batches:
        row, start, kind, value = [], [], [], []
        for i, text in enumerate(b.column(keys).to_pylist()):
            if not text:
                continue
            # lower-casing only ASCII keeps positions
            for machine, form in ((folded, text.translate(_LOWER)), (plain, text)):
                if not len(machine):
                    continue
                for last, found in machine.iter(form):
                    for k, v in found:
                        if confirmed(k, text, last + 1 - len(v), last + 1):
                            row.append(i)
                            start.append(last + 1 - len(v))
                            kind.append(k)
                            value.append(v)
        if row:
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(at) for k in range(keys)), pa.array(start, pa.int64()), pa.array(kind), pa.array(value)],
                [*b.schema.names[:keys], "start", "ioc_type", "ioc_value"])


_LOWER = {c: c + 32 for c in range(65, 91)}


def indicators_in(df: DataFrame, indicators: DataFrame, keys: list[str], column: str,
                  kinds: list[str] = ("url", "hash", "domain", "ip"), piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``keys``, start (code points), ioc_type, ioc_value, ioc_family, ioc_role, ioc_confidence of every occurrence.

    Values may overlap or hold one another: each occurrence of each is reported.  Null texts have none; null or empty values are
    left out of the list; letters of domains, hashes and addresses are compared without case (A-Z only).
    """
    wanted = indicators.where(F.col("type").isin(list(kinds)) & (F.length("value") > 0)).select(
        F.col("type").alias("ioc_type"), F.col("value").alias("ioc_value"), F.col("family").alias("ioc_family"),
        F.col("role").alias("ioc_role"), F.col("confidence").alias("ioc_confidence")).distinct()
    listed = wanted.select("ioc_type", "ioc_value").distinct()
    total = listed.agg(F.sum(F.octet_length("ioc_value") + 64)).first()[0] or 0
    pieces = -(-total // piece_bytes) or 1
    texts = df.select(*keys, F.col(column).cast("string").alias("_text"))
    schema = T.StructType([*[texts.schema[k] for k in keys], T.StructField("start", T.LongType()), T.StructField("ioc_type", T.StringType()),
                           T.StructField("ioc_value", T.StringType())])
    found = None
    for piece in range(pieces):
        mine = listed.where(F.pmod(F.xxhash64("ioc_value"), F.lit(pieces)) == piece)
        values = [(r[0], r[1]) for r in mine.collect()]        # about piece_bytes
        part = texts.mapInArrow(lambda it, v=values: _scan(it, v, len(keys)), schema)
        found = part if found is None else found.unionByName(part)
    return found.join(wanted, ["ioc_type", "ioc_value"]).select(
        *keys, "start", "ioc_type", "ioc_value", "ioc_family", "ioc_role", "ioc_confidence")
