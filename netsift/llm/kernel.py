"""Byte-level text kernels in numpy, run inside Arrow batches that Spark deals out.

A batch is worked in slices of about ``SLICE`` bytes, so memory stays a small multiple of that (or of the
longest single text).  All hashes are 64-bit and equal on every machine.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = 1 << 18
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C1B
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


def worker_store() -> types.ModuleType:
    """A module-like place that lives as long as the Python worker, across tasks."""
    return sys.modules.setdefault("_netsift_worker_store", types.ModuleType("_netsift_worker_store"))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    store = worker_store()
    have = getattr(store, "powers", None)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE * 2)
        forward = np.full(size, BASE, np.uint64)
        back = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        forward[0] = back[0] = 1
        have = store.powers = (np.cumprod(forward), np.cumprod(back))
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


def parts(column: pa.Array):
    """Slices (first row, past last row, bytes, offsets, is null) of a string column; null counts as empty."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    flat = column.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    raw = flat.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(flat):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE, "right")) - 1)
        j = min(j, len(flat))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i], null[i:j]
        i = j


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True; no run crosses a text's border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    begin = off[:-1][off[:-1] < len(inside)]
    first[begin] = inside[begin]
    end = off[1:][off[1:] > 0] - 1
    last[end] = inside[end]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes other than space and 0x09-0x0D) and, per text, the index of its first word."""
    start, end = runs(~SPACE[data], off)
    return start, end, np.searchsorted(start, off)


def prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` takes differences of it."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(len(data) + 1)[0][:len(data)], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span's bytes, wherever it stands."""
    h = (running[end] - running[start]) * _powers(len(running))[1][start]
    return mix(h ^ ((end - start).astype(np.uint64) * U(0xA0761D6478BD642F)))


def window_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n consecutive values; windows may cross texts, the caller leaves those out."""
    out = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for k in range(n):
        out = out * U(0x9FB21C651E98DF25) + h[k:k + len(out)]
        out ^= out >> U(31)
    return mix(out)


def per_text(values: np.ndarray, bounds: np.ndarray, cut: int = 0) -> np.ndarray:
    """Sums of values[bounds[k] : bounds[k+1] - cut]."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    last = np.minimum(np.maximum(bounds[1:] - cut, bounds[:-1]), len(values))
    return total[last] - total[np.minimum(bounds[:-1], len(values))]


def column_like(values, kind: T.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary()}.get(kind.simpleString())
    return pa.array(values, arrow)


def map_texts(docs: DataFrame, make, fields: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One output row per input row: the kept columns, then the columns of ``make()(bytes, offsets, null)``.

    ``make`` is called once per task.  ``fields`` is a DDL string naming the new columns.
    """
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    made = T.StructType.fromDDL(fields)
    schema = T.StructType(picked.schema.fields[:-1] + made.fields)
    names = schema.names

    def run(batches):
        work = make()
        for b in batches:
            for i, j, data, off, null in parts(b.column(len(keep))):
                new = [column_like(v, f.dataType) for v, f in zip(work(data, off, null), made.fields)]
                old = [b.column(k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(old + new, names)

    return picked.mapInArrow(run, schema)


def text_column(make, kind: str):
    """A column function: ``make()(bytes, offsets, null)`` gives one value per text, in Arrow batches."""
    import collections.abc

    arrow = {"boolean": pa.bool_(), "double": pa.float64()}[kind]

    def run(columns: collections.abc.Iterator[pa.Array]) -> collections.abc.Iterator[pa.Array]:
        work = make()
        for column in columns:
            found = [work(data, off, null) for _, _, data, off, null in parts(column)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), arrow)

    run.__annotations__ = {"columns": collections.abc.Iterator[pa.Array], "return": collections.abc.Iterator[pa.Array]}
    return F.arrow_udf(run, kind)
