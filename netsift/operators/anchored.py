"""First-event-anchored windows, exact and parallel inside one key.

A window opens at an event at position ``x`` and holds every later event of the
key below ``x + width``; the first event at or past that end opens the next
window.  Counters that expire a fixed time after creation, rate thresholds
and alert throttles are all this one chain.  It is sequential by definition, so a
busy key would end up in one task.  Here it is computed as a parallel prefix over
slices of the position axis instead:

1. every (key, slice) condenses to a step function "window end on entry -> window
   end on exit" (one row where a quiet spot makes the entry irrelevant);
2. the step functions of neighbouring slices are composed to blocks, then walked once
   per key to learn the state on entry to each block and to each slice;
3. every slice is finished alone, from its entry state.

No task ever holds more than one slice of raw rows, or one block of steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_WIDTHS = 16     # slice length in window widths
BLOCK_SLICES = 32     # slices per block
CELLS = 64            # parts of one window
CELL = ["_k", "win_start", "_cell"]
OPEN = np.iinfo(np.int64).min // 2   # "no window open"


# --- helpers inside tasks ----------------------------------------------------

def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Re-cut sorted Arrow batches so that no group is split; ``i`` numbers the rows of a group from 1."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(batch.column("_i").to_numpy() == 1)
        if len(starts) == 0:
            held.append(batch)
            continue
        done = held + ([batch.slice(0, starts[-1])] if starts[-1] else [])
        if done:
            yield pa.Table.from_batches(done).combine_chunks()
        held = [batch.slice(starts[-1])]
    held = [b for b in held if b.num_rows]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def group_bounds(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row and end of every group, and each row's group number."""
    head = _ints(table, "_i") == 1
    starts = np.flatnonzero(head)
    return starts, np.append(starts[1:], table.num_rows), np.cumsum(head) - 1


def units(table: pa.Table, unit: str) -> tuple[list[int], list[int]]:
    """First row and end of every run of one ``unit`` value inside a group."""
    v = _ints(table, unit)
    starts = np.flatnonzero(np.append(True, v[1:] != v[:-1]) | (_ints(table, "_i") == 1))
    return starts.tolist(), [*starts[1:].tolist(), table.num_rows]


def emit(table: pa.Table, rows: np.ndarray, keep: list[str], **extra: np.ndarray) -> Iterator[pa.RecordBatch]:
    out = table.select(keep).take(pa.array(rows))
    for name, values in extra.items():
        out = out.append_column(name, pa.array(values))
    yield from out.to_batches()


def _next_window(x: np.ndarray, width: np.ndarray, gid: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row the first row of its group at or past ``x + width``, else the group's end."""
    base = x.min()
    span = int(x.max()) - int(base) + int(width.max()) + 1
    if span * len(ends) < 2**62:
        flat = gid.astype(np.int64) * span + (x - base)
        return np.minimum(np.searchsorted(flat, flat + width, side="left"), ends[gid])
    nxt = np.empty(len(x), dtype=np.int64)
    lo = 0
    for hi in ends.tolist():
        nxt[lo:hi] = lo + np.searchsorted(x[lo:hi], x[lo:hi] + width[lo:hi], side="left")
        lo = hi
    return nxt


def _widths(table: pa.Table, fixed: int | None) -> np.ndarray:
    return _ints(table, "_w") if fixed is None else np.full(table.num_rows, fixed, dtype=np.int64)


def _slice_steps(batches: Iterator[pa.RecordBatch], fixed: int | None) -> Iterator[pa.RecordBatch]:
    """(key, slice) rows -> steps (key, slice, upper bound of entry, exit)."""
    for table in whole_groups(batches):
        starts, ends, gid = group_bounds(table)
        x, width = _ints(table, "_x"), _widths(table, fixed)
        nxt = _next_window(x, width, gid, ends)
        last = np.arange(len(x))
        while True:                       # follow the chain to the slice's last window
            ahead = nxt[last]
            more = ahead < ends[gid]
            if not more.any():
                break
            last = np.where(more, ahead, last)
        leave = x[last] + width[last]
        # an entry lies below slice start + width: of the rows past that only the first can open
        late = x >= _ints(table, "_slice") * width * SLICE_WIDTHS + width
        after_late = np.append(False, late[:-1])
        after_late[starts] = False
        kept = np.flatnonzero(~after_late)
        # of equal exits only the largest entry bound matters
        final = np.ones(len(kept), dtype=bool)
        final[:-1] = (gid[kept][1:] != gid[kept][:-1]) | (leave[kept][1:] != leave[kept][:-1])
        rows = kept[final]
        yield from emit(table, rows, ["_k", "_slice"], entry=x[rows], leave=leave[rows])


def _apply_steps(entry: np.ndarray, leave: np.ndarray, at: np.ndarray) -> np.ndarray:
    i = np.searchsorted(entry, at, side="left")
    return np.where(i < len(entry), leave[np.minimum(i, len(entry) - 1)], at)


def _compose(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]):
    entry_1, leave_1 = first
    entry_2, leave_2 = second
    beyond = entry_2 > entry_1[-1]
    entry = np.concatenate([entry_1, entry_2[beyond]])
    leave = np.concatenate([_apply_steps(entry_2, leave_2, leave_1), leave_2[beyond]])
    final = np.append(leave[1:] != leave[:-1], True)
    return entry[final], leave[final]


def _block_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compose the slices of each (key, block)."""
    for table in whole_groups(batches):
        heads = set(group_bounds(table)[0].tolist())
        entry, leave = _ints(table, "entry"), _ints(table, "leave")
        parts: list[list] = []
        for s, e in zip(*units(table, "_slice")):
            piece = (entry[s:e], leave[s:e])
            if s in heads:
                parts.append([s, piece])
            else:
                parts[-1][1] = _compose(parts[-1][1], piece)
        rows = np.repeat([p[0] for p in parts], [len(p[1][0]) for p in parts])
        yield from emit(table, rows, ["_k", "_block"], entry=np.concatenate([p[1][0] for p in parts]),
                         leave=np.concatenate([p[1][1] for p in parts]))


def _walk(batches: Iterator[pa.RecordBatch], unit: str) -> Iterator[pa.RecordBatch]:
    """Carry a group's first ``state`` through its units; yields the state on entry to every unit."""
    for table in whole_groups(batches):
        heads = set(group_bounds(table)[0].tolist())
        entry, leave, first = _ints(table, "entry"), _ints(table, "leave"), _ints(table, "_state")
        starts, ends = units(table, unit)
        states, state = [], OPEN
        for s, e in zip(starts, ends):
            if s in heads:
                state = int(first[s])
            states.append(state)
            state = int(_apply_steps(entry[s:e], leave[s:e], np.array([state]))[0])
        yield from emit(table, np.array(starts), ["_k", unit], _state=np.array(states, dtype=np.int64))


def _finish(batches: Iterator[pa.RecordBatch], payload: list[str], fixed: int | None) -> Iterator[pa.RecordBatch]:
    """Mark the windows of each (key, slice) from its entry state."""
    for table in whole_groups(batches):
        starts, ends, gid = group_bounds(table)
        x, width, carried = _ints(table, "_x"), _widths(table, fixed), _ints(table, "_state")
        nxt = _next_window(x, width, gid, ends)
        below = np.bincount(gid, weights=x < carried, minlength=len(starts)).astype(np.int64)
        cursor, stop = starts + below, ends
        first = np.zeros(len(x), dtype=bool)
        while True:
            live = cursor < stop
            if not live.any():
                break
            cursor, stop = cursor[live], stop[live]
            first[cursor] = True
            cursor = nxt[cursor]
        # a row belongs to the latest opening row of its slice, else to the window carried in
        opened = np.maximum.accumulate(np.where(first, np.arange(len(x)), -1))
        inside = opened >= starts[gid]
        start = np.where(inside, x[np.maximum(opened, 0)], carried - width)
        yield from emit(table, np.arange(len(x)), payload, win_start=start, win_first=first)


# --- the operator ------------------------------------------------------------

def _key(keys: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})


def ordered(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """Rows grouped and sorted, numbered by ``i``.

    The window (and not a plain sort) tells Spark that groups must stay whole, so it will not
    split a large partition of a join feeding it.
    """
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def anchored_windows(
    df: DataFrame,
    keys: list[str],
    position: Column | str,
    width: int | Column,
    order: list[str] | None = None,
    opens_at_width: bool = False,
) -> DataFrame:
    """Add ``win_start`` (position of the window's opening row) and ``win_first``.

    ``position`` and ``width`` are whole numbers in one unit (microseconds for time); width is
    constant within a key and rows without a position are left out.  ``order`` breaks ties between
    rows at one position.  With ``opens_at_width`` (a number as width) the first window of a key
    is already open and ends at position ``width``: rows below that get ``win_start`` 0 and no
    opening row (used for "every time a running total passes a threshold").
    """
    df = df.drop("win_start", "win_first")   # of an earlier pass
    x = F.col(position) if isinstance(position, str) else position
    fixed = None if isinstance(width, Column) else int(width)
    rows = df.withColumns({"_k": _key(keys), "_x": x.cast("long")})
    if fixed is None:
        rows = rows.withColumn("_w", width.cast("long"))
    rows = (rows.withColumn("_slice", F.expr(f"_x div ({'_w' if fixed is None else f'{fixed}L'} * {SLICE_WIDTHS})"))
            .where("_k IS NOT NULL AND _x IS NOT NULL AND _slice IS NOT NULL"))
    # both shuffles below are read twice; the explicit null filters keep the two reads identical,
    # so that Spark runs each of them once
    by_slice = rows.repartition("_k", "_slice")
    steps = (ordered(by_slice, ["_k", "_slice"], ["_x"])
             .mapInArrow(lambda it: _slice_steps(it, fixed), "_k string, _slice long, entry long, leave long"))
    by_block = (steps.withColumn("_block", F.floor(F.col("_slice") / BLOCK_SLICES).cast("long"))
                .where("_k IS NOT NULL AND _block IS NOT NULL").repartition("_k", "_block"))
    blocks = (ordered(by_block, ["_k", "_block"], ["_slice", "entry"])
              .mapInArrow(_block_steps, "_k string, _block long, entry long, leave long"))
    initial = F.lit(width if opens_at_width else OPEN).cast("long")
    block_state = (ordered(blocks.withColumn("_state", initial), ["_k"], ["_block", "entry"])
                   .mapInArrow(lambda it: _walk(it, "_block"), "_k string, _block long, _state long"))
    slice_state = (ordered(by_block.join(block_state, ["_k", "_block"]), ["_k", "_block"], ["_slice", "entry"])
                   .mapInArrow(lambda it: _walk(it, "_slice"), "_k string, _slice long, _state long"))
    payload = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("win_start", T.LongType()),
                           T.StructField("win_first", T.BooleanType())])
    return (ordered(by_slice.join(slice_state, ["_k", "_slice"]), ["_k", "_slice"], ["_x", *(order or [])])
            .mapInArrow(lambda it: _finish(it, payload, fixed), schema))


def throttle(df: DataFrame, keys: list[str], ts: str, seconds: float, order: list[str] | None = None,
             strict: bool = False) -> DataFrame:
    """Keep the first row of each key and then only rows at least ``seconds`` after the last kept one.

    ``strict`` asks for more than ``seconds``.
    """
    width = int(seconds * 1_000_000) + (1 if strict else 0)
    pos = F.unix_micros(F.col(ts).cast("timestamp"))
    return anchored_windows(df, keys, pos, width, order).where("win_first").drop("win_start", "win_first")


def time_windows(df: DataFrame, keys: list[str], ts: str, seconds: int | Column, order: list[str] | None = None,
                 anchor: str = "first_event") -> DataFrame:
    """Add ``win_start`` in microseconds: first-event anchored (exact) or calendar-aligned."""
    pos = F.unix_micros(F.col(ts).cast("timestamp"))
    width = (seconds if isinstance(seconds, Column) else F.lit(seconds)).cast("long") * 1_000_000
    if anchor == "calendar":
        return df.withColumn("win_start", pos - F.pmod(pos, width))
    if anchor != "first_event":
        raise ValueError(f"unknown anchor: {anchor}")
    return anchored_windows(df, keys, pos, width, order).drop("win_first")


def in_cells(df: DataFrame, ts: str, seconds: int | Column, keys: list[str]) -> DataFrame:
    """Rows with ``win_start`` get ``_k`` (the key as text) and ``_cell``, one of ``CELLS`` equal parts of the
    window, and are dealt by both.

    A flood inside one window is spread over its cells; rows at one instant share a cell.
    """
    width = (seconds if isinstance(seconds, Column) else F.lit(seconds)).cast("long") * 1_000_000
    into = F.unix_micros(F.col(ts).cast("timestamp")) - F.col("win_start")
    rows = df.withColumns({"_k": _key(keys), "_cell": F.floor(into * CELLS / width).cast("int")})
    # null filters keep the reads of this shuffle identical, so that it runs once
    return rows.where("_k IS NOT NULL AND win_start IS NOT NULL AND _cell IS NOT NULL").repartition(*CELL)


def numbered(df: DataFrame, keys: list[str], ts: str, seconds: int | Column, order: list[str] | None = None,
             anchor: str = "first_event", at_most: int | None = None) -> DataFrame:
    """``time_windows`` plus ``n``, the running count inside the window.

    Rows are counted inside cells of a window, and the totals of earlier cells are added: no task holds a whole window.
    With ``at_most`` only the first rows of each window are given, and those past them leave before the shuffle.
    """
    rows = time_windows(df, keys, ts, seconds, order, anchor)
    if at_most is not None:
        w = Window.partitionBy(*keys, "win_start").orderBy(ts, *(order or []))
        return rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= at_most)
    rows = in_cells(rows, ts, seconds, keys)
    inside = rows.withColumn("n", F.row_number().over(Window.partitionBy(*CELL).orderBy(ts, *(order or []))))
    totals = rows.groupBy(*CELL).agg(F.count("*").alias("_rows"))
    before = totals.select(*CELL, (F.sum("_rows").over(Window.partitionBy("_k", "win_start").orderBy("_cell"))
                                   - F.col("_rows")).alias("_before"))
    return inside.join(before, CELL).withColumn("n", F.col("n") + F.col("_before")).drop("_k", "_cell", "_before")
