"""Stateful checks that give the batch result whatever order files arrive in.

Rows of a key are held until the watermark has passed them and are then worked in time order, so rows out of
order by less than the watermark delay count as in batch.  What a key holds is its rows inside that delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from netsift.operators import dns as dns_ops
from netsift.operators import rules as rule_ops

_US = 1_000_000


class Ordered(StatefulProcessor):
    """Holds rows (``us`` and the columns of ``fields``) and hands them to ``work`` in the order of ``by``."""

    def __init__(self, fields: str, by: list[str]):
        self.fields, self.by = f"us long, {fields}", by
        self.names = [f.name for f in T.StructType.fromDDL(self.fields).fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.fields)
        self.until = handle.getValueState("until", "us long")     # when the counters of the key are void

    def work(self, key, rows: pd.DataFrame) -> tuple[pd.DataFrame | None, int]:
        """Rows to report and the time from which the state of the key says nothing."""
        raise NotImplementedError

    def forget(self) -> None:
        """Drop the counters of the key."""
        raise NotImplementedError

    def arm(self, us: int) -> None:
        """One timer at most: the earliest of those asked for."""
        due = us // 1000 + 1
        have = list(self.handle.listTimers())
        if have and min(have) <= due:
            return
        for timer in have:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            if len(frame):
                self.held.appendList(list(frame[self.names].astype(object).itertuples(index=False, name=None)))
                low = int(frame["us"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self.arm(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = pd.DataFrame(list(self.held.get()) if self.held.exists() else [], columns=self.names)
        ready = rows[rows["us"] <= now].sort_values(["us", *self.by], kind="stable").reset_index(drop=True)
        later = rows[rows["us"] > now]
        found = None
        if len(ready):
            found, until = self.work(key, ready)
            self.until.update((until,))
            if len(later):
                self.held.put(list(later.astype(object).itertuples(index=False, name=None)))
            else:
                self.held.clear()
        until = self.until.get()[0] if self.until.exists() else None
        ends = [int(later["us"].min())] if len(later) else []
        if until is not None and until <= now and not len(later):
            self.forget()
            self.until.clear()
        elif until is not None:
            ends.append(max(until, now))
        if ends:
            self.handle.registerTimer(min(ends) // 1000 + 1)
        if found is not None and len(found):
            yield found

    def close(self) -> None:
        pass


# --- all rule thresholds at once -----------------------------------------------

class RuleThresholds(Ordered):
    """Counts per rule of one source, in windows that their first match opens; ``limits`` is sid -> (mode, count, width)."""

    def __init__(self, limits: dict[int, tuple[str, int, int]], fields: str, by: list[str]):
        super().__init__(f"sid int, {fields}", ["table", *by])
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.counts = handle.getMapState("counts", "sid int", "opened long, seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        free = [f[~f["sid"].isin(list(self.limits))] for f in frames]       # no threshold: reported at once
        yield from super().handleInputRows(key, iter([f[f["sid"].isin(list(self.limits))] for f in frames]), timerValues)
        for frame in free:
            if len(frame):
                yield self.shaped(key, frame)

    def shaped(self, key, frame: pd.DataFrame) -> pd.DataFrame:
        return frame[self.names].assign(src=key[0])

    def work(self, key, rows):
        passed = np.zeros(len(rows), bool)
        until = 0
        for sid, places in rows.groupby("sid").indices.items():
            mode, count, width = self.limits[int(sid)]
            opened, seen = self.counts.getValue((int(sid),)) if self.counts.containsKey((int(sid),)) else (None, 0)
            us = rows["us"].to_numpy()[places]
            number = np.empty(len(us), np.int64)
            at = 0
            while at < len(us):
                if opened is None or us[at] >= opened + width:
                    opened, seen = int(us[at]), 0
                end = int(np.searchsorted(us, opened + width, side="left"))
                number[at:end] = seen + np.arange(1, end - at + 1)
                seen, at = seen + end - at, end
            self.counts.updateValue((int(sid),), (opened, int(seen)))
            passed[places] = number <= count if mode == "limit" else number == count
        for sid in list(self.counts.keys()):
            until = max(until, self.counts.getValue(sid)[0] + self.limits[int(sid[0])][2])
        return self.shaped(key, rows[passed]), until

    def forget(self) -> None:
        self.counts.clear()


def rule_alerts(tables: dict[str, DataFrame], rules: list[rule_ops.Rule] = rule_ops.ALL_RULES, order: list[str] = ("uid",),
                watermark: str = "10 minutes") -> DataFrame:
    """``rules.alerts`` over streams: every rule of every table in one query, each with its own threshold.

    A thresholded match is reported when the watermark has passed it, one without a threshold at once.
    """
    order = list(order)
    hits = rule_ops.matches({name: df.withWatermark("ts", watermark) for name, df in tables.items()}, rules, order)
    if hits is None:
        raise ValueError("no rule applies to the given tables")
    limits = {r.sid: (r.threshold[0], r.threshold[1], r.threshold[2] * _US) for r in rules if r.threshold}
    carried = ["table", "dst", *order]
    ddl = ", ".join(f"`{c}` {hits.schema[c].dataType.simpleString()}" for c in carried)
    keyed = hits.select("src", "ts", F.unix_micros("ts").alias("us"), F.col("sid").cast("int").alias("sid"), *carried)
    found = keyed.groupBy("src").transformWithStateInPandas(
        statefulProcessor=RuleThresholds(limits, ddl, order), outputStructType=f"us long, sid int, {ddl}, src string",
        outputMode="append", timeMode="EventTime")
    return rule_ops.described(found.withColumn("ts", F.timestamp_micros("us")), rules, order)


# --- two coupled counters ------------------------------------------------------

class NxRatio(Ordered):
    """All and failed lookups of one source since its window opened; both restart at a hit and with the window."""

    def __init__(self, ratio: float, min_queries: int, width_us: int, fields: str, by: list[str]):
        super().__init__(f"nx boolean{', ' + fields if fields else ''}", by)
        self.limit, self.min_queries, self.width = Fraction(str(ratio)), min_queries, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.pair = handle.getValueState("pair", "opened long, total long, missed long")

    def work(self, key, rows):
        opened, total, missed = self.pair.get() if self.pair.exists() else (None, 0, 0)
        us, nx = rows["us"].to_numpy(), rows["nx"].to_numpy().astype(bool)
        out, at = [], 0
        while at < len(us):
            if opened is None or us[at] >= opened + self.width:
                opened, total, missed = int(us[at]), 0, 0
            end = int(np.searchsorted(us, opened + self.width, side="left"))
            hits, missed, total = dns_ops.ratio_hits(nx[at:end], self.limit, self.min_queries, missed, total)
            out += [(at + i, bad, seen) for i, bad, seen in hits]
            at = end
        self.pair.update((opened, total, missed))
        if not out:
            return None, opened + self.width
        place, bad, seen = map(list, zip(*out))
        return rows.iloc[place].assign(src=key[0], nxdomains=bad, queries=seen), opened + self.width

    def forget(self) -> None:
        self.pair.clear()


def nxdomain_ratio(dns: DataFrame, ratio: float = 0.70, min_queries: int = 20, window_seconds: int = 300, order: list[str] = (),
                   watermark: str = "10 minutes") -> DataFrame:
    """``dns.sensor_nxdomain_ratio`` over a stream, same columns; a hit is reported when the watermark has passed it."""
    order = list(order)
    src = dns_ops.SRC
    keyed = dns.withWatermark("ts", watermark).select(
        F.col(src).alias("src"), "ts", F.unix_micros("ts").alias("us"), F.coalesce(F.col("rcode") == 3, F.lit(False)).alias("nx"), *order)
    ddl = ", ".join(f"`{c}` {keyed.schema[c].dataType.simpleString()}" for c in order)
    found = keyed.groupBy("src").transformWithStateInPandas(
        statefulProcessor=NxRatio(ratio, min_queries, window_seconds * _US, ddl, order),
        outputStructType=f"us long, nx boolean{', ' + ddl if ddl else ''}, src string, nxdomains long, queries long",
        outputMode="append", timeMode="EventTime")
    return dns_ops.ratio_findings(found.withColumns({"ts": F.timestamp_micros("us"), src: F.col("src")}), order)
