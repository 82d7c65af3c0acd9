"""Streaming forms of the running checks.

Calendar checks are plain watermarked windows.  First-event checks keep one small state per key
in the state store: when the window opened, a count or total, the last alert.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


# --- calendar windows --------------------------------------------------------

def tumbling_counts(stream: DataFrame, keys: list[str], interval: str, watermark: str = "10 minutes",
                    ts: str = "ts", slide: str | None = None) -> DataFrame:
    """Rows per key and tumbling (or sliding) window; appended once a window closes."""
    w = F.window(ts, interval, slide) if slide else F.window(ts, interval)
    return (stream.withWatermark(ts, watermark).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("count"))
            .select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "count"))


def tumbling_sums(stream: DataFrame, keys: list[str], value: str, interval: str, watermark: str = "10 minutes",
                  ts: str = "ts") -> DataFrame:
    return (stream.withWatermark(ts, watermark).groupBy(F.window(ts, interval).alias("w"), *keys)
            .agg(F.sum(value).alias("total"))
            .select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "total"))


def distinct_targets(stream: DataFrame, key: str, target: str, interval: str, watermark: str = "10 minutes",
                     ts: str = "ts") -> DataFrame:
    """Approximate distinct targets per key and window."""
    return (stream.withWatermark(ts, watermark).groupBy(F.window(ts, interval).alias("w"), key)
            .agg(F.approx_count_distinct(target, 0.01).alias("targets"))
            .select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "targets"))


def suppress(stream: DataFrame, watermark: str = "1 hour", identifier: str = "identifier", ts: str = "ts") -> DataFrame:
    """First notice of an identifier within the watermark delay."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([identifier])


# --- first-event windows -----------------------------------------------------

def _gathered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """One key's rows of a batch in time order (they may come in several frames)."""
    return pd.concat(list(rows), ignore_index=True).sort_values(["us", "seq"], kind="stable")


class _Windowed(StatefulProcessor):
    """Common state handling: the window's opening time, a number, and the last alert."""

    def __init__(self, width_us: int, timeout_us: int | None = None):
        self.width, self.keep = width_us, timeout_us or width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "opened long, amount double, last long")

    def load(self) -> list:
        if self.state.exists():
            opened, amount, last = self.state.get()
            return [opened, amount, last]
        return [None, 0.0, None]

    def store(self, opened, amount, last, now_us: int) -> None:
        self.state.update((opened, amount, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((now_us + self.keep) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


class ThresholdCounter(_Windowed):
    """Counts in windows opened by their first event.

    ``limit`` passes the first n rows, ``both`` the n-th row, ``every`` each n-th row of a window.
    """

    def __init__(self, mode: str, count: int, width_us: int):
        super().__init__(width_us)
        self.mode, self.count = mode, count

    def passes(self, n: np.ndarray) -> np.ndarray:
        if self.mode == "limit":
            return n <= self.count
        if self.mode == "both":
            return n == self.count
        return n % self.count == 0

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _gathered(rows)
        us = pdf["us"].to_numpy()
        opened, seen, _ = self.load()
        number = np.empty(len(us), dtype=np.int64)
        at = 0
        while at < len(us):
            if opened is None or us[at] >= opened + self.width:
                opened, seen = int(us[at]), 0
            end = int(np.searchsorted(us, opened + self.width, side="left"))
            number[at:end] = int(seen) + np.arange(1, end - at + 1)
            seen, at = seen + end - at, end
        self.store(opened, float(seen), None, int(us[-1]))
        hits = self.passes(number)
        if hits.any():
            yield pd.DataFrame({"key": key[0], "us": us[hits], "seq": pdf["seq"].to_numpy()[hits], "n": number[hits]})


class RunningTotal(_Windowed):
    """Sum since the window opened; passing the threshold alerts (throttled) and restarts the sum."""

    def __init__(self, threshold: float, width_us: int, quiet_us: int):
        super().__init__(width_us, max(width_us, quiet_us))
        self.threshold, self.quiet = threshold, quiet_us

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _gathered(rows)
        opened, total, last = self.load()
        hits = []
        for us, seq, amount in zip(pdf["us"].tolist(), pdf["seq"].tolist(), pdf["amount"].tolist()):
            if opened is None or us >= opened + self.width:
                opened, total = us, 0.0
            total += amount
            if total >= self.threshold:
                if last is None or us - last > self.quiet:
                    last = us
                    hits.append((key[0], us, seq, total))
                total = 0.0
        self.store(opened, total, last, int(pdf["us"].iloc[-1]))
        if hits:
            yield pd.DataFrame(hits, columns=["key", "us", "seq", "total"])


class DistinctHosts(_Windowed):
    """Distinct hosts since the window opened; at the threshold it alerts once per quiet period."""

    def __init__(self, threshold: int, width_us: int, quiet_us: int):
        super().__init__(width_us, max(width_us, quiet_us))
        self.threshold, self.quiet = threshold, quiet_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.hosts = handle.getMapState("hosts", "host string", "first long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _gathered(rows)
        opened, _, last = self.load()
        known = {k[0] for k in self.hosts.keys()}
        hits = []
        for us, seq, host in zip(pdf["us"].tolist(), pdf["seq"].tolist(), pdf["host"].tolist()):
            if opened is None or us >= opened + self.width:
                opened = us
                known = set()
                self.hosts.clear()
            if host not in known:
                known.add(host)
                self.hosts.updateValue((host,), (us,))
            if len(known) >= self.threshold and (last is None or us - last >= self.quiet):
                last = us
                hits.append((key[0], us, seq, len(known)))
        self.store(opened, float(len(known)), last, int(pdf["us"].iloc[-1]))
        if hits:
            yield pd.DataFrame(hits, columns=["key", "us", "seq", "hosts"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.hosts.clear()
        return super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


class RegularGaps(_Windowed):
    """Beacon check on the gaps since the window opened, kept as count, sum and sum of squares."""

    def __init__(self, cv: float, min_events: int, min_gap: float, max_gap: float, width_us: int, quiet_us: int):
        super().__init__(width_us, max(width_us, quiet_us))
        self.cv, self.min_events, self.gaps, self.quiet = cv, min_events, (min_gap, max_gap), quiet_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.moments = handle.getValueState("moments", "n long, prior long, kept long, mean double, m2 double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _gathered(rows)
        opened, _, last = self.load()
        n, prior, kept, mean, m2 = self.moments.get() if self.moments.exists() else (0, None, 0, 0.0, 0.0)
        hits = []
        for us, seq in zip(pdf["us"].tolist(), pdf["seq"].tolist()):
            if opened is None or us >= opened + self.width:
                opened, n, prior, kept, mean, m2 = us, 0, None, 0, 0.0, 0.0
            n += 1
            gap = None if prior is None else (us - prior) / 1e6
            if gap is not None and self.gaps[0] <= gap <= self.gaps[1]:
                kept += 1
                step = gap - mean
                mean += step / kept
                m2 += step * (gap - mean)
            prior = us
            if n >= self.min_events and kept >= self.min_events - 1:
                cv = (m2 / kept) ** 0.5 / mean if mean > 0 else 9999.0
                if cv <= self.cv and (last is None or us - last >= self.quiet):
                    last = us
                    hits.append((key[0], us, seq, n, mean, cv))
        self.store(opened, 0.0, last, int(pdf["us"].iloc[-1]))
        self.moments.update((n, prior, kept, mean, m2))
        if hits:
            yield pd.DataFrame(hits, columns=["key", "us", "seq", "n", "mean", "cv"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.moments.clear()
        return super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


_US = 1_000_000


def _run(stream: DataFrame, key: Column, seq: Column, processor: StatefulProcessor, schema: str, watermark: str, ts: str,
         **more: Column) -> DataFrame:
    keyed = stream.withWatermark(ts, watermark).select(
        key.cast("string").alias("key"), F.col(ts), F.unix_micros(ts).alias("us"), seq.cast("long").alias("seq"),
        *[c.alias(n) for n, c in more.items()])
    return keyed.groupBy("key").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="EventTime")


def threshold_alerts(stream: DataFrame, key: Column, mode: str, count: int, seconds: int, seq: Column | None = None,
                     watermark: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Rows that pass a ``limit``, ``both`` or ``every`` threshold in first-event windows."""
    return _run(stream, key, F.lit(0) if seq is None else seq, ThresholdCounter(mode, count, seconds * _US),
                "key string, us long, seq long, n long", watermark, ts)


def total_alerts(stream: DataFrame, key: Column, amount: Column, threshold: float, seconds: int = 3600,
                 quiet_seconds: int = 3600, seq: Column | None = None, watermark: str = "10 minutes",
                 ts: str = "ts") -> DataFrame:
    return _run(stream, key, F.lit(0) if seq is None else seq, RunningTotal(threshold, seconds * _US, quiet_seconds * _US),
                "key string, us long, seq long, total double", watermark, ts, amount=amount.cast("double"))


def host_alerts(stream: DataFrame, key: Column, host: Column, threshold: int = 5, seconds: int = 180,
                quiet_seconds: int = 600, seq: Column | None = None, watermark: str = "10 minutes",
                ts: str = "ts") -> DataFrame:
    return _run(stream, key, F.lit(0) if seq is None else seq, DistinctHosts(threshold, seconds * _US, quiet_seconds * _US),
                "key string, us long, seq long, hosts long", watermark, ts, host=host.cast("string"))


def beacon_alerts(stream: DataFrame, key: Column, cv: float = 0.3, min_events: int = 10, min_gap: float = 5.0,
                  max_gap: float = 3600.0, seconds: int = 7200, quiet_seconds: int = 1800, seq: Column | None = None,
                  watermark: str = "10 minutes", ts: str = "ts") -> DataFrame:
    processor = RegularGaps(cv, min_events, min_gap, max_gap, seconds * _US, quiet_seconds * _US)
    return _run(stream, key, F.lit(0) if seq is None else seq, processor,
                "key string, us long, seq long, n long, mean double, cv double", watermark, ts)
