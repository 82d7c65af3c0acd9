"""DNS detectors: batch reports over whole logs and sensor-style running checks."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.functions import text
from netsift.functions.time import floor_to
from netsift.operators.anchored import (CELL, emit, group_bounds, in_cells, numbered, ordered, time_windows, units,
                                         whole_groups)
from netsift.operators.common import dashed, findings
from netsift.operators.medians import growing_median

SRC = "id_orig_h"


# --- batch reports -----------------------------------------------------------

def nxdomain_ratio(dns: DataFrame, min_ratio: float = 0.7, min_queries: int = 20) -> DataFrame:
    missed = F.count_if(F.col("rcode_name") == "NXDOMAIN")
    return (dns.dropna(subset=["query", SRC]).groupBy(F.col(SRC).alias("src"))
            .agg(F.count("*").alias("queries"), missed.alias("nxdomains"))
            .withColumn("ratio", F.col("nxdomains") / F.col("queries"))
            .where((F.col("queries") >= min_queries) & (F.col("ratio") >= min_ratio))
            .select(F.lit("DNS_HIGH_NXDOMAIN").alias("type"), F.lit("HIGH").alias("severity"), "src", "queries",
                    "nxdomains", "ratio",
                    F.format_string("NXDOMAIN ratio %.1f%% (%d/%d) from %s", F.col("ratio") * 100, "nxdomains",
                                    "queries", "src").alias("detail")))


def _labelled(dns: DataFrame) -> DataFrame:
    label = text.first_label("query")
    return (dns.dropna(subset=["query"]).withColumn("first_label", label)
            .withColumn("label_len", F.length("first_label")))


def long_labels(dns: DataFrame, min_length: int = 40) -> DataFrame:
    hits = _labelled(dns).where(F.col("label_len") >= min_length).withColumn("entropy", text.entropy("first_label", digits=3))
    return hits.select(
        F.lit("DNS_LONG_SUBDOMAIN").alias("type"), F.lit("HIGH").alias("severity"), F.col(SRC).alias("src"), "query",
        "label_len", "entropy",
        F.format_string("Long subdomain (%d chars, entropy=%.2f): %s", "label_len", "entropy", "query").alias("detail"))


def high_entropy(dns: DataFrame, min_entropy: float = 3.5, min_length: int = 10) -> DataFrame:
    """First labels strictly above both limits."""
    hits = (_labelled(dns).where(F.col("label_len") > min_length)
            .withColumn("entropy", text.entropy("first_label", digits=3)).where(F.col("entropy") > min_entropy))
    return hits.select(
        F.lit("DNS_HIGH_ENTROPY").alias("type"), F.lit("MEDIUM").alias("severity"), F.col(SRC).alias("src"), "query",
        "label_len", "entropy",
        F.format_string("High entropy domain (entropy=%.2f): %s", "entropy", "query").alias("detail"))


def query_rate(dns: DataFrame, min_per_bucket: int = 100, bucket_seconds: int = 60) -> DataFrame:
    """Queries per source, base domain and minute."""
    return (dns.dropna(subset=["query", SRC])
            .groupBy(F.col(SRC).alias("src"), text.base_domain("query").alias("domain"),
                     floor_to("ts", bucket_seconds).alias("minute"))
            .agg(F.count("*").alias("queries")).where(F.col("queries") >= min_per_bucket)
            .select(F.lit("DNS_HIGH_QUERY_RATE").alias("type"), F.lit("HIGH").alias("severity"), "src", "domain",
                    "minute", "queries",
                    F.format_string("%d queries/min from %s to %s", "queries", "src", "domain").alias("detail")))


def domain_counts(dns: DataFrame) -> DataFrame:
    """Queries per lower-cased name."""
    name = F.lower(F.trim("query"))
    return (dns.where(F.col("query").isNotNull() & ~name.isin("", "-")).groupBy(name.alias("domain"))
            .agg(F.count("*").alias("query_count")))


def record_type_breakdown(dns: DataFrame) -> DataFrame:
    """Queries per record type with their share of all."""
    counts = dns.groupBy("qtype_name").agg(F.count("*").alias("queries"))
    return counts.withColumn("share", F.col("queries") / F.sum("queries").over(Window.partitionBy()))


def response_breakdown(dns: DataFrame) -> DataFrame:
    """NXDOMAIN share over all responses."""
    return dns.agg(F.count("*").alias("queries"), F.count_if(F.col("rcode_name") == "NXDOMAIN").alias("nxdomains")) \
        .withColumn("nxdomain_share", F.try_divide(F.col("nxdomains"), F.col("queries")))


def exfil_estimate(dns: DataFrame, qtype: str = "A") -> DataFrame:
    """Bytes a base64 first label could carry, summed per source and base domain."""
    carried = F.floor(F.length(text.first_label("query")) * 3 / 4).cast("long")
    return (dns.where((F.col("qtype_name") == qtype) & F.col("query").isNotNull())
            .groupBy(F.col(SRC).alias("src"), text.base_domain("query").alias("domain"))
            .agg(F.count("*").alias("queries"), F.sum(carried).alias("bytes")))


def rate_against_baseline(dns: DataFrame, bucket_seconds: int = 60, min_ratio: float = 1.0) -> DataFrame:
    """Query count per source and bucket over the median of that source's earlier buckets."""
    width = bucket_seconds * 1_000_000
    counts = dns.groupBy(F.col(SRC).alias("src"), floor_to("ts", bucket_seconds).alias("bucket")).agg(
        F.count("*").alias("queries"))
    series = counts.withColumn("number", F.expr(f"unix_micros(bucket) div {width}L"))
    found = growing_median(series, ["src"], "number", "queries", "baseline")
    return (found.withColumn("ratio", F.try_divide(F.col("queries").cast("double"), F.col("baseline")))
            .where(F.col("ratio") >= min_ratio)
            .select("src", F.timestamp_micros(F.col("number") * width).alias("bucket"), "queries", "baseline", "ratio"))


# --- sensor checks -----------------------------------------------------------

def sensor_query_volume(dns: DataFrame, threshold: int = 100, window_seconds: int = 60, order: list[str] = (),
                        anchor: str = "first_event") -> DataFrame:
    """More than ``threshold`` queries of a source within the window; the count then restarts."""
    live = dns.select(SRC, "ts", *order)
    hits = numbered(live, [SRC], "ts", window_seconds, list(order), anchor).where(F.col("n") % (threshold + 1) == 0)
    return findings(hits.withColumn("queries", F.lit(threshold + 1)), "DNS_High_Query_Volume",
                    F.format_string("%d queries/min from %s", "queries", SRC), dashed(F.lit("dns-vol"), SRC),
                    "HIGH_QUERY_VOLUME", dst=False, keep=["queries", *order])


def sensor_long_subdomain(dns: DataFrame, threshold: int = 50, keep: list[str] = ()) -> DataFrame:
    hits = dns.withColumn("subdomain_len", F.length(text.subdomain("query"))).where(F.col("subdomain_len") > threshold)
    return findings(hits, "DNS_Long_Subdomain",
                    F.format_string(f"Subdomain length %d exceeds threshold {threshold}", "subdomain_len"),
                    dashed(F.lit("dns-long"), SRC, "query"), "LONG_SUBDOMAIN", dst=False,
                    keep=["query", "subdomain_len", *keep])


def sensor_high_entropy(dns: DataFrame, threshold: float = 3.5, keep: list[str] = ()) -> DataFrame:
    hits = dns.withColumn("entropy", text.entropy(text.first_label("query"))).where(F.col("entropy") > threshold)
    return findings(hits, "DNS_High_Entropy_Domain",
                    F.format_string(f"Entropy %.2f > {threshold:.2f} for %s", "entropy", "query"),
                    dashed(F.lit("dns-ent"), SRC, "query"), "HIGH_ENTROPY_DOMAIN", dst=False,
                    keep=["query", "entropy", *keep])


def sensor_odd_port(dns: DataFrame, keep: list[str] = ()) -> DataFrame:
    hits = dns.where(F.col("id_resp_p") != 53)
    return findings(hits, "DNS_Non_Standard_Port", F.format_string("DNS on port %d", "id_resp_p"),
                    dashed(F.lit("dns-port"), SRC, "id_resp_p"), "NON_STANDARD_PORT", dst=False,
                    keep=["query", "id_resp_p", *keep])


def tunnel_labels(dns: DataFrame, threshold: int = 50, keep: list[str] = ()) -> DataFrame:
    """First label of at least ``threshold`` characters in a name of two or more labels."""
    hits = (dns.where(F.contains("query", F.lit(".")))
            .withColumn("label_len", F.length(text.first_label("query"))).where(F.col("label_len") >= threshold))
    return findings(hits, "Exfil_DNS_Tunneling",
                    F.format_string("DNS exfil suspected: label length %d in query %s", "label_len", "query"),
                    dashed(F.lit("exfil-dns"), SRC, "query"), "DNS_TUNNEL_EXFIL", keep=["query", "label_len", *keep])


def ratio_hits(missed: np.ndarray, limit: Fraction, min_queries: int, bad: int = 0,
               total: int = 0) -> tuple[list[tuple[int, int, int]], int, int]:
    """Rows at which the NXDOMAIN share passes the limit (row, both counts there), and the counts left at the end.

    Counting goes on from ``bad`` and ``total`` and restarts behind each hit.
    """
    p, q = limit.numerator, limit.denominator
    run = np.concatenate([[0], np.cumsum(np.where(missed, q - p, -p))])
    failed = np.concatenate([[0], np.cumsum(missed)])
    hits, begin, n = [], 0, len(missed)
    while True:
        level = run[begin] - (q * bad - p * total)
        at, step = begin + max(min_queries - total, 0), 64
        found = -1
        while at < n and found < 0:              # ever longer stretches: work in proportion to the way to the next hit
            over = np.flatnonzero(run[at + 1:at + 1 + step] > level)
            found = at + int(over[0]) if len(over) else -1
            at, step = at + step, step * 2
        last = n if found < 0 else found + 1
        bad, total = bad + int(failed[last] - failed[begin]), total + last - begin
        if found < 0:
            return hits, bad, total
        hits.append((found, bad, total))
        begin, bad, total = last, 0, 0


def _first_above(values: np.ndarray, start: np.ndarray, level: np.ndarray) -> np.ndarray:
    """For each query the first place from ``start`` on with a value above ``level``, else ``len(values)``; by a tree of maxima."""
    n = len(values)
    size = 1 << max(n - 1, 1).bit_length()
    tree = np.full(2 * size, np.iinfo(np.int64).min)
    tree[size:size + n] = values
    width = size
    while width > 1:
        tree[width // 2:width] = np.maximum(tree[width:2 * width:2], tree[width + 1:2 * width:2])
        width //= 2
    node = np.minimum(start, size - 1) + size
    dead = start >= n
    open_ = np.flatnonzero(~dead)
    while len(open_):                            # to the first subtree to the right that holds one
        open_ = open_[tree[node[open_]] <= level[open_]]
        up = node[open_] + 1
        up //= up & -up
        dead[open_[up == 1]] = True
        node[open_] = up
        open_ = open_[up > 1]
    live = np.flatnonzero(~dead)
    while len(live := live[node[live] < size]):
        left = node[live] * 2
        node[live] = left + (tree[left] <= level[live])
    return np.where(dead, n, node - size)


def _cell_summary(run: np.ndarray, missed: np.ndarray, min_queries: int, reach: int) -> tuple[np.ndarray, ...]:
    """A slice as a function of the counts on entry: places where a count carried in may pass the limit first, the level
    it has to bring, and the counts left at the slice's end after a hit there.

    Of the first ``min_queries`` rows all are kept, as the counts carried in may not suffice before; behind them only new
    maxima of the level can be first, and only up to ``reach``, the largest level that entry counts can have.
    """
    n = len(run)
    below = np.concatenate([[0], run])
    # after a restart at row j the next hit is the first row from j + min_queries on above the level before j
    j = np.arange(n + 1)
    hit = _first_above(run, j + min_queries, below)
    follow = np.where(hit < n, np.minimum(hit + 1, n), j)
    while True:                                  # to the last restart of each chain
        further = follow[follow]
        if np.array_equal(further, follow):
            break
        follow = further
    failed = np.concatenate([[0], np.cumsum(missed)])
    head = np.arange(min(min_queries, n))
    tail = np.arange(len(head), n)
    best = np.maximum.accumulate(run[tail]) if len(tail) else run[tail]
    fresh = np.append(True, best[1:] > best[:-1])[:len(tail)] & (np.append(np.iinfo(np.int64).min, best[:-1])[:len(tail)] <= reach)
    rows = np.concatenate([head, tail[fresh]])
    ends = follow[rows + 1]
    return rows, run[rows], failed[n] - failed[ends], n - ends


def sensor_nxdomain_ratio(dns: DataFrame, ratio: float = 0.70, min_queries: int = 20, window_seconds: int = 300,
                          order: list[str] = (), anchor: str = "first_event") -> DataFrame:
    """NXDOMAIN share above ``ratio`` once more than ``min_queries`` were seen; both counts then restart.

    The restarts make this a sequence, which is cut into cells of a window: each condenses to a function of the
    counts on entry, the functions are walked once per window, and every cell is finished alone from its entry counts.
    Windows that cannot reach the limits are dropped before.
    """
    order = list(order)
    limit = Fraction(str(ratio))
    p, q = limit.numerator, limit.denominator
    seen = time_windows(dns.select(SRC, "ts", *order, F.coalesce(F.col("rcode") == 3, F.lit(False)).alias("nx")), [SRC], "ts",
                        window_seconds, order, anchor)
    rows = in_cells(seen, "ts", window_seconds, [SRC])
    run = Window.partitionBy(*CELL).orderBy("ts", *order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.sum(F.when(F.col("nx"), q - p).otherwise(-p).cast("long")).over(run))
    cells = rows.groupBy(*CELL).agg(
        F.count("*").alias("c"), F.count_if("nx").alias("m"), F.greatest(F.max("run"), F.lit(0)).alias("high"),
        F.sum(F.when(F.col("nx"), q - p).otherwise(-p).cast("long")).alias("gain"))
    whole, upto = Window.partitionBy("_k", "win_start"), Window.partitionBy("_k", "win_start").orderBy("_cell")
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    # the level on entry is at most what some stretch before the cell can have lost
    cells = (cells.withColumns({"all": F.sum("c").over(whole), "bad": F.sum("m").over(whole), "sum": F.sum("gain").over(upto)})
             .where((F.col("all") > min_queries) & (F.col("bad") * q > p * (min_queries + 1) - q))
             .withColumn("peak", F.col("high") + F.col("sum") - F.col("gain"))
             .select(*CELL, F.greatest(F.coalesce(F.max("peak").over(earlier) - F.col("sum") + F.col("gain"), F.lit(0)),
                                       F.lit(p * min_queries)).alias("reach")))
    live = rows.join(cells, CELL)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            starts, ends, _ = group_bounds(table)
            level, missed = table.column("run").to_numpy(), table.column("nx").to_numpy()
            reach = table.column("reach").to_numpy()
            failed = np.concatenate([[0], np.cumsum(missed, dtype=np.int64)])
            # one batch per table: a batch per cell costs far more than the cell's own work
            parts = [(s, e, _cell_summary(level[s:e], missed[s:e], min_queries, int(reach[s])))
                     for s, e in zip(starts.tolist(), ends.tolist())]
            counts = np.array([len(p[2][0]) for p in parts], dtype=np.int64)
            first, last = np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)
            more = {name: np.concatenate([p[2][i] for p in parts]).astype(np.int64)
                    for i, name in enumerate(("at", "up", "bad", "total"))}
            more |= {"gain": np.repeat(level[last - 1], counts), "size": np.repeat(last - first, counts),
                     "failed": np.repeat(failed[last] - failed[first], counts)}
            yield from emit(table, np.repeat(first, counts), CELL, **more)

    steps = ordered(live, CELL, ["ts", *order]).mapInArrow(
        summaries, "_k string, win_start long, _cell int, at long, up long, bad long, total long, gain long, size long, failed long")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            at, up, left_bad, left_total = (table.column(c).to_numpy() for c in ("at", "up", "bad", "total"))
            gain, size, failed = (table.column(c).to_numpy() for c in ("gain", "size", "failed"))
            heads = set(group_bounds(table)[0].tolist())
            states, firsts = [], []
            bad = total = 0
            for s, e in zip(*units(table, "_cell")):
                if s in heads:
                    bad = total = 0
                firsts.append(s)
                states.append((bad, total))
                level = -(q * bad - p * total)
                fit = np.flatnonzero((up[s:e] > level) & (at[s:e] >= min_queries - total))
                if len(fit):
                    bad, total = int(left_bad[s + fit[0]]), int(left_total[s + fit[0]])
                else:
                    bad, total = bad + int(failed[s]), total + int(size[s])
            yield from emit(table, np.array(firsts), CELL, bad=np.array([b for b, _ in states], np.int64),
                            total=np.array([t for _, t in states], np.int64))

    entry = ordered(steps, ["_k", "win_start"], ["_cell", "at"]).mapInArrow(
        walk, "_k string, win_start long, _cell int, bad long, total long")
    keep = [SRC, "ts", *order]
    schema = T.StructType([*[seen.schema[c] for c in keep], T.StructField("nxdomains", T.LongType()),
                           T.StructField("queries", T.LongType())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            missed = table.column("nx").to_numpy()
            before = table.column("bad").to_numpy(), table.column("total").to_numpy()
            starts, ends, _ = group_bounds(table)
            hits = [(s + at, bad, total) for s, e in zip(starts.tolist(), ends.tolist())
                    for at, bad, total in ratio_hits(missed[s:e], limit, min_queries, int(before[0][s]), int(before[1][s]))[0]]
            if hits:
                at, bad, total = (np.array(c, dtype=np.int64) for c in zip(*hits))
                yield from emit(table, at, keep, nxdomains=bad, queries=total)

    hits = ordered(rows.join(entry, CELL), CELL, ["ts", *order]).mapInArrow(finish, schema)
    return ratio_findings(hits, order)


def ratio_findings(hits: DataFrame, order: list[str]) -> DataFrame:
    """Findings of rows with ``nxdomains`` and ``queries``."""
    return findings(hits, "DNS_High_NXDOMAIN_Ratio",
                    F.format_string("NXDOMAIN ratio %.1f%% (%d/%d)", F.col("nxdomains") * 100.0 / F.col("queries"),
                                    "nxdomains", "queries"),
                    dashed(F.lit("dns-nx"), SRC), "HIGH_NXDOMAIN_RATIO", dst=False,
                    keep=["nxdomains", "queries", *order])
