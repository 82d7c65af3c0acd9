"""Writers for results and ranked reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.operators import reports


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def _write_lines(parts: list[DataFrame], path: str) -> None:
    """Write (rank, line) parts in order as one text file; parts are top-k reports, so it is small."""
    merged = None
    for i, part in enumerate(parts):
        rows = part.select(F.lit(i).alias("part"), "rank", "line")
        merged = rows if merged is None else merged.unionByName(rows)
    merged.coalesce(1).sortWithinPartitions("part", "rank").select("line").write.mode("overwrite").text(path)


def _heading(df: DataFrame, *lines: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(0, "\n".join(lines))], "rank int, line string")


def write_beacon_report(beacons: DataFrame, path: str, rows: int = 20, details: int = 10) -> None:
    head = _heading(beacons, "# Beacon Detection Analysis Results", "", "## Top Suspected Beacons", "",
                    "| Rank | Source IP | Destination IP | Port | Count | Avg Interval | CV | Confidence |",
                    "|---|---|---|---|---|---|---|---|")
    _write_lines([head, reports.beacon_table(beacons, rows), _heading(beacons, "", "## Detailed Findings", ""),
                  reports.beacon_details(beacons, details)], path)


def write_alert_report(alerts: DataFrame, path: str) -> None:
    """All alerts, most severe first; the report is as many files as it needs, in the order of their names."""
    head = _heading(alerts, "# Exfiltration Detection Report", "", "| # | Type | Severity | Source | Detail |",
                    "|---|------|----------|--------|--------|")
    whole = head.unionByName(reports.alert_table(alerts))
    whole.orderBy("rank").select("line").write.mode("overwrite").text(path)
