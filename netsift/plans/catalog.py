"""Registry of queries over the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netsift.plans.bind import with_views
from netsift.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: list[str] = (), recursive: bool = False):
    """Register ``fn(spark, sf_dir)``; ``sql`` is prefixed with the named views."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(prepare(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(list(views), sql, recursive) if views else sql.strip()
        return fn

    return register


def load() -> None:
    """Import the modules that register queries."""
    from netsift.plans import (  # noqa: F401
        queries_alerts,
        queries_intervals,
        queries_models,
        queries_traffic,
    )
