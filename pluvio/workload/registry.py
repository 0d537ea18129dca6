"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pluvio.workload import ingest_queries, model_queries, profile_queries, view_queries
from pluvio.workload.common import Query, plain

QUERIES: dict[str, Query] = {
    **view_queries.QUERIES,
    **profile_queries.QUERIES,
    **ingest_queries.QUERIES,
    **model_queries.QUERIES,
}


def _plain(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plain(query.run(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _plain(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: query.sql for name, query in QUERIES.items() if query.sql is not None}
