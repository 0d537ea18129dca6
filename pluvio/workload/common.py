"""Shared pieces of the registered queries and of their SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.functions.rainfall import rainfall_class
from pluvio.workload import mapping

# The range of the queries that prune stored months: it cuts rows off both ends of a table.
RANGES = {
    "orders": ("1995-03-15 00:00:00", "2001-05-10 00:00:00"),
}


class Query(NamedTuple):
    """A query over the given tables and, where SQL can say it, its SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def obs(spark: SparkSession, folder: str, table: str = "events") -> DataFrame:
    """The mapped observations, classified but for one row in thirteen."""
    raw = mapping.raw_observations(spark, folder, table)
    known = F.col("id") % 13 != 0
    return raw.withColumn("intensidade_chuva", F.when(known, rainfall_class(F.col("precipitacao_mm"))))


def est(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.stations(spark, folder)


def plain(df: DataFrame) -> DataFrame:
    """Result types every engine compares alike: decimals as doubles, dates as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --------------------------------------------------------------------------
# SQL text
# --------------------------------------------------------------------------

BASES = {"events": mapping.EVENT_BASE, "orders": mapping.ORDER_BASE}
EST_SQL = mapping.STATION_SQL.replace("{ts}", "TIMESTAMP")


def between(table: str) -> str:
    start, end = RANGES[table]
    return f"timestamp_utc BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"


def sql(body: str, table: str = "events", extra: str = "", where: str = "TRUE") -> str:
    """A statement over ``obs`` and ``est``, the mapped tables."""
    rows = f"SELECT * FROM ({mapping.check_observation_sql(BASES[table])}) AS every_row WHERE {where}"
    return f"WITH obs AS ({rows}), est AS ({EST_SQL}){extra}\n{body}"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def avg(column: str) -> str:
    return f"(CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0))"


def total(expression: str) -> str:
    return f"CAST(SUM({expression}) AS BIGINT)"


def ratio2(numerator: str, denominator: str) -> str:
    """Whole hundredths over a count, rounded half away from zero."""
    top, bottom = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    size = f"((2 * abs({top}) + {bottom}) // (2 * {bottom}))"
    return f"(CASE WHEN {denominator} > 0 THEN CAST((CASE WHEN {top} < 0 THEN -{size} ELSE {size} END) AS DOUBLE) / 100 END)"


def avg2(column: str) -> str:
    return ratio2(f"SUM({column}) * 100", f"COUNT({column})")


def pct2(part: str, whole: str) -> str:
    return ratio2(f"({part}) * 10000", whole)


def each_class(template: str, classes: list[str]) -> str:
    return ", ".join(template.format(c=c) for c in classes)
