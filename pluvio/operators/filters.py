"""Row filters and the values offered for filtering."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S

Moment = dt.datetime | dt.date | str


def moment(value: Moment) -> Column:
    """A zone-less timestamp literal."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def classified(observations: DataFrame) -> DataFrame:
    return observations.where(F.col("intensidade_chuva").isNotNull())


def rainy(observations: DataFrame) -> DataFrame:
    return observations.where(F.col("intensidade_chuva") != S.NONE)


def in_range(
    observations: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    column: str = "timestamp_utc",
) -> DataFrame:
    """Rows between two moments, both included; an open end is not filtered.

    A table partitioned by month gets the matching predicate on the partition
    column as well, so months outside the range are never listed or read.
    """
    pruned = S.MONTH_PARTITION in observations.columns
    if start is not None:
        observations = observations.where(F.col(column) >= moment(start))
        if pruned:
            first = F.trunc(moment(start).cast("date"), "month")
            observations = observations.where(F.col(S.MONTH_PARTITION) >= first)
    if end is not None:
        observations = observations.where(F.col(column) <= moment(end))
        if pruned:
            last = F.trunc(moment(end).cast("date"), "month")
            observations = observations.where(F.col(S.MONTH_PARTITION) <= last)
    return observations


def measured(observations: DataFrame, measure: str) -> DataFrame:
    """Rows that carry a value other than zero; telemetry sends zero for missing."""
    return observations.where(F.col(measure) != 0)


def one_of(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Multi-select filter; ``None`` or a list with ``"All"`` keeps every row."""
    if values is None or "All" in values:
        return df
    return df.where(F.col(column).isin(list(values)))


def state_values(stations: DataFrame) -> DataFrame:
    return stations.select("uf").distinct()


def station_values(stations: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    return one_of(stations, "uf", states).select("nome").distinct()


def class_values(observations: DataFrame) -> DataFrame:
    return classified(observations).select("intensidade_chuva").distinct()


def select_scope(
    observations: DataFrame,
    stations: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    states: Sequence[str] | None = None,
    station_names: Sequence[str] | None = None,
    classes: Sequence[str] | None = None,
) -> DataFrame:
    """Observations inside the dashboard's time range and filter lists."""
    scope = one_of(in_range(observations, start, end), "intensidade_chuva", classes)
    if states is None and station_names is None:
        return scope
    chosen = one_of(one_of(stations, "uf", states), "nome", station_names)
    return scope.join(chosen.select("codigo_wmo"), "codigo_wmo", "left_semi")
