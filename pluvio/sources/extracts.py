"""Wide extracts that analysis, charts, training and scoring start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.timeparts import calendar_parts
from pluvio.operators.filters import Moment, classified, moment
from pluvio.operators.joins import with_station


def analysis_rows(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """All observation columns with the station's name, state and position."""
    wide = with_station(observations, stations, "nome", "uf", "latitude", "longitude")
    return wide.withColumnRenamed("nome", "nome_estacao")


def visualisation_rows(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Classified rows with station name, state and position, 13 columns."""
    return analysis_rows(classified(observations), stations).select(
        "timestamp_utc",
        "codigo_wmo",
        "nome_estacao",
        "uf",
        "latitude",
        "longitude",
        "precipitacao_mm",
        "intensidade_chuva",
        "temperatura_ar_c",
        "umidade_rel_horaria_pct",
        "pressao_estacao_mb",
        "vento_velocidade_ms",
        "radiacao_global_kjm2",
    )


def chart_rows(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Classified rows for the charts, 10 columns."""
    return visualisation_rows(observations, stations).select(
        "timestamp_utc",
        "codigo_wmo",
        "nome_estacao",
        "uf",
        "precipitacao_mm",
        "intensidade_chuva",
        "pressao_estacao_mb",
        "umidade_rel_horaria_pct",
        "vento_velocidade_ms",
        "temperatura_ar_c",
    )


def training_rows(observations: DataFrame) -> DataFrame:
    """Classified rows with the model's measures and calendar parts."""
    measures = [f for f in S.FEATURES if f in S.MEASURES]
    return classified(observations).select(
        "id",
        "codigo_wmo",
        "timestamp_utc",
        "intensidade_chuva",
        *measures,
        *calendar_parts(F.col("timestamp_utc")),
    )


def latest_rows(
    observations: DataFrame, stations: DataFrame, as_of: Moment, limit: int = 100, hours: int = 24
) -> DataFrame:
    """The newest rows of the last hours up to ``as_of``; equal times by code and id."""
    since = moment(as_of) - F.make_dt_interval(hours=F.lit(hours))
    recent = observations.where(F.col("timestamp_utc").between(since, moment(as_of)))
    if S.MONTH_PARTITION in observations.columns:
        months = [F.trunc(edge.cast("date"), "month") for edge in (since, moment(as_of))]
        recent = recent.where(F.col(S.MONTH_PARTITION).between(*months))
    return (
        with_station(recent, stations, "nome")
        .orderBy(F.desc("timestamp_utc"), "codigo_wmo", "id")
        .limit(limit)
        .select(
            "codigo_wmo",
            F.col("nome").alias("estacao_nome"),
            "timestamp_utc",
            "precipitacao_mm",
            "pressao_estacao_mb",
            "temperatura_ar_c",
            "umidade_rel_horaria_pct",
            "vento_velocidade_ms",
            "radiacao_global_kjm2",
        )
    )
