"""Summary views over observations, stations and predictions.

Each function is one view; ordering is left to the caller. Where a view groups
by station attributes, rows are first aggregated by station code and only the
small aggregate meets the station table, so observations are never shuffled
for a join and a station with very many rows is combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.numeric import mean, or_zero, percent, total
from pluvio.functions.timeparts import clock_text, month_start
from pluvio.operators.filters import Moment, classified, in_range, moment, rainy
from pluvio.operators.joins import with_predictions, with_station

CLASS = "intensidade_chuva"


def _day() -> Column:
    return F.to_date("timestamp_utc")


def _class_counts(names: dict[str, str]) -> list[Column]:
    """One counter per class; ``names`` maps class to output column."""
    return [F.count_if(F.col(CLASS) == c).alias(out) for c, out in names.items()]


def merged_mean(total: str, count: str) -> Column:
    """Aggregate: the mean of groups that carry a sum and a count each."""
    return F.try_divide(F.sum(total).cast("double"), F.sum(count))


def daily_data(observations: DataFrame) -> DataFrame:
    """Station and date: rain, temperature, humidity, pressure and wind."""
    return observations.groupBy("codigo_wmo", "data").agg(
        F.count("*").alias("total_registros"),
        mean("precipitacao_mm").alias("precip_media"),
        total("precipitacao_mm").alias("precip_total"),
        F.max("precipitacao_mm").alias("precip_max"),
        mean("temperatura_ar_c").alias("temp_media"),
        F.max("temperatura_ar_c").alias("temp_max"),
        F.min("temperatura_ar_c").alias("temp_min"),
        mean("umidade_rel_horaria_pct").alias("umidade_media"),
        mean("pressao_estacao_mb").alias("pressao_media"),
        mean("vento_velocidade_ms").alias("vento_medio"),
        F.max("vento_rajada_max_ms").alias("vento_rajada_max"),
    )


def class_by_station_name(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Station name, state and class: rows, mean and maximum rain."""
    per_code = (
        classified(observations)
        .groupBy("codigo_wmo", CLASS)
        .agg(
            F.count("*").alias("_n"),
            total("precipitacao_mm").alias("_sum"),
            F.count("precipitacao_mm").alias("_count"),
            F.max("precipitacao_mm").alias("_max"),
        )
    )
    return (
        with_station(per_code, stations, "nome", "uf")
        .groupBy(F.col("nome").alias("estacao"), "uf", CLASS)
        .agg(
            F.sum("_n").alias("total_registros"),
            merged_mean("_sum", "_count").alias("precip_media"),
            F.max("_max").alias("precip_max"),
        )
    )


def general_statistics(observations: DataFrame) -> DataFrame:
    """One row over all observations."""
    return observations.agg(
        F.countDistinct("codigo_wmo").alias("total_estacoes"),
        F.count("*").alias("total_registros"),
        F.min("timestamp_utc").alias("data_inicio"),
        F.max("timestamp_utc").alias("data_fim"),
        F.sum(F.when(F.col("precipitacao_mm") > 0, 1).otherwise(0)).alias("registros_com_chuva"),
        mean("precipitacao_mm").alias("precip_media_geral"),
        F.max("precipitacao_mm").alias("precip_max_geral"),
    )


def with_share(per_class: DataFrame, rows: str, output: str = "percentual", *within: str) -> DataFrame:
    """Add the percent each row has of all rows (or of the rows ``within``).

    The input holds one row per class, so the window over it stays tiny.
    """
    whole = F.sum(rows).over(Window.partitionBy(*within))
    return per_class.withColumn(output, percent(F.col(rows), whole))


def class_distribution(observations: DataFrame) -> DataFrame:
    """Rows per class with their percent of all rows; no class is a group too."""
    return with_share(
        observations.groupBy(CLASS).agg(F.count("*").alias("total_registros")), "total_registros"
    )


def class_bars(observations: DataFrame) -> DataFrame:
    """Class: rows, percent of classified rows, mean, maximum, minimum rain."""
    per_class = (
        classified(observations)
        .groupBy(CLASS)
        .agg(
            F.count("*").alias("total_registros"),
            or_zero(mean("precipitacao_mm")).alias("precip_media"),
            or_zero(F.max("precipitacao_mm")).alias("precip_max"),
            or_zero(F.min("precipitacao_mm")).alias("precip_min"),
        )
    )
    return with_share(per_class, "total_registros")


def daily_by_class(observations: DataFrame) -> DataFrame:
    """Day and class: rows, rain, mean weather."""
    return (
        classified(observations)
        .groupBy(_day().alias("data"), CLASS)
        .agg(
            F.count("*").alias("total_registros"),
            or_zero(total("precipitacao_mm")).alias("precip_total_dia"),
            or_zero(mean("precipitacao_mm")).alias("precip_media_dia"),
            or_zero(F.max("precipitacao_mm")).alias("precip_max_dia"),
            or_zero(mean("temperatura_ar_c")).alias("temp_media"),
            or_zero(mean("umidade_rel_horaria_pct")).alias("umidade_media"),
            or_zero(mean("pressao_estacao_mb")).alias("pressao_media"),
            or_zero(mean("vento_velocidade_ms")).alias("vento_medio"),
        )
    )


def station_statistics(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Every station with its statistics; a station without rows shows zeros."""
    per_code = (
        classified(observations)
        .groupBy("codigo_wmo")
        .agg(
            F.count("*").alias("total_registros"),
            F.min("timestamp_utc").alias("data_inicio"),
            F.max("timestamp_utc").alias("data_fim"),
            F.count_if(F.col(CLASS) != S.NONE).alias("registros_com_chuva"),
            *_class_counts({c: f"registros_chuva_{c}" for c in S.RAINY_CLASSES}),
            mean("precipitacao_mm").alias("precip_media"),
            F.max("precipitacao_mm").alias("precip_max"),
            total("precipitacao_mm").alias("precip_total"),
            mean("temperatura_ar_c").alias("temp_media"),
            F.max("temperatura_ar_c").alias("temp_max"),
            F.min("temperatura_ar_c").alias("temp_min"),
            mean("umidade_rel_horaria_pct").alias("umidade_media"),
            mean("pressao_estacao_mb").alias("pressao_media"),
            mean("vento_velocidade_ms").alias("vento_medio"),
            F.max("vento_rajada_max_ms").alias("vento_rajada_max"),
        )
    )
    described = stations.select(
        "codigo_wmo", F.col("nome").alias("nome_estacao"), "uf", "latitude", "longitude"
    )
    zeros = [c for c in per_code.columns if c not in ("codigo_wmo", "data_inicio", "data_fim")]
    joined = described.join(per_code, "codigo_wmo", "left")
    return joined.fillna(0, subset=zeros)


def class_share_by_station(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Station and class: rows, percent within the station, mean and maximum rain."""
    per_code = (
        classified(observations)
        .groupBy("codigo_wmo", CLASS)
        .agg(
            F.count("*").alias("total_registros"),
            mean("precipitacao_mm").alias("precip_media"),
            F.max("precipitacao_mm").alias("precip_max"),
        )
    )
    shared = with_share(per_code, "total_registros", "percentual_estacao", "codigo_wmo")
    return with_station(shared, stations, "nome", "uf").withColumnRenamed("nome", "nome_estacao")


def recent_days(observations: DataFrame, stations: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Detail rows since midnight ``days`` before ``as_of`` and up to it, with hour as text."""
    since = F.date_sub(moment(as_of).cast("date"), days).cast("timestamp_ntz")
    recent = classified(observations).where(F.col("timestamp_utc").between(since, moment(as_of)))
    if S.MONTH_PARTITION in observations.columns:
        months = [F.trunc(edge.cast("date"), "month") for edge in (since, moment(as_of))]
        recent = recent.where(F.col(S.MONTH_PARTITION).between(*months))
    return with_station(recent, stations, "nome", "uf").select(
        "timestamp_utc",
        _day().alias("data"),
        clock_text(F.col("timestamp_utc"), 5).alias("hora"),
        F.col("nome").alias("nome_estacao"),
        "uf",
        CLASS,
        "precipitacao_mm",
        "temperatura_ar_c",
        "umidade_rel_horaria_pct",
        "pressao_estacao_mb",
        "vento_velocidade_ms",
        "radiacao_global_kjm2",
    )


def monthly_by_class(observations: DataFrame) -> DataFrame:
    """Month and class: rows, rain, distinct stations."""
    return (
        classified(observations)
        .groupBy(month_start(F.col("timestamp_utc")).alias("mes"), CLASS)
        .agg(
            F.count("*").alias("total_registros"),
            total("precipitacao_mm").alias("precip_total_mes"),
            mean("precipitacao_mm").alias("precip_media_mes"),
            F.max("precipitacao_mm").alias("precip_max_mes"),
            F.countDistinct("codigo_wmo").alias("num_estacoes"),
        )
    )


def class_weather(observations: DataFrame) -> DataFrame:
    """Class: rows and mean weather."""
    return (
        classified(observations)
        .groupBy(CLASS)
        .agg(
            F.count("*").alias("total_registros"),
            mean("temperatura_ar_c").alias("temp_media"),
            mean("umidade_rel_horaria_pct").alias("umidade_media"),
            mean("pressao_estacao_mb").alias("pressao_media"),
            mean("vento_velocidade_ms").alias("vento_medio"),
            mean("radiacao_global_kjm2").alias("radiacao_media"),
            mean("precipitacao_mm").alias("precip_media"),
        )
    )


def general_summary(observations: DataFrame) -> DataFrame:
    """One row for the summary cards; zero where there is nothing to count."""
    return observations.agg(
        F.countDistinct("codigo_wmo").alias("total_estacoes"),
        F.count("*").alias("total_registros"),
        F.count(CLASS).alias("registros_classificados"),
        F.min("timestamp_utc").alias("data_inicio"),
        F.max("timestamp_utc").alias("data_fim"),
        *_class_counts({c: f"total_{c}" for c in S.CLASSES}),
        or_zero(mean("precipitacao_mm")).alias("precip_media_geral"),
        or_zero(F.max("precipitacao_mm")).alias("precip_max_geral"),
        or_zero(mean("temperatura_ar_c")).alias("temp_media_geral"),
        or_zero(mean("umidade_rel_horaria_pct")).alias("umidade_media_geral"),
    )


def heat_map(observations: DataFrame) -> DataFrame:
    """Station, day and class: mean weather."""
    return (
        classified(observations)
        .groupBy("codigo_wmo", _day().alias("data"), CLASS)
        .agg(
            mean("precipitacao_mm").alias("precip_media"),
            mean("temperatura_ar_c").alias("temp_media"),
            mean("umidade_rel_horaria_pct").alias("umidade_media"),
            mean("pressao_estacao_mb").alias("pressao_media"),
            mean("vento_velocidade_ms").alias("vento_medio"),
        )
    )


def prediction_list(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "id",
        F.col("timestamp_utc").alias("time"),
        "codigo_wmo",
        "estacao_nome",
        "precipitacao_mm",
        "pressao_estacao_mb",
        "temperatura_ar_c",
        "umidade_rel_horaria_pct",
        "vento_velocidade_ms",
        "intensidade_predita",
        *[f"probabilidade_{c}" for c in reversed(S.CLASSES)],
        "modelo_usado",
        "created_at",
    )


def rule_against_model(observations: DataFrame, stations: DataFrame, predictions: DataFrame) -> DataFrame:
    """Rule and model class of every classified observation, and whether they agree."""
    facts = classified(observations).select("codigo_wmo", "timestamp_utc", "precipitacao_mm", CLASS)
    named = with_station(facts, stations, "nome")
    same = F.col(CLASS) == F.col("intensidade_predita")
    return with_predictions(named, predictions).select(
        F.col("timestamp_utc").alias("time"),
        "codigo_wmo",
        F.col("nome").alias("estacao_nome"),
        "precipitacao_mm",
        F.col(CLASS).alias("classificacao_sql"),
        F.col("intensidade_predita").alias("classificacao_ml"),
        F.when(same, "match").otherwise("diferenca").alias("status_comparacao"),
        *[f"probabilidade_{c}" for c in reversed(S.CLASSES)],
        "modelo_usado",
    )


def prediction_statistics(predictions: DataFrame) -> DataFrame:
    """One row over all predictions, zero where there are none."""
    predicted = F.col("intensidade_predita")
    return predictions.agg(
        F.count("*").alias("total_predicoes"),
        F.countDistinct("codigo_wmo").alias("estacoes_com_predicoes"),
        F.min("timestamp_utc").alias("primeira_predicao"),
        F.max("timestamp_utc").alias("ultima_predicao"),
        *[F.count_if(predicted == c).alias(f"predicoes_{c}") for c in S.CLASSES],
        F.countDistinct("modelo_usado").alias("modelos_utilizados"),
        *[
            or_zero(mean(f"probabilidade_{c}", 4, 5)).alias(f"prob_media_{c}")
            for c in reversed(S.CLASSES)
        ],
    )


def rows_in_range(observations: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    """Classified rows of a time range, the input of every dashboard query."""
    return classified(in_range(observations, start, end))


def rainy_in_range(observations: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    return rainy(rows_in_range(observations, start, end))
