"""The dashboard's query catalogue.

Every query takes the time range of the dashboard and works on classified
rows. Filter lists (states, stations, classes) are applied beforehand with
``operators.filters.select_scope``. Ordering is left to the caller except
where a query is a top list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.numeric import half_up_ratio, mean, rounded_mean, total
from pluvio.functions.timeparts import month_start
from pluvio.operators.buckets import running_total
from pluvio.operators.filters import Moment, in_range
from pluvio.operators.joins import with_station
from pluvio.plans.views import CLASS, merged_mean, rainy_in_range, rows_in_range, with_share

RAIN = "precipitacao_mm"


def _day() -> Column:
    return F.to_date("timestamp_utc")


def _by_class(observations: DataFrame, rows: str) -> DataFrame:
    return with_share(observations.groupBy(CLASS).agg(F.count("*").alias(rows)), rows)


def class_distribution(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Class: rows and percent of the range."""
    return _by_class(rows_in_range(observations, start, end), "total_registros")


def rain_points(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Every rain amount with time and class."""
    return rows_in_range(observations, start, end).select(
        F.col("timestamp_utc").alias("time"), F.col(RAIN).alias("value"), CLASS
    )


def _station_class(observations: DataFrame) -> DataFrame:
    """Station code and class: rows, rain sum, rain count."""
    return observations.groupBy("codigo_wmo", CLASS).agg(
        F.count("*").alias("total_registros"), total(RAIN).alias("_sum"), F.count(RAIN).alias("_count")
    )


def _station_class_result(per_code: DataFrame) -> DataFrame:
    average = F.try_divide(F.col("_sum").cast("double"), F.col("_count"))
    return per_code.select(
        F.col("codigo_wmo").alias("estacao"), CLASS, "total_registros", average.alias("precip_media")
    )


def class_by_station_code(
    observations: DataFrame, stations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Station code and class: rows and mean rain."""
    per_code = _station_class(rows_in_range(observations, start, end))
    return _station_class_result(per_code.join(stations.select("codigo_wmo"), "codigo_wmo"))


def class_by_short_name(
    observations: DataFrame, stations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """First fifteen characters of the name and class; equal prefixes merge."""
    per_code = _station_class(rows_in_range(observations, start, end))
    return (
        with_station(per_code, stations, "nome")
        .groupBy(F.substring("nome", 1, 15).alias("estacao"), CLASS)
        .agg(
            F.sum("total_registros").alias("total_registros"),
            merged_mean("_sum", "_count").alias("precip_media"),
        )
    )


def class_by_busiest_station(
    observations: DataFrame,
    stations: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    top: int = 10,
) -> DataFrame:
    """Class counts of the stations with most rows, classified or not.

    The classes of a station, a handful, travel with its total, so one pass
    serves both the ranking and the result. Equal totals are ranked by code.
    """
    per_code = _station_class(in_range(observations, start, end))
    entry = F.struct(CLASS, "total_registros", "_sum", "_count")
    busiest = (
        per_code.groupBy("codigo_wmo")
        .agg(F.sum("total_registros").alias("_total"), F.collect_list(entry).alias("_entries"))
        .orderBy(F.desc("_total"), "codigo_wmo")
        .limit(top)
    )
    classes = busiest.select("codigo_wmo", F.inline("_entries")).where(F.col(CLASS).isNotNull())
    return _station_class_result(classes.join(stations.select("codigo_wmo"), "codigo_wmo"))


def station_heat_map(
    observations: DataFrame, stations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Day, station and class: mean rain."""
    per_code = (
        rows_in_range(observations, start, end)
        .groupBy(_day().alias("time"), "codigo_wmo", CLASS)
        .agg(mean(RAIN).alias("value"))
    )
    known = per_code.join(stations.select("codigo_wmo"), "codigo_wmo")
    return known.select("time", F.col("codigo_wmo").alias("estacao"), "value", CLASS)


def daily_mean(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Day and class: mean, maximum and minimum rain."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(_day().alias("time"), CLASS)
        .agg(
            mean(RAIN).alias("value"),
            F.max(RAIN).alias("max_precip"),
            F.min(RAIN).alias("min_precip"),
        )
    )


def daily_counts(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Day and class: rows."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(_day().alias("time"), CLASS)
        .agg(F.count("*").alias("value"))
    )


def top_heavy_rain(
    observations: DataFrame,
    stations: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    top: int = 10,
) -> DataFrame:
    """Station names with most heavy rain; equal counts are ranked by name."""
    per_code = (
        rows_in_range(observations, start, end)
        .groupBy("codigo_wmo")
        .agg(
            *[F.count_if(F.col(CLASS) == c).alias(c) for c in S.RAINY_CLASSES],
            F.max(RAIN).alias("_max"),
        )
    )
    return (
        with_station(per_code, stations, "nome")
        .groupBy(F.col("nome").alias("estacao"))
        .agg(
            F.sum(S.HEAVY).alias("chuva_forte"),
            F.sum(S.MODERATE).alias("chuva_moderada"),
            F.sum(S.LIGHT).alias("chuva_leve"),
            F.max("_max").alias("precip_maxima"),
        )
        .where(F.col("chuva_forte") > 0)
        .orderBy(F.desc("chuva_forte"), "estacao")
        .limit(top)
    )


def weather_by_time(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Exact time and class: mean temperature, rain and humidity."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(F.col("timestamp_utc").alias("time"), CLASS)
        .agg(
            mean("temperatura_ar_c").alias("temperatura_media"),
            mean(RAIN).alias("precipitacao_media"),
            mean("umidade_rel_horaria_pct").alias("umidade_media"),
        )
    )


def class_pie(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Class: rows as ``value`` and percent of the range."""
    return _by_class(rows_in_range(observations, start, end), "value")


def station_table(
    observations: DataFrame, stations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Station: rows, class counts and rounded weather statistics."""
    per_code = (
        rows_in_range(observations, start, end)
        .groupBy("codigo_wmo")
        .agg(
            F.count("*").alias("total_registros"),
            *[F.count_if(F.col(CLASS) == c).alias(c) for c in S.CLASSES],
            rounded_mean(RAIN).alias("precip_media"),
            F.max(RAIN).alias("precip_maxima"),
            rounded_mean("temperatura_ar_c").alias("temp_media"),
            rounded_mean("umidade_rel_horaria_pct").alias("umidade_media"),
            rounded_mean("pressao_estacao_mb").alias("pressao_media"),
        )
    )
    return with_station(per_code, stations, "nome", "uf").withColumnRenamed("nome", "estacao")


def monthly_total(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Month and class: rain total and rows."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(month_start(F.col("timestamp_utc")).alias("time"), CLASS)
        .agg(total(RAIN).alias("value"), F.count("*").alias("total_registros"))
    )


def daily_trend(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Day and class: rows and rounded mean rain."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(_day().alias("time"), CLASS)
        .agg(F.count("*").alias("ocorrencias"), rounded_mean(RAIN).alias("precip_media"))
    )


def rain_against_humidity(
    observations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """One bubble per day and class; the day itself is not part of the result."""
    both = F.col(RAIN).isNotNull() & F.col("umidade_rel_horaria_pct").isNotNull()
    return (
        rows_in_range(observations, start, end)
        .where(both)
        .groupBy(_day().alias("_day"), CLASS)
        .agg(
            mean(RAIN).alias("x"),
            mean("umidade_rel_horaria_pct").alias("y"),
            F.count("*").alias("tamanho_bubble"),
        )
        .drop("_day")
    )


def class_comparison(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Class: five rounded weather means."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(CLASS)
        .agg(
            rounded_mean("temperatura_ar_c").alias("temperatura"),
            rounded_mean("umidade_rel_horaria_pct").alias("umidade"),
            rounded_mean("pressao_estacao_mb").alias("pressao"),
            rounded_mean("vento_velocidade_ms").alias("vento"),
            rounded_mean("radiacao_global_kjm2").alias("radiacao"),
        )
    )


def accumulated_rain(
    observations: DataFrame, stations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Running rain total of every station over time."""
    rows = rows_in_range(observations, start, end).select("codigo_wmo", "timestamp_utc", RAIN)
    totals = running_total(rows, "codigo_wmo", "timestamp_utc", RAIN, "precip_acumulada")
    return with_station(totals, stations, "nome").select(
        F.col("timestamp_utc").alias("time"), F.col("nome").alias("estacao"), "precip_acumulada"
    )


def hour_frequency(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Hour of the day and class: rows and rounded mean rain."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(F.hour("timestamp_utc").alias("hora"), CLASS)
        .agg(F.count("*").alias("frequencia"), rounded_mean(RAIN).alias("precip_media_hora"))
    )


def daily_extremes(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Day and rainy class: maximum, minimum and mean rain."""
    return (
        rainy_in_range(observations, start, end)
        .groupBy(_day().alias("time"), CLASS)
        .agg(
            F.max(RAIN).alias("value"),
            F.min(RAIN).alias("min_precip"),
            mean(RAIN).alias("media_precip"),
        )
    )


def state_distribution(
    observations: DataFrame, stations: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """State and class: rows, rounded mean rain, stations.

    The aggregate by station code holds each station once per class, so
    counting its rows counts distinct stations.
    """
    per_code = _station_class(rows_in_range(observations, start, end))
    return (
        with_station(per_code, stations, "uf")
        .groupBy("uf", CLASS)
        .agg(
            F.sum("total_registros").alias("total_registros"),
            half_up_ratio((F.sum("_sum") * 100).cast("bigint"), F.sum("_count")).alias("precip_media"),
            F.count("*").alias("num_estacoes"),
        )
    )


def wind_against_rain(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Day and rainy class: rounded means of wind, rain and gusts.

    The gust column carries ``max`` in its name but is a mean.
    """
    return (
        rainy_in_range(observations, start, end)
        .groupBy(_day().alias("time"), CLASS)
        .agg(
            rounded_mean("vento_velocidade_ms").alias("vento_medio"),
            rounded_mean(RAIN).alias("precip_media"),
            rounded_mean("vento_rajada_max_ms").alias("vento_rajada_max"),
        )
    )


def daily_summary(observations: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Day: rows, class counts, rain, rounded means, distinct stations."""
    return (
        rows_in_range(observations, start, end)
        .groupBy(_day().alias("data"))
        .agg(
            F.count("*").alias("total_registros"),
            *[F.count_if(F.col(CLASS) == c).alias(c) for c in S.CLASSES],
            total(RAIN).alias("precip_total_dia"),
            F.max(RAIN).alias("precip_max_dia"),
            rounded_mean("temperatura_ar_c").alias("temp_media_dia"),
            rounded_mean("umidade_rel_horaria_pct").alias("umidade_media_dia"),
            F.countDistinct("codigo_wmo").alias("estacoes_ativas"),
        )
    )
