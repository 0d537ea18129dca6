"""Joins of observations with stations and predictions.

No side carries a broadcast hint. Spark broadcasts the station table when its
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and
merges, where adaptive execution splits a station that holds too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions.timeparts import hour_start


def with_station(observations: DataFrame, stations: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Observations with the given station columns, by station code."""
    return observations.join(stations.select("codigo_wmo", *columns), "codigo_wmo", how)


def with_station_name(scored: DataFrame, stations: DataFrame) -> DataFrame:
    """Scored rows with the station's name, NULL for an unknown station."""
    names = stations.select("codigo_wmo", F.col("nome").alias("estacao_nome"))
    return scored.drop("estacao_nome").join(names, "codigo_wmo", "left")


def with_predictions(observations: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every observation with the predictions of its station and hour.

    Several predictions in an hour give several rows; none gives NULLs. The
    hour is part of the join key, so a busy station spreads over its hours.
    """
    left = observations.withColumn("_hour", hour_start(F.col("timestamp_utc")))
    right = predictions.select(
        "codigo_wmo",
        hour_start(F.col("timestamp_utc")).alias("_hour"),
        "intensidade_predita",
        "probabilidade_forte",
        "probabilidade_moderada",
        "probabilidade_leve",
        "probabilidade_sem_chuva",
        "modelo_usado",
    )
    return left.join(right, ["codigo_wmo", "_hour"], "left").drop("_hour")
