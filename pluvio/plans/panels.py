"""The provisioned dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions.numeric import mean, or_zero
from pluvio.operators.filters import classified, measured, rainy
from pluvio.plans.views import CLASS, class_bars


def rainy_class_counts(observations: DataFrame) -> DataFrame:
    return rainy(class_bars(observations)).select(CLASS, "total_registros")


def rainy_class_mean(observations: DataFrame, measure: str) -> DataFrame:
    """Rainy class: mean of one measure, zero where it was never measured."""
    return rainy(observations).groupBy(CLASS).agg(or_zero(mean(measure)).alias("valor"))


def first_points(observations: DataFrame, limit: int = 10_000) -> DataFrame:
    """The first rain amounts other than zero in time order; equal times by id."""
    return (
        measured(classified(observations), "precipitacao_mm")
        .orderBy("timestamp_utc", "id")
        .limit(limit)
        .select(F.col("timestamp_utc").alias("time"), F.col("precipitacao_mm").alias("valor"), CLASS)
    )


def half_hour_mean(observations: DataFrame, measure: str, width: str = "30 minutes") -> DataFrame:
    """Time bucket and class: mean of one measure, missing and zero left out."""
    rows = measured(classified(observations), measure)
    return (
        rows.groupBy(F.window("timestamp_utc", width).alias("_window"), CLASS)
        .agg(mean(measure).alias("valor"))
        .select(F.col("_window.start").alias("time"), "valor", CLASS)
    )
