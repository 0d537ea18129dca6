"""Chart data of the analysis notebooks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.numeric import or_zero, total
from pluvio.operators.filters import classified
from pluvio.operators.joins import with_station
from pluvio.plans.views import CLASS


def class_counts(observations: DataFrame) -> DataFrame:
    """All four classes in order, absent ones with zero, percent of classified rows."""
    counted = classified(observations).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(CLASS) == c).alias(c) for c in S.CLASSES]
    )
    share = F.coalesce(F.try_divide(F.col("registros").cast("double") * 100, F.col("_rows")), F.lit(0.0))
    return counted.unpivot(["_rows"], S.CLASSES, CLASS, "registros").select(
        CLASS, "registros", share.alias("percentual")
    )


def value_counts(observations: DataFrame) -> DataFrame:
    """Rows per class that occurs."""
    return classified(observations).groupBy(CLASS).agg(F.count("*").alias("registros"))


def daily_rain(observations: DataFrame) -> DataFrame:
    """Day and class: rain total (zero without amounts) and rows."""
    return (
        classified(observations)
        .groupBy(F.to_date("timestamp_utc").alias("data"), CLASS)
        .agg(
            or_zero(total("precipitacao_mm")).alias("precipitacao_total"),
            F.count("codigo_wmo").alias("num_registros"),
        )
    )


def station_matrix(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Station name by class: rows, zero where a class does not occur.

    Counting per code first keeps the pivot's input small; the class list is
    given, so the pivot needs no extra pass to find its columns.
    """
    per_code = classified(observations).groupBy("codigo_wmo", CLASS).agg(F.count("*").alias("_n"))
    return (
        with_station(per_code, stations, "nome")
        .groupBy(F.col("nome").alias("nome_estacao"))
        .pivot(CLASS, S.CLASSES)
        .agg(F.sum("_n"))
        .fillna(0, subset=S.CLASSES)
    )


def correlation(observations: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """Pearson matrix as rows; each pair uses the rows where both are present."""
    measures = measures or S.CORRELATED
    number = {m: F.col(m).cast("double") for m in measures}
    pairs = list(combinations(measures, 2))
    one_row = classified(observations).agg(
        *[F.corr(number[a], number[b]).alias(f"{a}|{b}") for a, b in pairs],
        *[F.when(F.stddev_pop(number[m]) > 0, 1.0).alias(f"{m}|{m}") for m in measures],
    )
    cells = [
        F.struct(
            F.lit(a).alias("variavel"),
            F.lit(b).alias("outra"),
            F.col("`" + (f"{a}|{b}" if (a, b) in pairs or a == b else f"{b}|{a}") + "`").alias("correlacao"),
        )
        for a in measures
        for b in measures
    ]
    return one_row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
