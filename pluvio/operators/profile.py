"""Data profiling: missing values, coverage, statistics, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.numeric import half_up_ratio, or_zero, total
from pluvio.operators.quantiles import bin_of, scale_of, spans, typed, with_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values: count and percent of all rows, in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    long = counted.unpivot(["_rows"], columns, "variavel", "faltantes").where(F.col("faltantes") > 0)
    share = F.col("faltantes").cast("double") * 100 / F.col("_rows")
    return long.select("variavel", "faltantes", share.alias("percentual"))


def overview(observations: DataFrame) -> DataFrame:
    """One row: rows, columns, stations, first and last time, whole days between."""
    width = len(observations.columns)
    return observations.agg(
        F.count("*").alias("linhas"),
        F.lit(width).alias("colunas"),
        F.countDistinct("codigo_wmo").alias("estacoes"),
        F.min("timestamp_utc").alias("inicio"),
        F.max("timestamp_utc").alias("fim"),
    ).withColumn("dias", F.extract(F.lit("DAY"), F.col("fim") - F.col("inicio")))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Name and type of every column; read from the plan, without a job."""
    return df.dtypes


def station_coverage(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Per station: name, state, first and last time, number of rows."""
    covered = observations.groupBy("codigo_wmo").agg(
        F.min("timestamp_utc").alias("data_inicio"),
        F.max("timestamp_utc").alias("data_fim"),
        F.count("timestamp_utc").alias("total_registros"),
    )
    return covered.join(stations.select("codigo_wmo", "nome", "uf"), "codigo_wmo")


def _with_rows(values: DataFrame, measures: Sequence[str], per_measure: DataFrame, *wanted: str) -> DataFrame:
    """Every value in a row of its own beside the named numbers of its measure."""
    rows = [F.struct(F.lit(m).alias("variavel"), F.col(m).alias("valor")) for m in measures]
    long = values.select(F.inline(F.array(*rows))).where(F.col("valor").isNotNull())
    # One row per named measure is broadcast.
    return long.join(F.broadcast(per_measure.select("variavel", *wanted)), "variavel")


def _distribution(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Counts, moments, extremes and quartiles per measure."""
    values = typed(df, measures)
    return with_quantiles(values, measures, QUARTILES, spans(values, measures)).select(
        "variavel",
        F.col("_total").alias("contagem"),
        F.col("_gaps").alias("nulos"),
        F.try_divide(F.col("_sum").cast("double"), F.col("_total")).alias("media"),
        F.col("_deviation").alias("desvio"),
        F.col("_low").cast("double").alias("minimo"),
        *QUARTILES,
        F.col("_high").cast("double").alias("maximo"),
    )


def describe(df: DataFrame, measures: Sequence[str] = tuple(S.DESCRIBED)) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum per measure."""
    return _distribution(df, measures).drop("nulos")


def precipitation_summary(observations: DataFrame) -> DataFrame:
    """One row: mean, median, extremes and deviation of rain, and its gaps."""
    share = F.try_divide(F.col("nulos").cast("double") * 100, F.col("contagem") + F.col("nulos"))
    return _distribution(observations, ["precipitacao_mm"]).select(
        "media", F.col("p50").alias("mediana"), "maximo", "minimo", "desvio", "nulos", share.alias("nulos_pct")
    )


def histogram(df: DataFrame, measures: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins per measure, empty bins included.

    A bin holds its lower edge; the last bin holds both edges. Positions of
    decimals are computed in whole steps of the measures' scale, so an edge value
    never slips; floating-point values are binned as they are. A measure with a
    single value lies in the middle of a bin range one unit wide. A measure without
    values has no bins. One pass finds the extremes, two numbers per measure, which
    the second pass has as constants; both are combined before the shuffle.
    """
    scale = scale_of(df, measures)
    values = typed(df, measures)
    if scale is None:
        unit, ends = 1, [F.struct(F.min(m), F.max(m)) for m in measures]
    else:
        unit = 10 ** max(scale, 1)
        values = values.select(*[(F.col(m) * unit).cast("bigint").alias(m) for m in measures])
        ends = [F.struct(F.min(m), F.max(m)) for m in measures]
    found = {m: tuple(end) for m, end in zip(measures, values.agg(*ends).first(), strict=True) if end[0] is not None}
    spare = 0.5 if scale is None else unit // 2
    found = {m: (low - spare, high + spare) if low == high else (low, high) for m, (low, high) in found.items()}
    edges = [(m, i, (low * bins + i * (high - low)) / (unit * bins), (low * bins + (i + 1) * (high - low)) / (unit * bins)) for m, (low, high) in found.items() for i in range(bins)]
    every = df.sparkSession.createDataFrame(edges, "variavel string, faixa bigint, de double, ate double")
    if not found:
        return every.withColumn("contagem", F.lit(0).cast("bigint"))
    places = []
    for m, (low, high) in found.items():
        if scale is None:
            place = bin_of(F.col(m), F.lit(low), F.lit(high), bins)
        else:
            wide = "bigint" if (high - low) * bins < 2**62 else "decimal(38,0)"
            place = F.least(F.call_function("div", (F.col(m) - low).cast(wide) * bins, F.lit(high - low).cast(wide)), F.lit(bins - 1).cast("bigint"))
        places.append(F.struct(F.lit(m).alias("variavel"), F.when(F.col(m).isNotNull(), place).cast("bigint").alias("faixa")))
    counted = values.select(F.inline(F.array(*places))).where(F.col("faixa").isNotNull()).groupBy("variavel", "faixa").agg(F.count("*").alias("n"))
    return every.join(counted, ["variavel", "faixa"], "left").select("variavel", "faixa", "de", "ate", or_zero(F.col("n")).alias("contagem"))


def box_plot(df: DataFrame, measures: Sequence[str] = ("precipitacao_mm",)) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and outlier counts."""
    values = typed(df, measures)
    quartiles = with_quantiles(values, measures, QUARTILES, spans(values, measures)).select("variavel", *QUARTILES)
    reach = (F.col("p75") - F.col("p25")) * 1.5
    value = F.col("valor").cast("double")
    inside = value.between(F.col("p25") - reach, F.col("p75") + reach)
    return _with_rows(values, measures, quartiles, *QUARTILES).groupBy("variavel", *QUARTILES).agg(
        F.min(F.when(inside, value)).alias("haste_inferior"),
        F.max(F.when(inside, value)).alias("haste_superior"),
        F.count_if(~inside).alias("atipicos"),
    )


def monthly_precipitation(observations: DataFrame) -> DataFrame:
    """Rain per calendar month; a month without any amount totals zero."""
    ts = F.col("timestamp_utc")
    return (
        observations.groupBy(F.year(ts).alias("ano"), F.month(ts).alias("mes"))
        .agg(or_zero(total("precipitacao_mm")).alias("precipitacao_mm"))
        .withColumn("data", F.make_date("ano", "mes", F.lit(1)))
    )


def telemetry_coverage(points: DataFrame, devices: DataFrame) -> DataFrame:
    """Points per device and key; a device without telemetry keeps one empty row."""
    counted = points.groupBy("device_id", "key").agg(F.count("*").alias("pontos"))
    return devices.select("device_id", "name", "type").join(counted, "device_id", "left").fillna(0, subset=["pontos"])


def device_telemetry(points: DataFrame, devices: DataFrame) -> DataFrame:
    """Per device: total points, and how many attributes it carries."""
    counted = points.groupBy("device_id").agg(F.count("*").alias("total_pontos"))
    listed = devices.select(
        "device_id", "name", "type", F.size(F.coalesce("attributes", F.create_map().cast("map<string,string>"))).alias("atributos")
    )
    return (
        listed.join(counted, "device_id", "left")
        .fillna(0, subset=["total_pontos"])
        .withColumn("tem_atributos", F.col("atributos") > 0)
    )


def telemetry_summary(points: DataFrame, devices: DataFrame) -> DataFrame:
    """One row over all devices, with the mean number of points to two decimals."""
    per_device = device_telemetry(points, devices)
    total = F.sum("total_pontos")
    return per_device.agg(
        F.count("*").alias("dispositivos"),
        or_zero(total).alias("total_pontos"),
        F.count_if(F.col("total_pontos") > 0).alias("com_telemetria"),
        F.count_if(F.col("total_pontos") == 0).alias("sem_telemetria"),
        or_zero(half_up_ratio(total * 100, F.count("*"))).alias("media_pontos"),
    )
