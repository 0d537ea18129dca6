"""Batch scoring: default values, class and probabilities, bad rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.timeparts import calendar_parts
from pluvio.ml.features import label_name
from pluvio.operators.filters import Moment, moment
from pluvio.operators.joins import with_station_name
from pluvio.sinks.landing import append_predictions
from pluvio.sources.extracts import latest_rows


def _or(value: Column, default: Column) -> Column:
    """The value unless it is missing or zero."""
    return F.when(value.isNull() | (value == 0), default).otherwise(value)


def _column(rows: DataFrame, name: str) -> Column:
    return (F.col(name) if name in rows.columns else F.lit(None)).cast("double")


def request_defaults(rows: DataFrame, now: Moment) -> DataFrame:
    """Optional fields from their base value, zero for direction and radiation, time from ``now``."""
    base = {
        "pressao_max_mb": "pressao_estacao_mb",
        "pressao_min_mb": "pressao_estacao_mb",
        "temperatura_max_c": "temperatura_ar_c",
        "temperatura_min_c": "temperatura_ar_c",
        "umidade_rel_max_pct": "umidade_rel_horaria_pct",
        "umidade_rel_min_pct": "umidade_rel_horaria_pct",
        "vento_rajada_max_ms": "vento_velocidade_ms",
    }
    filled = {name: _or(_column(rows, name), _column(rows, source)) for name, source in base.items()}
    for name in ("vento_direcao_graus", "radiacao_global_kjm2"):
        filled[name] = _or(_column(rows, name), F.lit(0.0))
    complete = rows.withColumns(filled)
    kept = [c for c in complete.columns if c not in S.FEATURES[-5:]]
    return complete.select(*kept, *calendar_parts(moment(now)))


def table_defaults(rows: DataFrame) -> DataFrame:
    """Features from a stored row: standard weather where it is missing or zero.

    Daily extremes repeat the base value, direction is zero, and the time
    parts are the observation's own.
    """
    pressure = _or(_column(rows, "pressao_estacao_mb"), F.lit(S.DEFAULT_PRESSURE))
    temperature = _or(_column(rows, "temperatura_ar_c"), F.lit(S.DEFAULT_TEMPERATURE))
    humidity = _or(_column(rows, "umidade_rel_horaria_pct"), F.lit(S.DEFAULT_HUMIDITY))
    wind = _or(_column(rows, "vento_velocidade_ms"), F.lit(0.0))
    values = {
        "precipitacao_mm": _or(_column(rows, "precipitacao_mm"), F.lit(0.0)),
        "pressao_estacao_mb": pressure,
        "pressao_max_mb": pressure,
        "pressao_min_mb": pressure,
        "temperatura_ar_c": temperature,
        "temperatura_max_c": temperature,
        "temperatura_min_c": temperature,
        "umidade_rel_horaria_pct": humidity,
        "umidade_rel_max_pct": humidity,
        "umidade_rel_min_pct": humidity,
        "vento_velocidade_ms": wind,
        "vento_direcao_graus": F.lit(0.0),
        "vento_rajada_max_ms": wind,
        "radiacao_global_kjm2": _or(_column(rows, "radiacao_global_kjm2"), F.lit(0.0)),
    }
    kept = [c for c in rows.columns if c not in S.FEATURES]
    return rows.select(
        *kept, *[v.alias(n) for n, v in values.items()], *calendar_parts(F.col("timestamp_utc"))
    )


def batch_defaults(rows: DataFrame) -> DataFrame:
    """A batch request: every absent feature, time parts included, is zero.

    Text that is not a number is marked in ``erro`` and scored as no row.
    """
    wrong = F.lit(None).cast("string")
    values = {}
    for name in S.FEATURES:
        given = F.col(name) if name in rows.columns else F.lit(None).cast("string")
        number = given.try_cast("double")
        wrong = F.when(given.isNotNull() & number.isNull(), F.lit(f"{name} is not a number")).otherwise(wrong)
        values[name] = F.coalesce(number, F.lit(0.0))
    kept = [F.col(c) for c in rows.columns if c not in S.FEATURES]
    return rows.select(*kept, *[v.alias(n) for n, v in values.items()], wrong.alias("erro"))


def _probabilities(scored: DataFrame) -> Column:
    """Class probabilities in label order.

    One-against-rest models give margins only; each margin becomes the
    probability of its class, and the four are scaled to sum to one.
    """
    if "probability" in scored.columns:
        return vector_to_array("probability")
    odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    whole = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
    return F.transform(odds, lambda p: p / whole)


def score(rows: DataFrame, model: PipelineModel, model_name: str) -> DataFrame:
    """Rows with predicted class, code, probabilities and model name.

    Missing features count as zero. A row with ``erro`` keeps its place and
    gets NULLs, so one bad row never stops the batch.
    """
    ready = rows.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in S.FEATURES})
    unlabelled = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])
    scored = unlabelled.transform(ready)
    good = F.col("erro").isNull() if "erro" in rows.columns else F.lit(True)
    chance = F.when(good, _probabilities(scored))
    code = F.when(good, F.col("prediction").cast("int"))
    return scored.select(
        *[F.col(c) for c in rows.columns],
        label_name(code).alias("intensidade_predita"),
        code.alias("codigo_predito"),
        *[F.get(chance, F.lit(i)).alias(f"probabilidade_{c}") for i, c in enumerate(S.LABELS)],
        F.when(good, F.lit(model_name)).alias("modelo_usado"),
    )


def score_recent(
    observations: DataFrame,
    stations: DataFrame,
    model: PipelineModel,
    model_name: str,
    as_of: Moment,
    limit: int = 10,
) -> DataFrame:
    """Score the newest rows of the last 24 hours."""
    recent = latest_rows(observations, stations, as_of, limit)
    return score(table_defaults(recent), model, model_name)


def score_requests(
    requests: DataFrame, stations: DataFrame, model: PipelineModel, model_name: str, now: Moment
) -> DataFrame:
    """Score simple requests; an absent station code becomes UNKNOWN."""
    scored = score(request_defaults(requests, now), model, model_name)
    named = with_station_name(scored, stations)
    return named.fillna("UNKNOWN", subset=["codigo_wmo"]).withColumn("timestamp_utc", moment(now))


def score_and_append(
    observations: DataFrame,
    stations: DataFrame,
    model: PipelineModel,
    model_name: str,
    path: str,
    as_of: Moment,
    limit: int = 10,
) -> None:
    """Score recent rows and append them to the prediction log."""
    append_predictions(score_recent(observations, stations, model, model_name, as_of, limit), path, as_of)
