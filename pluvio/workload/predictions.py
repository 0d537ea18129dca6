"""Predictions derived from the events table by a fixed rule.

Every event yields one prediction some minutes after it, so an hour may hold
several of a station's predictions or none. The predicted class follows half
the rain amount, so it agrees with the rule on some rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.rainfall import rainfall_class
from pluvio.workload import mapping

PROBABILITIES = {"forte": 2, "moderada": 3, "leve": 7, "sem_chuva": 11}

CTE = """, pred AS (
SELECT raw.id, raw.timestamp_utc + to_minutes(CAST(b.k AS INTEGER)) AS timestamp_utc, raw.codigo_wmo,
       CAST(NULL AS VARCHAR) AS estacao_nome, precipitacao_mm, pressao_estacao_mb, temperatura_ar_c,
       umidade_rel_horaria_pct, vento_velocidade_ms,
       CASE WHEN precipitacao_mm IS NULL OR precipitacao_mm = 0 THEN 'sem_chuva'
            WHEN CAST(precipitacao_mm * 100 AS BIGINT) // 2 BETWEEN 10 AND 250 THEN 'leve'
            WHEN CAST(precipitacao_mm * 100 AS BIGINT) // 2 BETWEEN 260 AND 1000 THEN 'moderada'
            WHEN CAST(precipitacao_mm * 100 AS BIGINT) // 2 > 1000 THEN 'forte'
            ELSE 'sem_chuva' END AS intensidade_predita,
""" + "".join(
    f"       CAST(CAST((b.k * {f}) % 1001 AS DECIMAL(12,0)) * 0.0010 AS DECIMAL(5,4)) AS probabilidade_{c},\n"
    for c, f in PROBABILITIES.items()
) + f"""       'modelo_' || CAST(b.k % 5 AS VARCHAR) AS modelo_usado
FROM ({mapping.raw_observation_sql(mapping.EVENT_BASE)}) AS raw JOIN ({mapping.EVENT_BASE}) AS b ON raw.id = b.id)"""

COMPARED_CTE = CTE + """, cmp AS (SELECT CASE WHEN precipitacao_mm IS NULL OR precipitacao_mm = 0 THEN 'sem_chuva'
  WHEN precipitacao_mm >= 0.1 AND precipitacao_mm <= 2.5 THEN 'leve' WHEN precipitacao_mm >= 2.6 AND precipitacao_mm <= 10 THEN 'moderada'
  WHEN precipitacao_mm > 10 THEN 'forte' ELSE 'sem_chuva' END AS real, intensidade_predita AS predita FROM pred)"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    raw = mapping.raw_observations(spark, folder)
    # The two dew point limits are never blank and lie 2k hundredths apart.
    k = ((F.col("temperatura_orvalho_max_c") - F.col("temperatura_orvalho_min_c")) * 50).cast("bigint")
    half = F.floor(F.col("precipitacao_mm") * 50).cast("decimal(12,0)") * F.lit(0.01).cast("decimal(2,2)")
    shares = [
        (((k * f) % 1001).cast("decimal(12,0)") * F.lit(0.001).cast("decimal(4,4)")).cast("decimal(5,4)").alias(
            f"probabilidade_{c}"
        )
        for c, f in PROBABILITIES.items()
    ]
    return raw.select(
        "id",
        (F.col("timestamp_utc") + F.make_dt_interval(mins=k.cast("int"))).alias("timestamp_utc"),
        "codigo_wmo",
        F.lit(None).cast("string").alias("estacao_nome"),
        "precipitacao_mm",
        "pressao_estacao_mb",
        "temperatura_ar_c",
        "umidade_rel_horaria_pct",
        "vento_velocidade_ms",
        rainfall_class(half).alias("intensidade_predita"),
        *shares,
        F.concat(F.lit("modelo_"), (k % 5).cast("string")).alias("modelo_usado"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
    ).select(*S.PREDICTIONS.names)
