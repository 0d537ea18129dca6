"""The given tables seen as stations and observations.

The mapping is plain SQL text that both Spark and the checking database run,
so both sides of a check start from the same rows. Amounts are whole
hundredths computed from the table columns and become two-decimal numbers.
Two tables serve as observations: ``events`` (one busy month, many stations)
and ``orders`` (several years, for month-wise queries).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvio import schema as S

STATION_SQL = """
SELECT CAST(c.c_custkey AS STRING) AS codigo_wmo,
       r.r_name AS regiao,
       n.n_name AS uf,
       c.c_name AS nome,
       CAST(CAST(-CAST(floor(c.c_acctbal * 10) AS BIGINT) % 3000 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,8)) AS latitude,
       CAST(CAST(-CAST(floor(c.c_acctbal * 70) AS BIGINT) % 6000 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(11,8)) AS longitude,
       CAST(CAST(CAST(floor(c.c_acctbal * 3) AS BIGINT) % 90000 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(8,2)) AS altitude,
       CAST(NULL AS DATE) AS data_fundacao,
       CAST(NULL AS {ts}) AS created_at,
       CAST(NULL AS {ts}) AS updated_at
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

# Every table is first brought to: id, station, ts, value (non-negative, two
# decimals) and k (a whole number from 0 to 99).
EVENT_BASE = """
SELECT event_id AS id, user_id AS station, ts, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
FROM events
"""
ORDER_BASE = """
SELECT o_orderkey AS id, o_custkey AS station, o_orderdate AS ts, o_totalprice / 5000 AS value,
       CAST(floor(o_totalprice) AS BIGINT) % 100 AS k
FROM orders
"""

# Hundredths of each measure. A different modulus blanks each one.
HUNDREDTHS = {
    "precipitacao_mm": "CASE WHEN id % 17 = 0 THEN NULL WHEN id % 3 = 0 THEN 0 ELSE CAST(floor(value * 10) AS BIGINT) END",
    "pressao_estacao_mb": "CASE WHEN id % 23 = 0 THEN NULL ELSE 90000 + CAST(floor(value * 100) AS BIGINT) % 15000 END",
    "pressao_max_mb": "CASE WHEN id % 37 = 0 THEN NULL ELSE 90100 + CAST(floor(value * 100) AS BIGINT) % 15000 END",
    "pressao_min_mb": "CASE WHEN id % 41 = 0 THEN NULL ELSE 89900 + CAST(floor(value * 100) AS BIGINT) % 15000 END",
    "radiacao_global_kjm2": "CASE WHEN id % 7 = 0 THEN NULL ELSE (CAST(floor(value * 100) AS BIGINT) * (k + 1)) % 400000 END",
    "temperatura_ar_c": "CASE WHEN id % 19 = 0 THEN NULL ELSE CAST(floor(value * 700) AS BIGINT) % 4000 - 500 END",
    "temperatura_orvalho_c": "CASE WHEN id % 43 = 0 THEN NULL ELSE CAST(floor(value * 700) AS BIGINT) % 2500 - 700 END",
    "temperatura_max_c": "CASE WHEN id % 47 = 0 THEN NULL ELSE CAST(floor(value * 700) AS BIGINT) % 4000 - 500 + k END",
    "temperatura_min_c": "CASE WHEN id % 53 = 0 THEN NULL ELSE CAST(floor(value * 700) AS BIGINT) % 4000 - 500 - k END",
    "temperatura_orvalho_max_c": "CAST(floor(value * 700) AS BIGINT) % 2500 - 700 + k",
    "temperatura_orvalho_min_c": "CAST(floor(value * 700) AS BIGINT) % 2500 - 700 - k",
    "umidade_rel_max_pct": "CASE WHEN id % 59 = 0 THEN NULL ELSE k * 100 + 99 END",
    "umidade_rel_min_pct": "CASE WHEN id % 61 = 0 THEN NULL ELSE k * 100 - k END",
    "umidade_rel_horaria_pct": "CASE WHEN id % 11 = 0 THEN NULL ELSE k * 100 END",
    "vento_direcao_graus": "(id * 37) % 36000",
    "vento_rajada_max_ms": "CASE WHEN id % 31 = 0 THEN NULL ELSE CAST(floor(value * 130) AS BIGINT) % 1500 + k * 10 END",
    "vento_velocidade_ms": "CASE WHEN id % 29 = 0 THEN NULL WHEN id % 5 = 0 THEN 0 ELSE CAST(floor(value * 130) AS BIGINT) % 1500 END",
}

# The rule in whole hundredths; a row in thirteen has not been classified.
CLASS_SQL = """CASE WHEN id % 13 = 0 THEN NULL
     WHEN precipitacao_mm IS NULL OR precipitacao_mm = 0 THEN 'sem_chuva'
     WHEN CAST(precipitacao_mm * 100 AS BIGINT) BETWEEN 10 AND 250 THEN 'leve'
     WHEN CAST(precipitacao_mm * 100 AS BIGINT) BETWEEN 260 AND 1000 THEN 'moderada'
     WHEN CAST(precipitacao_mm * 100 AS BIGINT) > 1000 THEN 'forte'
     ELSE 'sem_chuva' END"""


def _decimal(hundredths: str, kind: str) -> str:
    return f"CAST(CAST({hundredths} AS DECIMAL(12,0)) * 0.01 AS {kind.upper()})"


def raw_observation_sql(base: str) -> str:
    """Unclassified observations; runs in Spark and in the checking database."""
    measures = ",\n       ".join(f"{_decimal(HUNDREDTHS[m], kind)} AS {m}" for m, kind in S.MEASURES.items())
    return f"""
SELECT id, CAST(station AS STRING) AS codigo_wmo, CAST(ts AS DATE) AS data,
       substr(CAST(ts AS STRING), 12, 8) AS hora_utc, ts AS timestamp_utc,
       {measures}
FROM ({base}) AS base
"""


def check_observation_sql(base: str) -> str:
    """The same rows with the class written out in SQL, for the checking side."""
    return f"SELECT *, {CLASS_SQL} AS intensidade_chuva FROM ({raw_observation_sql(base)}) AS raw"


def load(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def _run(spark: SparkSession, folder: str, text: str, *names: str) -> DataFrame:
    """Run mapping SQL with the tables bound as named frames, without views."""
    for name in names:
        text = text.replace(f" {name} ", f" {{{name}}} ").replace(f" {name}\n", f" {{{name}}}\n")
    return spark.sql(text, **load(spark, folder, *names))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    text = STATION_SQL.replace("{ts}", "TIMESTAMP_NTZ")
    return _run(spark, folder, text, "customer", "nation", "region")


def raw_observations(spark: SparkSession, folder: str, table: str = "events") -> DataFrame:
    base = {"events": EVENT_BASE, "orders": ORDER_BASE}[table]
    return _run(spark, folder, raw_observation_sql(base), table)
