"""Tables, types and the fixed vocabulary of the rainfall data model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Names, spellings, limits and orders that results depend on.
# --------------------------------------------------------------------------

# Rainfall classes in order of severity.
NONE, LIGHT, MODERATE, HEAVY = "sem_chuva", "leve", "moderada", "forte"
CLASSES = [NONE, LIGHT, MODERATE, HEAVY]
RAINY_CLASSES = [LIGHT, MODERATE, HEAVY]

# Class limits in mm per hour. The gaps between them belong to no rain.
LIGHT_FROM, LIGHT_TO = Decimal("0.1"), Decimal("2.5")
MODERATE_FROM, MODERATE_TO = Decimal("2.6"), Decimal("10")

# Measures of an observation with their stored type.
MEASURES = {
    "precipitacao_mm": "decimal(8,2)",
    "pressao_estacao_mb": "decimal(8,2)",
    "pressao_max_mb": "decimal(8,2)",
    "pressao_min_mb": "decimal(8,2)",
    "radiacao_global_kjm2": "decimal(10,2)",
    "temperatura_ar_c": "decimal(5,2)",
    "temperatura_orvalho_c": "decimal(5,2)",
    "temperatura_max_c": "decimal(5,2)",
    "temperatura_min_c": "decimal(5,2)",
    "temperatura_orvalho_max_c": "decimal(5,2)",
    "temperatura_orvalho_min_c": "decimal(5,2)",
    "umidade_rel_max_pct": "decimal(5,2)",
    "umidade_rel_min_pct": "decimal(5,2)",
    "umidade_rel_horaria_pct": "decimal(5,2)",
    "vento_direcao_graus": "decimal(6,2)",
    "vento_rajada_max_ms": "decimal(5,2)",
    "vento_velocidade_ms": "decimal(5,2)",
}

# Station-file column titles per measure: accented spelling, plain spelling.
CSV_TITLES = {
    "precipitacao_mm": (
        "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)",
        "PRECIPITACAO TOTAL, HORARIO (mm)",
    ),
    "pressao_estacao_mb": (
        "PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB)",
        "PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB)",
    ),
    "pressao_max_mb": (
        "PRESSÃO ATMOSFERICA MAX.NA HORA ANT. (AUT) (mB)",
        "PRESSAO ATMOSFERICA MAX.NA HORA ANT. (AUT) (mB)",
    ),
    "pressao_min_mb": (
        "PRESSÃO ATMOSFERICA MIN. NA HORA ANT. (AUT) (mB)",
        "PRESSAO ATMOSFERICA MIN. NA HORA ANT. (AUT) (mB)",
    ),
    "radiacao_global_kjm2": (
        "RADIACAO GLOBAL (Kj/m²)",
        "RADIACAO GLOBAL (Kj/m2)",
    ),
    "temperatura_ar_c": (
        "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",
        "TEMPERATURA DO AR - BULBO SECO, HORARIA (C)",
    ),
    "temperatura_orvalho_c": (
        "TEMPERATURA DO PONTO DE ORVALHO (°C)",
        "TEMPERATURA DO PONTO DE ORVALHO (C)",
    ),
    "temperatura_max_c": (
        "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)",
        "TEMPERATURA MAXIMA NA HORA ANT. (AUT) (C)",
    ),
    "temperatura_min_c": (
        "TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)",
        "TEMPERATURA MINIMA NA HORA ANT. (AUT) (C)",
    ),
    "temperatura_orvalho_max_c": (
        "TEMPERATURA ORVALHO MAX. NA HORA ANT. (AUT) (°C)",
        "TEMPERATURA ORVALHO MAX. NA HORA ANT. (AUT) (C)",
    ),
    "temperatura_orvalho_min_c": (
        "TEMPERATURA ORVALHO MIN. NA HORA ANT. (AUT) (°C)",
        "TEMPERATURA ORVALHO MIN. NA HORA ANT. (AUT) (C)",
    ),
    "umidade_rel_max_pct": (
        "UMIDADE REL. MAX. NA HORA ANT. (AUT) (%)",
        "UMIDADE REL. MAX. NA HORA ANT. (AUT) (%)",
    ),
    "umidade_rel_min_pct": (
        "UMIDADE REL. MIN. NA HORA ANT. (AUT) (%)",
        "UMIDADE REL. MIN. NA HORA ANT. (AUT) (%)",
    ),
    "umidade_rel_horaria_pct": (
        "UMIDADE RELATIVA DO AR, HORARIA (%)",
        "UMIDADE RELATIVA DO AR, HORARIA (%)",
    ),
    "vento_direcao_graus": (
        "VENTO, DIREÇÃO HORARIA (gr) (° (gr))",
        "VENTO, DIRECAO HORARIA (gr)",
    ),
    "vento_rajada_max_ms": (
        "VENTO, RAJADA MAXIMA (m/s)",
        "VENTO, RAJADA MAXIMA (m/s)",
    ),
    "vento_velocidade_ms": (
        "VENTO, VELOCIDADE HORARIA (m/s)",
        "VENTO, VELOCIDADE HORARIA (m/s)",
    ),
}

# Preamble keys of a station file and the station column each one fills.
PREAMBLE_KEYS = {
    "REGIAO:": "regiao",
    "UF:": "uf",
    "ESTACAO:": "nome",
    "CODIGO (WMO):": "codigo_wmo",
    "LATITUDE:": "latitude",
    "LONGITUDE:": "longitude",
    "ALTITUDE:": "altitude",
    "DATA DE FUNDACAO:": "data_fundacao",
}

# Telemetry keys and the measure each one fills.
TELEMETRY_KEYS = {
    "precipitacao_mm": "precipitacao_mm",
    "temperatura_ar_c": "temperatura_ar_c",
    "umidade_rel_pct": "umidade_rel_horaria_pct",
    "pressao_mb": "pressao_estacao_mb",
    "vento_velocidade_ms": "vento_velocidade_ms",
    "vento_direcao_graus": "vento_direcao_graus",
    "radiacao_kjm2": "radiacao_global_kjm2",
}

# Station attributes a device carries.
ATTRIBUTE_KEYS = ["codigo_wmo", "nome", "latitude", "longitude", "altitude", "estado", "tipo", "regiao"]

# Telemetry read window: days back, and points kept per device and key.
TELEMETRY_DAYS = 730
TELEMETRY_POINT_LIMIT = 100_000

# Station defaults on the telemetry path.
DEFAULT_REGION, DEFAULT_STATE = "NORDESTE", "PE"

# Measures filled with a median; measures described; measures correlated.
MEDIAN_FILLED = [
    "pressao_estacao_mb",
    "temperatura_ar_c",
    "umidade_rel_horaria_pct",
    "vento_velocidade_ms",
    "radiacao_global_kjm2",
]
DESCRIBED = [
    "precipitacao_mm",
    "pressao_estacao_mb",
    "temperatura_ar_c",
    "umidade_rel_horaria_pct",
    "vento_velocidade_ms",
    "radiacao_global_kjm2",
]
CORRELATED = [
    "precipitacao_mm",
    "pressao_estacao_mb",
    "umidade_rel_horaria_pct",
    "vento_velocidade_ms",
    "temperatura_ar_c",
]

# Model features in vector order, label names in label-index order.
FEATURES = [
    "precipitacao_mm",
    "pressao_estacao_mb",
    "pressao_max_mb",
    "pressao_min_mb",
    "temperatura_ar_c",
    "temperatura_max_c",
    "temperatura_min_c",
    "umidade_rel_horaria_pct",
    "umidade_rel_max_pct",
    "umidade_rel_min_pct",
    "vento_velocidade_ms",
    "vento_direcao_graus",
    "vento_rajada_max_ms",
    "radiacao_global_kjm2",
    "ano",
    "mes",
    "dia",
    "hora",
    "dia_semana",
]
LABELS = ["forte", "leve", "moderada", "sem_chuva"]

# Scoring defaults when rows come from the observation table.
DEFAULT_PRESSURE, DEFAULT_TEMPERATURE, DEFAULT_HUMIDITY = 1013.0, 25.0, 70.0

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------

STATION_KEY = ["codigo_wmo"]
OBSERVATION_KEY = ["codigo_wmo", "data", "hora_utc"]

# Partition columns of the stored tables: the first day of the month for
# observations, a hash group of the code for stations.
MONTH_PARTITION = "mes_ref"
STATION_PARTITION, STATION_GROUPS = "grupo", 8


_PLAIN_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _type(kind: str) -> T.DataType:
    if kind.startswith("decimal"):
        precision, scale = kind[len("decimal(") : -1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _PLAIN_TYPES[kind]


def _table(columns: str) -> T.StructType:
    """A schema from ``name type`` pairs; unlike DDL parsing it needs no session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _type(kind)) for name, kind in pairs])


STATIONS = _table(
    "codigo_wmo string, regiao string, uf string, nome string, "
    "latitude decimal(10,8), longitude decimal(11,8), altitude decimal(8,2), "
    "data_fundacao date, created_at timestamp_ntz, updated_at timestamp_ntz"
)

OBSERVATIONS = _table(
    "id bigint, codigo_wmo string, data date, hora_utc string, timestamp_utc timestamp_ntz, "
    + ", ".join(f"{name} {kind}" for name, kind in MEASURES.items())
    + ", intensidade_chuva string, created_at timestamp_ntz"
)

STORED_STATIONS = T.StructType([*STATIONS.fields, T.StructField(STATION_PARTITION, T.IntegerType())])

# Beside a stored observation: of every measure that a stream delivered, which
# delivery its value comes from.
DELIVERY = T.StructType([T.StructField("seq", T.LongType()), T.StructField("pos", T.IntegerType())])
DELIVERIES = "entregas"
STORED_OBSERVATIONS = T.StructType(
    [
        *OBSERVATIONS.fields,
        T.StructField(DELIVERIES, T.StructType([T.StructField(m, DELIVERY) for m in TELEMETRY_KEYS.values()])),
        T.StructField(MONTH_PARTITION, T.DateType()),
    ]
)

PREDICTIONS = _table(
    "id bigint, timestamp_utc timestamp_ntz, codigo_wmo string, estacao_nome string, "
    "precipitacao_mm decimal(8,2), pressao_estacao_mb decimal(8,2), temperatura_ar_c decimal(5,2), "
    "umidade_rel_horaria_pct decimal(5,2), vento_velocidade_ms decimal(5,2), "
    "intensidade_predita string, probabilidade_forte decimal(5,4), "
    "probabilidade_moderada decimal(5,4), probabilidade_leve decimal(5,4), "
    "probabilidade_sem_chuva decimal(5,4), modelo_usado string, created_at timestamp_ntz"
)

# One landing document: the telemetry answer of one device for one read.
TELEMETRY_DOCUMENTS = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField(
            "telemetry",
            T.MapType(
                T.StringType(),
                T.ArrayType(
                    T.StructType([T.StructField("ts", T.LongType()), T.StructField("value", T.StringType())])
                ),
            ),
        ),
    ]
)

# Device list; attributes arrive as an object or as a list of key/value pairs.
DEVICES = _table("device_id string, name string, type string, label string, attributes string")
