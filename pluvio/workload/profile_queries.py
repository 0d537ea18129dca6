"""Registered queries: missing values, medians, statistics, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.operators import impute, profile, quantiles
from pluvio.sources import extracts
from pluvio.workload import mapping
from pluvio.workload import predictions as pred_map
from pluvio.workload.common import Query, avg, dbl, est, obs, sql, text

P = "precipitacao_mm"
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def quantile(column: str, p: float, unit: int = 100) -> str:
    return f"(quantile_cont(CAST(CAST({column} * {unit} AS BIGINT) AS DOUBLE), {p}) / {unit})"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _describe_sql(columns: list[str], source: str, unit: int = 100) -> str:
    return union(
        [
            f"""SELECT '{c}' AS variavel, COUNT({c}) AS contagem, {avg(c)} AS media,
  round(stddev_samp({dbl(c)}), 6) AS desvio, {dbl(f'MIN({c})')} AS minimo, {quantile(c, 0.25, unit)} AS p25,
  {quantile(c, 0.5, unit)} AS p50, {quantile(c, 0.75, unit)} AS p75, {dbl(f'MAX({c})')} AS maximo FROM {source}"""
            for c in columns
        ]
    )


def _histogram_sql(columns: list[str], bins: int, source: str) -> str:
    def one(c: str) -> str:
        return f"""SELECT '{c}' AS variavel, b.faixa, CAST(lo * {bins} + b.faixa * (hi - lo) AS DOUBLE) / {100 * bins} AS de,
  CAST(lo * {bins} + (b.faixa + 1) * (hi - lo) AS DOUBLE) / {100 * bins} AS ate, COALESCE(n, 0) AS contagem
FROM (SELECT CAST(MIN({c}) * 100 AS BIGINT) AS lo, CAST(MAX({c}) * 100 AS BIGINT) AS hi FROM {source}) AS m,
  (SELECT range AS faixa FROM range({bins})) AS b
LEFT JOIN (SELECT least(((CAST({c} * 100 AS BIGINT) - lo) * {bins}) // (hi - lo), {bins - 1}) AS faixa, COUNT(*) AS n
  FROM {source}, (SELECT CAST(MIN({c}) * 100 AS BIGINT) AS lo, CAST(MAX({c}) * 100 AS BIGINT) AS hi FROM {source}) AS m
  WHERE {c} IS NOT NULL GROUP BY 1) AS h ON h.faixa = b.faixa"""

    return union([one(c) for c in columns])


def _box_sql(c: str) -> str:
    return f"""SELECT '{c}' AS variavel, p25, p50, p75,
  MIN(CASE WHEN {dbl(c)} BETWEEN p25 - (p75 - p25) * 1.5 AND p75 + (p75 - p25) * 1.5 THEN {dbl(c)} END) AS haste_inferior,
  MAX(CASE WHEN {dbl(c)} BETWEEN p25 - (p75 - p25) * 1.5 AND p75 + (p75 - p25) * 1.5 THEN {dbl(c)} END) AS haste_superior,
  CAST(SUM(CASE WHEN {dbl(c)} < p25 - (p75 - p25) * 1.5 OR {dbl(c)} > p75 + (p75 - p25) * 1.5 THEN 1 ELSE 0 END) AS BIGINT) AS atipicos
FROM obs, (SELECT {quantile(c, 0.25)} AS p25, {quantile(c, 0.5)} AS p50, {quantile(c, 0.75)} AS p75 FROM obs) AS q
WHERE {c} IS NOT NULL GROUP BY p25, p50, p75"""


MISSING = [*S.MEASURES, "intensidade_chuva"]
LINE_CTE = "WITH li AS (SELECT " + ", ".join(f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in LINE) + " FROM lineitem)\n"
FILLED = S.MEDIAN_FILLED
PROBABILITIES = [f"probabilidade_{c}" for c in pred_map.PROBABILITIES]


def _line(spark, folder):
    """The line items' amounts as the decimals they are."""
    line = mapping.load(spark, folder, "lineitem")["lineitem"]
    return line.select(*[F.col(c).cast("decimal(18,2)").alias(c) for c in LINE])


#: Floating-point measures far from zero and near it, and the unit that both sides of a check use.
FLOATS = {"longe": ("1000000000 + CAST(floor(value * 100) AS DOUBLE)", 1.0), "perto": ("CAST(floor(value * 100) AS DOUBLE) * 1e-12", 1e12)}
MOMENTS = ["media", "desvio", "minimo", "p25", "p50", "p75", "maximo"]


def _floats(spark, folder):
    events = mapping.load(spark, folder, "events")["events"]
    rows = events.select(*[F.expr(value).alias(name) for name, (value, _) in FLOATS.items()])
    unit = F.lit(1.0)
    for name, (_, scale) in FLOATS.items():
        unit = F.when(F.col("variavel") == name, scale).otherwise(unit)
    return profile.describe(rows, list(FLOATS)).withColumns({c: F.round(F.col(c) * unit, 3) for c in MOMENTS})


def _floats_sql() -> str:
    parts = []
    for name, (value, scale) in FLOATS.items():
        made = {"media": "AVG(v)", "desvio": "stddev_samp(v)", "minimo": "MIN(v)", "maximo": "MAX(v)"}
        made |= {f"p{p}": f"quantile_cont(v, 0.{p:02d})" for p in (25, 50, 75)}
        columns = ", ".join(f"round({made[c]} * {scale}, 3) AS {c}" for c in MOMENTS)
        parts.append(f"SELECT '{name}' AS variavel, COUNT(v) AS contagem, {columns} FROM (SELECT {value} AS v FROM events) AS f")
    return union(parts)


TRAINING = [f for f in S.FEATURES if f in S.MEASURES]

QUERIES = {
    "dq01_fill_precipitation": Query(
        lambda s, d: impute.fill_precipitation(obs(s, d)).select("id", P),
        sql(f"SELECT id, COALESCE({dbl(P)}, 0) AS {P} FROM obs"),
    ),
    "dq02_fill_with_medians": Query(
        lambda s, d: impute.fill_with_medians(obs(s, d)).select("id", *FILLED),
        sql(
            f"SELECT id, {', '.join(f'COALESCE({dbl(m)}, st_{m}, all_{m}) AS {m}' for m in FILLED)} "
            "FROM obs LEFT JOIN st ON st.codigo_wmo = obs.codigo_wmo, overall",
            extra=f""", st AS (SELECT codigo_wmo, {', '.join(f'{quantile(m, 0.5)} AS st_{m}' for m in FILLED)} FROM obs GROUP BY codigo_wmo),
overall AS (SELECT {', '.join(f'{quantile(m, 0.5)} AS all_{m}' for m in FILLED)} FROM obs)""",
        ),
    ),
    "dq02_station_medians": Query(
        lambda s, d: quantiles.medians(obs(s, d), FILLED, ["codigo_wmo"]),
        sql(f"SELECT codigo_wmo, {', '.join(f'{quantile(m, 0.5)} AS {m}' for m in FILLED)} FROM obs GROUP BY codigo_wmo"),
    ),
    "dq03_fill_features": Query(
        lambda s, d: impute.fill_features(extracts.training_rows(obs(s, d))).select("id", *TRAINING),
        sql(
            f"SELECT id, {', '.join(f'COALESCE({dbl(m)}, 0) AS {m}' for m in TRAINING)} "
            "FROM obs WHERE intensidade_chuva IS NOT NULL"
        ),
    ),
    "dq03_feature_gaps": Query(
        lambda s, d: impute.feature_gaps(extracts.training_rows(obs(s, d))),
        sql(
            "SELECT * FROM ("
            + union(
                [
                    f"SELECT '{m}' AS variavel, COUNT(*) - COUNT({m}) AS faltantes FROM obs WHERE intensidade_chuva IS NOT NULL"
                    for m in TRAINING
                ]
            )
            + ") AS g WHERE faltantes > 0"
        ),
    ),
    "dq04_missing_values": Query(
        lambda s, d: profile.missing_values(obs(s, d)),
        sql(
            "SELECT * FROM ("
            + union(
                [
                    f"SELECT '{m}' AS variavel, COUNT(*) - COUNT({m}) AS faltantes, CAST(COUNT(*) - COUNT({m}) AS DOUBLE) * 100 / COUNT(*) AS percentual FROM obs"
                    for m in MISSING
                ]
            )
            + ") AS g WHERE faltantes > 0"
        ),
    ),
    "dq05_overview": Query(
        lambda s, d: profile.overview(obs(s, d)),
        sql(
            f"""SELECT COUNT(*) AS linhas, {len(S.MEASURES) + 6} AS colunas, COUNT(DISTINCT codigo_wmo) AS estacoes,
  MIN(timestamp_utc) AS inicio, MAX(timestamp_utc) AS fim,
  CAST(date_diff('microsecond', MIN(timestamp_utc), MAX(timestamp_utc)) // 86400000000 AS INTEGER) AS dias FROM obs"""
        ),
    ),
    "dq07_station_coverage": Query(
        lambda s, d: profile.station_coverage(obs(s, d), est(s, d)),
        sql("""SELECT e.codigo_wmo, e.nome, e.uf, MIN(timestamp_utc) AS data_inicio, MAX(timestamp_utc) AS data_fim,
  COUNT(timestamp_utc) AS total_registros FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo
GROUP BY e.codigo_wmo, e.nome, e.uf"""),
    ),
    "dq08_describe": Query(
        lambda s, d: _rounded(profile.describe(obs(s, d)), "desvio"), sql(_describe_sql(S.DESCRIBED, "obs"))
    ),
    "dq08_describe_lineitem": Query(
        lambda s, d: _rounded(profile.describe(_line(s, d), LINE), "desvio"),
        LINE_CTE + _describe_sql(LINE, "li"),
    ),
    "dq08_describe_probabilities": Query(
        lambda s, d: _rounded(profile.describe(pred_map.predictions(s, d), PROBABILITIES), "desvio"),
        sql(_describe_sql(PROBABILITIES, "pred", 10_000), extra=pred_map.CTE),
    ),
    "dq08_describe_floats": Query(_floats, _floats_sql()),
    "dq09_precipitation_summary": Query(
        lambda s, d: _rounded(profile.precipitation_summary(obs(s, d)), "desvio"),
        sql(f"""SELECT {avg(P)} AS media, {quantile(P, 0.5)} AS mediana, {dbl(f'MAX({P})')} AS maximo,
  {dbl(f'MIN({P})')} AS minimo, round(stddev_samp({dbl(P)}), 6) AS desvio, COUNT(*) - COUNT({P}) AS nulos,
  CAST(COUNT(*) - COUNT({P}) AS DOUBLE) * 100 / COUNT(*) AS nulos_pct FROM obs"""),
    ),
    "dq10_histograms": Query(
        lambda s, d: profile.histogram(obs(s, d), S.DESCRIBED, 50), sql(_histogram_sql(S.DESCRIBED, 50, "obs"))
    ),
    "dq10_histogram_lineitem": Query(
        lambda s, d: profile.histogram(_line(s, d), LINE, 100),
        LINE_CTE + _histogram_sql(LINE, 100, "li"),
    ),
    "dq11_box_plot": Query(lambda s, d: profile.box_plot(obs(s, d)), sql(_box_sql(P))),
    "dq12_monthly_precipitation": Query(
        lambda s, d: profile.monthly_precipitation(obs(s, d, "orders")),
        sql(
            f"""SELECT CAST(extract('year' FROM timestamp_utc) AS INTEGER) AS ano, CAST(extract('month' FROM timestamp_utc) AS INTEGER) AS mes,
  COALESCE({dbl(f'SUM({P})')}, 0) AS {P}, {text("CAST(date_trunc('month', timestamp_utc) AS DATE)")} AS data
FROM obs GROUP BY extract('year' FROM timestamp_utc), extract('month' FROM timestamp_utc), date_trunc('month', timestamp_utc)""",
            "orders",
        ),
    ),
    "prj03_reclassify_filled": Query(
        lambda s, d: impute.reclassify_filled(impute.fill_precipitation(obs(s, d))).select("id", "intensidade_chuva"),
        sql(f"""SELECT id, CASE WHEN {P} IS NULL OR {P} = 0 THEN 'sem_chuva' WHEN {P} >= 0.1 AND {P} <= 2.5 THEN 'leve'
  WHEN {P} >= 2.6 AND {P} <= 10 THEN 'moderada' WHEN {P} > 10 THEN 'forte' ELSE 'sem_chuva' END AS intensidade_chuva FROM obs"""),
    ),
}
