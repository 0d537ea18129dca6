"""Registered queries: summary views, dashboard catalogue, panels, filters, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.rainfall import fill_class, rainfall_class, severity
from pluvio.functions.timeparts import calendar_parts
from pluvio.operators import buckets, filters, joins
from pluvio.plans import charts, dashboard, panels, views
from pluvio.sinks.upsert import row_counts
from pluvio.sources import extracts
from pluvio.workload import predictions as pred_map
from pluvio.workload.common import (
    Query,
    avg,
    avg2,
    dbl,
    each_class,
    est,
    obs,
    pct2,
    sql,
    text,
    total,
)

C, P, H = "intensidade_chuva", "precipitacao_mm", "umidade_rel_horaria_pct"
TEMP, PRESS, WIND, GUST, RAD = (
    "temperatura_ar_c",
    "pressao_estacao_mb",
    "vento_velocidade_ms",
    "vento_rajada_max_ms",
    "radiacao_global_kjm2",
)
OK = f"{C} IS NOT NULL"
DAY = text("CAST(timestamp_utc AS DATE)")
MONTH = text("CAST(date_trunc('month', timestamp_utc) AS DATE)")
COUNT_CLASS = total(f"CASE WHEN {C} = '{{c}}' THEN 1 ELSE 0 END")
AS_OF = "2024-01-20 12:00:00"


def zero(expression: str) -> str:
    return f"COALESCE({expression}, 0)"


VIEWS = {
    "vw01_daily_data": Query(
        lambda s, d: views.daily_data(obs(s, d)),
        sql(f"""SELECT codigo_wmo, {text('data')} AS data, COUNT(*) AS total_registros, {avg(P)} AS precip_media,
  {dbl(f'SUM({P})')} AS precip_total, {dbl(f'MAX({P})')} AS precip_max, {avg(TEMP)} AS temp_media,
  {dbl(f'MAX({TEMP})')} AS temp_max, {dbl(f'MIN({TEMP})')} AS temp_min, {avg(H)} AS umidade_media,
  {avg(PRESS)} AS pressao_media, {avg(WIND)} AS vento_medio, {dbl(f'MAX({GUST})')} AS vento_rajada_max
FROM obs GROUP BY codigo_wmo, data"""),
    ),
    "vw02_class_by_station_name": Query(
        lambda s, d: views.class_by_station_name(obs(s, d), est(s, d)),
        sql(f"""SELECT e.nome AS estacao, e.uf, {C}, COUNT(*) AS total_registros, {avg(P)} AS precip_media,
  {dbl(f'MAX({P})')} AS precip_max
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY e.nome, e.uf, {C}"""),
    ),
    "vw03_general_statistics": Query(
        lambda s, d: views.general_statistics(obs(s, d)),
        sql(f"""SELECT COUNT(DISTINCT codigo_wmo) AS total_estacoes, COUNT(*) AS total_registros,
  MIN(timestamp_utc) AS data_inicio, MAX(timestamp_utc) AS data_fim,
  {total(f'CASE WHEN {P} > 0 THEN 1 ELSE 0 END')} AS registros_com_chuva,
  {avg(P)} AS precip_media_geral, {dbl(f'MAX({P})')} AS precip_max_geral FROM obs"""),
    ),
    "vw04_class_distribution": Query(
        lambda s, d: views.class_distribution(obs(s, d)),
        sql(f"""SELECT {C}, COUNT(*) AS total_registros, {pct2('COUNT(*)', '(SELECT COUNT(*) FROM obs)')} AS percentual
FROM obs GROUP BY {C}"""),
    ),
    "vw05_class_bars": Query(
        lambda s, d: views.class_bars(obs(s, d)),
        sql(f"""SELECT {C}, COUNT(*) AS total_registros,
  {pct2('COUNT(*)', f'(SELECT COUNT(*) FROM obs WHERE {OK})')} AS percentual, {zero(avg(P))} AS precip_media,
  {zero(dbl(f'MAX({P})'))} AS precip_max, {zero(dbl(f'MIN({P})'))} AS precip_min
FROM obs WHERE {OK} GROUP BY {C}"""),
    ),
    "vw06_daily_by_class": Query(
        lambda s, d: views.daily_by_class(obs(s, d)),
        sql(f"""SELECT {DAY} AS data, {C}, COUNT(*) AS total_registros, {zero(dbl(f'SUM({P})'))} AS precip_total_dia,
  {zero(avg(P))} AS precip_media_dia, {zero(dbl(f'MAX({P})'))} AS precip_max_dia, {zero(avg(TEMP))} AS temp_media,
  {zero(avg(H))} AS umidade_media, {zero(avg(PRESS))} AS pressao_media, {zero(avg(WIND))} AS vento_medio
FROM obs WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "vw07_station_statistics": Query(
        lambda s, d: views.station_statistics(obs(s, d), est(s, d)),
        sql(f"""SELECT e.codigo_wmo, e.nome AS nome_estacao, e.uf, {dbl('e.latitude')} AS latitude,
  {dbl('e.longitude')} AS longitude, COUNT(o.id) AS total_registros, MIN(timestamp_utc) AS data_inicio,
  MAX(timestamp_utc) AS data_fim,
  {zero(total(f"CASE WHEN {C} <> 'sem_chuva' THEN 1 ELSE 0 END"))} AS registros_com_chuva,
  {each_class('COALESCE(' + COUNT_CLASS + ', 0) AS registros_chuva_{c}', S.RAINY_CLASSES)},
  {zero(avg(P))} AS precip_media, {zero(dbl(f'MAX({P})'))} AS precip_max, {zero(dbl(f'SUM({P})'))} AS precip_total,
  {zero(avg(TEMP))} AS temp_media, {zero(dbl(f'MAX({TEMP})'))} AS temp_max, {zero(dbl(f'MIN({TEMP})'))} AS temp_min,
  {zero(avg(H))} AS umidade_media, {zero(avg(PRESS))} AS pressao_media, {zero(avg(WIND))} AS vento_medio,
  {zero(dbl(f'MAX({GUST})'))} AS vento_rajada_max
FROM est e LEFT JOIN obs o ON e.codigo_wmo = o.codigo_wmo AND {OK}
GROUP BY e.codigo_wmo, e.nome, e.uf, e.latitude, e.longitude"""),
    ),
    "vw08_class_share_by_station": Query(
        lambda s, d: views.class_share_by_station(obs(s, d), est(s, d)),
        sql(
            f"""SELECT e.codigo_wmo, e.nome AS nome_estacao, e.uf, {C}, COUNT(*) AS total_registros,
  {pct2('COUNT(*)', 'MAX(n)')} AS percentual_estacao, {avg(P)} AS precip_media, {dbl(f'MAX({P})')} AS precip_max
FROM est e JOIN obs o ON e.codigo_wmo = o.codigo_wmo JOIN whole w ON w.codigo_wmo = e.codigo_wmo
WHERE {OK} GROUP BY e.codigo_wmo, e.nome, e.uf, {C}""",
            extra=f", whole AS (SELECT codigo_wmo, COUNT(*) AS n FROM obs WHERE {OK} GROUP BY codigo_wmo)",
        ),
    ),
    "vw09_monthly_by_class": Query(
        lambda s, d: views.monthly_by_class(obs(s, d, "orders")),
        sql(
            f"""SELECT {MONTH} AS mes, {C}, COUNT(*) AS total_registros, {dbl(f'SUM({P})')} AS precip_total_mes,
  {avg(P)} AS precip_media_mes, {dbl(f'MAX({P})')} AS precip_max_mes, COUNT(DISTINCT codigo_wmo) AS num_estacoes
FROM obs WHERE {OK} GROUP BY date_trunc('month', timestamp_utc), {C}""",
            "orders",
        ),
    ),
    "vw10_class_weather": Query(
        lambda s, d: views.class_weather(obs(s, d)),
        sql(f"""SELECT {C}, COUNT(*) AS total_registros, {avg(TEMP)} AS temp_media, {avg(H)} AS umidade_media,
  {avg(PRESS)} AS pressao_media, {avg(WIND)} AS vento_medio, {avg(RAD)} AS radiacao_media, {avg(P)} AS precip_media
FROM obs WHERE {OK} GROUP BY {C}"""),
    ),
    "vw11_general_summary": Query(
        lambda s, d: views.general_summary(obs(s, d)),
        sql(f"""SELECT COUNT(DISTINCT codigo_wmo) AS total_estacoes, COUNT(*) AS total_registros,
  COUNT(*) FILTER (WHERE {OK}) AS registros_classificados, MIN(timestamp_utc) AS data_inicio,
  MAX(timestamp_utc) AS data_fim, {each_class(COUNT_CLASS + ' AS total_{c}', S.CLASSES)},
  {zero(avg(P))} AS precip_media_geral, {zero(dbl(f'MAX({P})'))} AS precip_max_geral,
  {zero(avg(TEMP))} AS temp_media_geral, {zero(avg(H))} AS umidade_media_geral FROM obs"""),
    ),
    "vw12_heat_map": Query(
        lambda s, d: views.heat_map(obs(s, d)),
        sql(f"""SELECT codigo_wmo, {DAY} AS data, {C}, {avg(P)} AS precip_media, {avg(TEMP)} AS temp_media,
  {avg(H)} AS umidade_media, {avg(PRESS)} AS pressao_media, {avg(WIND)} AS vento_medio
FROM obs WHERE {OK} GROUP BY codigo_wmo, CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "vw13_rule_against_model": Query(
        lambda s, d: views.rule_against_model(obs(s, d), est(s, d), pred_map.predictions(s, d)),
        sql(
            f"""SELECT o.timestamp_utc AS time, o.codigo_wmo, e.nome AS estacao_nome, {dbl('o.' + P)} AS {P},
  o.{C} AS classificacao_sql, p.intensidade_predita AS classificacao_ml,
  CASE WHEN o.{C} = p.intensidade_predita THEN 'match' ELSE 'diferenca' END AS status_comparacao,
  {each_class('CAST(p.probabilidade_{c} AS DOUBLE) AS probabilidade_{c}', S.CLASSES)}, p.modelo_usado
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo
LEFT JOIN pred p ON o.codigo_wmo = p.codigo_wmo AND CAST(o.timestamp_utc AS DATE) = CAST(p.timestamp_utc AS DATE)
  AND extract('hour' FROM o.timestamp_utc) = extract('hour' FROM p.timestamp_utc)
WHERE o.{C} IS NOT NULL""",
            extra=pred_map.CTE,
        ),
    ),
    "vw14_prediction_statistics": Query(
        lambda s, d: views.prediction_statistics(pred_map.predictions(s, d)),
        sql(
            f"""SELECT COUNT(*) AS total_predicoes, COUNT(DISTINCT codigo_wmo) AS estacoes_com_predicoes,
  MIN(timestamp_utc) AS primeira_predicao, MAX(timestamp_utc) AS ultima_predicao,
  {each_class(total("CASE WHEN intensidade_predita = '{c}' THEN 1 ELSE 0 END") + ' AS predicoes_{c}', S.CLASSES)},
  COUNT(DISTINCT modelo_usado) AS modelos_utilizados,
  {each_class('COALESCE(' + avg('probabilidade_{c}') + ', 0) AS prob_media_{c}', S.CLASSES)} FROM pred""",
            extra=pred_map.CTE,
        ),
    ),
}

CATALOGUE = {
    "q01_class_distribution": Query(
        lambda s, d: dashboard.class_distribution(obs(s, d)),
        sql(f"""SELECT {C}, COUNT(*) AS total_registros,
  {pct2('COUNT(*)', f'(SELECT COUNT(*) FROM obs WHERE {OK})')} AS percentual FROM obs WHERE {OK} GROUP BY {C}"""),
    ),
    "q02_rain_points": Query(
        lambda s, d: dashboard.rain_points(obs(s, d)),
        sql(f"SELECT timestamp_utc AS time, {dbl(P)} AS value, {C} FROM obs WHERE {OK}"),
    ),
    "q03a_class_by_station_code": Query(
        lambda s, d: dashboard.class_by_station_code(obs(s, d), est(s, d)),
        sql(f"""SELECT e.codigo_wmo AS estacao, {C}, COUNT(*) AS total_registros, {avg(P)} AS precip_media
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY e.codigo_wmo, {C}"""),
    ),
    "q03b_class_by_short_name": Query(
        lambda s, d: dashboard.class_by_short_name(obs(s, d), est(s, d)),
        sql(f"""SELECT LEFT(e.nome, 15) AS estacao, {C}, COUNT(*) AS total_registros, {avg(P)} AS precip_media
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY LEFT(e.nome, 15), {C}"""),
    ),
    "q03c_class_by_busiest_station": Query(
        lambda s, d: dashboard.class_by_busiest_station(obs(s, d), est(s, d)),
        sql(f"""SELECT e.codigo_wmo AS estacao, {C}, COUNT(*) AS total_registros, {avg(P)} AS precip_media
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} AND e.codigo_wmo IN (
  SELECT codigo_wmo FROM (SELECT codigo_wmo, COUNT(*) AS n FROM obs GROUP BY codigo_wmo
    ORDER BY n DESC, codigo_wmo LIMIT 10) AS top)
GROUP BY e.codigo_wmo, {C}"""),
    ),
    "q04_station_heat_map": Query(
        lambda s, d: dashboard.station_heat_map(obs(s, d), est(s, d)),
        sql(f"""SELECT {DAY} AS time, e.codigo_wmo AS estacao, {avg(P)} AS value, {C}
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE), e.codigo_wmo, {C}"""),
    ),
    "q05_daily_mean": Query(
        lambda s, d: dashboard.daily_mean(obs(s, d)),
        sql(f"""SELECT {DAY} AS time, {C}, {avg(P)} AS value, {dbl(f'MAX({P})')} AS max_precip,
  {dbl(f'MIN({P})')} AS min_precip FROM obs WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "q06_daily_counts": Query(
        lambda s, d: dashboard.daily_counts(obs(s, d)),
        sql(f"SELECT {DAY} AS time, {C}, COUNT(*) AS value FROM obs WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE), {C}"),
    ),
    "q07_top_heavy_rain": Query(
        lambda s, d: dashboard.top_heavy_rain(obs(s, d), est(s, d)),
        sql(f"""SELECT e.nome AS estacao, COUNT(*) FILTER (WHERE {C} = 'forte') AS chuva_forte,
  COUNT(*) FILTER (WHERE {C} = 'moderada') AS chuva_moderada, COUNT(*) FILTER (WHERE {C} = 'leve') AS chuva_leve,
  {dbl(f'MAX({P})')} AS precip_maxima
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY e.nome
HAVING COUNT(*) FILTER (WHERE {C} = 'forte') > 0 ORDER BY chuva_forte DESC, estacao LIMIT 10"""),
    ),
    "q08_weather_by_time": Query(
        lambda s, d: dashboard.weather_by_time(obs(s, d)),
        sql(f"""SELECT timestamp_utc AS time, {C}, {avg(TEMP)} AS temperatura_media, {avg(P)} AS precipitacao_media,
  {avg(H)} AS umidade_media FROM obs WHERE {OK} GROUP BY timestamp_utc, {C}"""),
    ),
    "q09_class_pie": Query(
        lambda s, d: dashboard.class_pie(obs(s, d)),
        sql(f"""SELECT {C}, COUNT(*) AS value,
  {pct2('COUNT(*)', f'(SELECT COUNT(*) FROM obs WHERE {OK})')} AS percentual FROM obs WHERE {OK} GROUP BY {C}"""),
    ),
    "q10_station_table": Query(
        lambda s, d: dashboard.station_table(obs(s, d), est(s, d)),
        sql(f"""SELECT e.codigo_wmo, e.nome AS estacao, e.uf, COUNT(*) AS total_registros,
  {each_class(COUNT_CLASS + ' AS {c}', S.CLASSES)}, {avg2(P)} AS precip_media, {dbl(f'MAX({P})')} AS precip_maxima,
  {avg2(TEMP)} AS temp_media, {avg2(H)} AS umidade_media, {avg2(PRESS)} AS pressao_media
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY e.codigo_wmo, e.nome, e.uf"""),
    ),
    "q11_monthly_total": Query(
        lambda s, d: dashboard.monthly_total(obs(s, d, "orders")),
        sql(
            f"""SELECT {MONTH} AS time, {C}, {dbl(f'SUM({P})')} AS value, COUNT(*) AS total_registros
FROM obs WHERE {OK} GROUP BY date_trunc('month', timestamp_utc), {C}""",
            "orders",
        ),
    ),
    "q12_daily_trend": Query(
        lambda s, d: dashboard.daily_trend(obs(s, d)),
        sql(f"""SELECT {DAY} AS time, {C}, COUNT(*) AS ocorrencias, {avg2(P)} AS precip_media
FROM obs WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "q13_rain_against_humidity": Query(
        lambda s, d: dashboard.rain_against_humidity(obs(s, d)),
        sql(f"""SELECT {avg(P)} AS x, {avg(H)} AS y, {C}, COUNT(*) AS tamanho_bubble
FROM obs WHERE {OK} AND {P} IS NOT NULL AND {H} IS NOT NULL GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "q14_class_comparison": Query(
        lambda s, d: dashboard.class_comparison(obs(s, d)),
        sql(f"""SELECT {C}, {avg2(TEMP)} AS temperatura, {avg2(H)} AS umidade, {avg2(PRESS)} AS pressao,
  {avg2(WIND)} AS vento, {avg2(RAD)} AS radiacao FROM obs WHERE {OK} GROUP BY {C}"""),
    ),
    "q15_accumulated_rain": Query(
        lambda s, d: dashboard.accumulated_rain(obs(s, d), est(s, d)),
        sql(f"""SELECT timestamp_utc AS time, e.nome AS estacao,
  {dbl(f'SUM({P}) OVER (PARTITION BY e.codigo_wmo ORDER BY timestamp_utc)')} AS precip_acumulada
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK}"""),
    ),
    "q16_hour_frequency": Query(
        lambda s, d: dashboard.hour_frequency(obs(s, d)),
        sql(f"""SELECT CAST(extract('hour' FROM timestamp_utc) AS INTEGER) AS hora, {C}, COUNT(*) AS frequencia,
  {avg2(P)} AS precip_media_hora FROM obs WHERE {OK} GROUP BY extract('hour' FROM timestamp_utc), {C}"""),
    ),
    "q17_daily_extremes": Query(
        lambda s, d: dashboard.daily_extremes(obs(s, d)),
        sql(f"""SELECT {DAY} AS time, {C}, {dbl(f'MAX({P})')} AS value, {dbl(f'MIN({P})')} AS min_precip,
  {avg(P)} AS media_precip FROM obs WHERE {C} <> 'sem_chuva' GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "q18_state_distribution": Query(
        lambda s, d: dashboard.state_distribution(obs(s, d), est(s, d)),
        sql(f"""SELECT e.uf, {C}, COUNT(*) AS total_registros, {avg2(P)} AS precip_media,
  COUNT(DISTINCT e.codigo_wmo) AS num_estacoes
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY e.uf, {C}"""),
    ),
    "q19_wind_against_rain": Query(
        lambda s, d: dashboard.wind_against_rain(obs(s, d)),
        sql(f"""SELECT {DAY} AS time, {C}, {avg2(WIND)} AS vento_medio, {avg2(P)} AS precip_media,
  {avg2(GUST)} AS vento_rajada_max FROM obs WHERE {C} <> 'sem_chuva' GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "q20_daily_summary": Query(
        lambda s, d: dashboard.daily_summary(obs(s, d)),
        sql(f"""SELECT {DAY} AS data, COUNT(*) AS total_registros, {each_class(COUNT_CLASS + ' AS {c}', S.CLASSES)},
  {dbl(f'SUM({P})')} AS precip_total_dia, {dbl(f'MAX({P})')} AS precip_max_dia, {avg2(TEMP)} AS temp_media_dia,
  {avg2(H)} AS umidade_media_dia, COUNT(DISTINCT codigo_wmo) AS estacoes_ativas
FROM obs WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE)"""),
    ),
}


def _class_mean(measure: str) -> Query:
    return Query(
        lambda s, d: panels.rainy_class_mean(obs(s, d), measure),
        sql(f"SELECT {C}, {zero(avg(measure))} AS valor FROM obs WHERE {C} <> 'sem_chuva' GROUP BY {C}"),
    )


def _half_hour(measure: str) -> Query:
    return Query(
        lambda s, d: panels.half_hour_mean(obs(s, d), measure),
        sql(f"""SELECT time_bucket(INTERVAL '30 minutes', timestamp_utc) AS time, {avg(measure)} AS valor, {C}
FROM obs WHERE {OK} AND {measure} <> 0 GROUP BY time_bucket(INTERVAL '30 minutes', timestamp_utc), {C}"""),
    )


PANELS = {
    "pn01_rainy_class_counts": Query(
        lambda s, d: panels.rainy_class_counts(obs(s, d)),
        sql(f"SELECT {C}, COUNT(*) AS total_registros FROM obs WHERE {C} <> 'sem_chuva' GROUP BY {C}"),
    ),
    "pn02_class_mean_rain": _class_mean(P),
    "pn03_class_mean_pressure": _class_mean(PRESS),
    "pn04_class_mean_humidity": _class_mean(H),
    "pn05_class_mean_wind": _class_mean(WIND),
    "pn06_first_points": Query(
        lambda s, d: panels.first_points(obs(s, d)),
        sql(f"""SELECT timestamp_utc AS time, {dbl(P)} AS valor, {C} FROM obs WHERE {OK} AND {P} <> 0
ORDER BY timestamp_utc, id LIMIT 10000"""),
    ),
    "pn07_half_hour_pressure": _half_hour(PRESS),
    "pn08_half_hour_humidity": _half_hour(H),
    "pn09_half_hour_wind": _half_hour(WIND),
}

CORR_PAIRS = [(a, b) for a in S.CORRELATED for b in S.CORRELATED]

CHARTS = {
    "nb01_class_counts": Query(
        lambda s, d: charts.class_counts(obs(s, d)),
        sql(f"""SELECT c.{C}, COUNT(o.id) AS registros,
  CAST(COUNT(o.id) AS DOUBLE) * 100 / (SELECT COUNT(*) FROM obs WHERE {OK}) AS percentual
FROM (VALUES ('sem_chuva'), ('leve'), ('moderada'), ('forte')) AS c({C}) LEFT JOIN obs o ON o.{C} = c.{C}
GROUP BY c.{C}"""),
    ),
    "nb02_daily_rain": Query(
        lambda s, d: charts.daily_rain(obs(s, d)),
        sql(f"""SELECT {DAY} AS data, {C}, {zero(dbl(f'SUM({P})'))} AS precipitacao_total, COUNT(codigo_wmo) AS num_registros
FROM obs WHERE {OK} GROUP BY CAST(timestamp_utc AS DATE), {C}"""),
    ),
    "nb03_station_matrix": Query(
        lambda s, d: charts.station_matrix(obs(s, d), est(s, d)),
        sql(f"""SELECT e.nome AS nome_estacao, {each_class(COUNT_CLASS + ' AS {c}', S.CLASSES)}
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} GROUP BY e.nome"""),
    ),
    "nb04_correlation": Query(
        lambda s, d: charts.correlation(obs(s, d)).withColumn("correlacao", F.round("correlacao", 6)),
        sql(
            " UNION ALL ".join(
                f"SELECT '{a}' AS variavel, '{b}' AS outra, round(corr({dbl(a)}, {dbl(b)}), 6) AS correlacao FROM obs WHERE {OK}"
                for a, b in CORR_PAIRS
            )
        ),
    ),
    "nb06_class_value_counts": Query(
        lambda s, d: charts.value_counts(obs(s, d)),
        sql(f"SELECT {C}, COUNT(*) AS registros FROM obs WHERE {OK} GROUP BY {C}"),
    ),
}

WIDE = "codigo_wmo, " + ", ".join(f"{dbl(m)} AS {m}" for m in S.MEASURES)
PARTS_SQL = ", ".join(
    f"CAST(extract('{part}' FROM timestamp_utc) AS INTEGER) AS {name}"
    for part, name in [("year", "ano"), ("month", "mes"), ("day", "dia"), ("hour", "hora"), ("dow", "dia_semana")]
)

FILTERS = {
    "prj01_rainfall_class": Query(
        lambda s, d: obs(s, d).select("id", P, rainfall_class(F.col(P)).alias("classe")),
        sql(f"""SELECT id, {dbl(P)} AS {P}, CASE WHEN {P} IS NULL OR {P} = 0 THEN 'sem_chuva'
  WHEN {P} >= 0.1 AND {P} <= 2.5 THEN 'leve' WHEN {P} >= 2.6 AND {P} <= 10 THEN 'moderada'
  WHEN {P} > 10 THEN 'forte' ELSE 'sem_chuva' END AS classe FROM obs"""),
    ),
    "prj02_classify_missing": Query(
        lambda s, d: obs(s, d).select("id", fill_class(F.when(F.col(C) == "leve", "").otherwise(F.col(C)), F.col(P)).alias(C)),
        sql(f"""SELECT id, CASE WHEN {C} IS NOT NULL THEN {C} WHEN {P} IS NULL OR {P} = 0 THEN 'sem_chuva'
  WHEN {P} >= 0.1 AND {P} <= 2.5 THEN 'leve' WHEN {P} >= 2.6 AND {P} <= 10 THEN 'moderada'
  WHEN {P} > 10 THEN 'forte' ELSE 'sem_chuva' END AS {C} FROM obs"""),
    ),
    "prj04_severity_order": Query(
        lambda s, d: obs(s, d).groupBy(C, severity(F.col(C)).alias("ordem")).agg(F.count("*").alias("registros")),
        sql(f"""SELECT {C}, CASE {C} WHEN 'sem_chuva' THEN 1 WHEN 'leve' THEN 2 WHEN 'moderada' THEN 3 WHEN 'forte' THEN 4
  ELSE 5 END AS ordem, COUNT(*) AS registros FROM obs GROUP BY {C}"""),
    ),
    "prj05_classified_rows": Query(
        lambda s, d: filters.classified(obs(s, d)).select("id", C), sql(f"SELECT id, {C} FROM obs WHERE {OK}")
    ),
    "prj06_rainy_rows": Query(
        lambda s, d: filters.rainy(obs(s, d)).select("id", C), sql(f"SELECT id, {C} FROM obs WHERE {C} <> 'sem_chuva'")
    ),
    "prj07_time_range": Query(
        lambda s, d: filters.in_range(obs(s, d), "2024-01-05 06:00:00", "2024-01-20 18:00:00").select("id", "timestamp_utc"),
        sql("""SELECT id, timestamp_utc FROM obs
WHERE timestamp_utc BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'"""),
    ),
    "prj08_measured_wind": Query(
        lambda s, d: filters.measured(obs(s, d), WIND).select("id", WIND),
        sql(f"SELECT id, {dbl(WIND)} AS {WIND} FROM obs WHERE {WIND} IS NOT NULL AND {WIND} <> 0"),
    ),
    "prj09_recent_days": Query(
        lambda s, d: views.recent_days(obs(s, d), est(s, d), AS_OF),
        sql(f"""SELECT timestamp_utc, {DAY} AS data, strftime(timestamp_utc, '%H:%M') AS hora, e.nome AS nome_estacao, e.uf, {C},
  {", ".join(f"{dbl(m)} AS {m}" for m in [P, TEMP, H, PRESS, WIND, RAD])}
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK} AND timestamp_utc BETWEEN TIMESTAMP '2024-01-13 00:00:00' AND TIMESTAMP '{AS_OF}'"""),
    ),
    "prj10_filter_lists": Query(
        lambda s, d: filters.select_scope(
            obs(s, d), est(s, d), states=["NATION_1", "NATION_7", "NATION_20"], classes=["leve", "forte"]
        ).select("id", "codigo_wmo", C),
        sql(f"""SELECT id, codigo_wmo, {C} FROM obs WHERE {C} IN ('leve', 'forte') AND codigo_wmo IN
  (SELECT codigo_wmo FROM est WHERE uf IN ('NATION_1', 'NATION_7', 'NATION_20'))"""),
    ),
    "prj11_state_values": Query(lambda s, d: filters.state_values(est(s, d)), sql("SELECT DISTINCT uf FROM est")),
    "prj11_station_values": Query(
        lambda s, d: filters.station_values(est(s, d), ["All"]), sql("SELECT DISTINCT nome FROM est")
    ),
    "prj11_class_values": Query(
        lambda s, d: filters.class_values(obs(s, d)), sql(f"SELECT DISTINCT {C} FROM obs WHERE {OK}")
    ),
    "prj12_prediction_list": Query(
        lambda s, d: views.prediction_list(pred_map.predictions(s, d)).drop("created_at"),
        sql(
            f"""SELECT id, timestamp_utc AS time, codigo_wmo, estacao_nome, {", ".join(f"{dbl(m)} AS {m}" for m in [P, PRESS, TEMP, H, WIND])},
  intensidade_predita, {each_class('CAST(probabilidade_{c} AS DOUBLE) AS probabilidade_{c}', S.CLASSES)}, modelo_usado FROM pred""",
            extra=pred_map.CTE,
        ),
    ),
    "prj17_calendar_parts": Query(
        lambda s, d: obs(s, d, "orders").select("id", *calendar_parts(F.col("timestamp_utc"))),
        sql(f"SELECT id, {PARTS_SQL} FROM obs", "orders"),
    ),
    "src13_analysis_rows": Query(
        lambda s, d: extracts.analysis_rows(obs(s, d), est(s, d)),
        sql(f"""SELECT id, o.codigo_wmo, {text('data')} AS data, hora_utc, timestamp_utc,
  {", ".join(f"{dbl(m)} AS {m}" for m in S.MEASURES)}, {C}, e.nome AS nome_estacao, e.uf,
  {dbl('e.latitude')} AS latitude, {dbl('e.longitude')} AS longitude
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo"""),
    ),
    "src14_visualisation_rows": Query(
        lambda s, d: extracts.visualisation_rows(obs(s, d), est(s, d)),
        sql(f"""SELECT timestamp_utc, o.codigo_wmo, e.nome AS nome_estacao, e.uf, {dbl('e.latitude')} AS latitude,
  {dbl('e.longitude')} AS longitude, {C}, {", ".join(f"{dbl(m)} AS {m}" for m in [P, TEMP, H, PRESS, WIND, RAD])}
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK}"""),
    ),
    "src15_chart_rows": Query(
        lambda s, d: extracts.chart_rows(obs(s, d), est(s, d)),
        sql(f"""SELECT timestamp_utc, o.codigo_wmo, e.nome AS nome_estacao, e.uf, {C},
  {", ".join(f"{dbl(m)} AS {m}" for m in [P, PRESS, H, WIND, TEMP])}
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE {OK}"""),
    ),
    "src16_training_rows": Query(
        lambda s, d: extracts.training_rows(obs(s, d)),
        sql(f"""SELECT id, codigo_wmo, timestamp_utc, {C},
  {", ".join(f"{dbl(f)} AS {f}" for f in S.FEATURES if f in S.MEASURES)}, {PARTS_SQL} FROM obs WHERE {OK}"""),
    ),
    "src17_latest_rows": Query(
        lambda s, d: extracts.latest_rows(obs(s, d), est(s, d), AS_OF, 100),
        sql(f"""SELECT o.codigo_wmo, e.nome AS estacao_nome, timestamp_utc, {", ".join(f"{dbl(m)} AS {m}" for m in [P, PRESS, TEMP, H, WIND, RAD])}
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE timestamp_utc BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '24 hours' AND TIMESTAMP '{AS_OF}'
ORDER BY timestamp_utc DESC, o.codigo_wmo, id LIMIT 100"""),
    ),
    "jn03_predictions_by_hour": Query(
        lambda s, d: joins.with_predictions(obs(s, d), pred_map.predictions(s, d)).groupBy("codigo_wmo").agg(
            F.count("*").alias("linhas"), F.count("intensidade_predita").alias("com_predicao")
        ),
        sql(
            """SELECT o.codigo_wmo, COUNT(*) AS linhas, COUNT(p.intensidade_predita) AS com_predicao
FROM obs o LEFT JOIN pred p ON o.codigo_wmo = p.codigo_wmo
  AND date_trunc('hour', o.timestamp_utc) = date_trunc('hour', p.timestamp_utc) GROUP BY o.codigo_wmo""",
            extra=pred_map.CTE,
        ),
    ),
    "jn07_station_names": Query(
        lambda s, d: joins.with_station_name(
            pred_map.predictions(s, d).select("id", "codigo_wmo", "estacao_nome"), est(s, d)
        ),
        sql(
            "SELECT p.codigo_wmo, p.id, e.nome AS estacao_nome FROM pred p LEFT JOIN est e ON p.codigo_wmo = e.codigo_wmo",
            extra=pred_map.CTE,
        ),
    ),
    "wn01_running_total": Query(
        lambda s, d: buckets.running_total(
            obs(s, d, "orders").select("id", "codigo_wmo", "timestamp_utc", P), "codigo_wmo", "timestamp_utc", P, "acumulada"
        ),
        sql(
            f"""SELECT id, codigo_wmo, timestamp_utc, {dbl(P)} AS {P},
  {dbl(f'SUM({P}) OVER (PARTITION BY codigo_wmo ORDER BY timestamp_utc)')} AS acumulada FROM obs""",
            "orders",
        ),
    ),
    "snk06_row_counts": Query(
        lambda s, d: row_counts(estacoes=est(s, d), dados_meteorologicos=obs(s, d)),
        sql("""SELECT 'estacoes' AS tabela, COUNT(*) AS registros FROM est
UNION ALL SELECT 'dados_meteorologicos', COUNT(*) FROM obs"""),
    ),
}

QUERIES = {**VIEWS, **CATALOGUE, **PANELS, **CHARTS, **FILTERS}
