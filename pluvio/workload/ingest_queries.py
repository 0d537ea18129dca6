"""Registered queries: station files, telemetry, upserts, landing, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.timeparts import epoch_ms, from_epoch_ms
from pluvio.operators import filters, profile
from pluvio.plans import dashboard
from pluvio.session import fresh_path
from pluvio.sinks import landing as sink
from pluvio.sinks import upsert
from pluvio.sources import station_csv, telemetry
from pluvio.streaming import ingest, windows
from pluvio.workload import landing, mapping
from pluvio.workload import predictions as pred_map
from pluvio.workload.common import RANGES, Query, between, dbl, est, obs, sql, text

NOW = "2024-02-01 00:00:00"
MEASURES = ", ".join(f"{dbl(m)} AS {m}" for m in S.MEASURES)
MINUTE = "substr(hora_utc, 1, 5) || ':00'"
MS = "CAST(epoch_ms(date_trunc('hour', timestamp_utc)) AS BIGINT)"
HOUR_POINTS = ", pt AS (" + " UNION ALL ".join(
    f"SELECT 'dev-' || codigo_wmo AS device_id, codigo_wmo, id, date_trunc('hour', timestamp_utc) AS hora, {MS} AS ts, "
    f"'{key}' AS key, {measure} AS valor FROM obs WHERE {measure} IS NOT NULL"
    for key, measure in S.TELEMETRY_KEYS.items()
) + ")"
WIDE = ", ".join(
    f"CAST(arg_max(valor, id) FILTER (WHERE key = '{key}') AS DOUBLE) AS {{{key}}}" for key in S.TELEMETRY_KEYS
)
WIDE_KEYS = WIDE.format(**{k: k for k in S.TELEMETRY_KEYS})
WIDE_MEASURES = WIDE.format(**S.TELEMETRY_KEYS)
UNSENT = [m for m in S.MEASURES if m not in S.TELEMETRY_KEYS.values()]
SENT = [m for m in S.MEASURES if m in S.TELEMETRY_KEYS.values()]
RULE = """CASE WHEN precipitacao_mm IS NULL OR precipitacao_mm = 0 THEN 'sem_chuva'
  WHEN precipitacao_mm >= 0.1 AND precipitacao_mm <= 2.5 THEN 'leve'
  WHEN precipitacao_mm >= 2.6 AND precipitacao_mm <= 10 THEN 'moderada'
  WHEN precipitacao_mm > 10 THEN 'forte' ELSE 'sem_chuva' END"""


def files(spark: SparkSession, folder: str, faults: bool = False) -> station_csv.StationFiles:
    return station_csv.read_station_files(spark, landing.station_files(spark, folder, faults))


def _rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every rejected row of the folder with faults, by the id its line carries."""
    rows = files(spark, folder, faults=True).rejected_rows
    marks = [r"^data (\d+)", r"hora (\d+)", r";9999999(\d+)", r";(\d+)$"]
    found = F.coalesce(*[F.nullif(F.regexp_extract("texto", mark, 1), F.lit("")) for mark in marks])
    return rows.select(found.cast("bigint").alias("id"), "codigo_wmo", "motivo")


def points(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.points(telemetry.read_documents(spark, landing.telemetry_documents(spark, folder)))


def devices(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.read_devices(spark, landing.device_list(spark, folder))


def _station_key(df: DataFrame) -> DataFrame:
    return df.select("codigo_wmo", "regiao", "uf", "nome", "latitude", "longitude", "altitude")


def _loaded_files(spark: SparkSession, folder: str) -> DataFrame:
    """All station files upserted into a fresh table."""
    table = fresh_path(spark, "observations")
    upsert.upsert_observations(spark, table, files(spark, folder).observations, NOW, ["arquivo", "bloco", "linha"], staged=True)
    return upsert.read_observations(spark, table)


def _hourly(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Rows keyed by station and hour, several of them per key."""
    raw = mapping.raw_observations(spark, folder, table)
    return raw.withColumn("hora_utc", F.concat(F.substring("hora_utc", 1, 2), F.lit(":00:00"))).drop("timestamp_utc")


def _two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads into one table: all events, then all events with less rain."""
    table = fresh_path(spark, "observations")
    first = _hourly(spark, folder, "events")
    upsert.upsert_observations(spark, table, first, NOW, ["id"])
    half = F.floor(F.col("precipitacao_mm") * 10).cast("decimal(12,0)") * F.lit(0.01).cast("decimal(2,2)")
    again = first.where(F.col("umidade_rel_horaria_pct") >= 50).withColumn("precipitacao_mm", half.cast("decimal(8,2)"))
    upsert.upsert_observations(spark, table, again, NOW, ["id"])
    return upsert.read_observations(spark, table)


def _station_loads(spark: SparkSession, folder: str) -> DataFrame:
    """All stations, then the rich ones again under a new name."""
    table = fresh_path(spark, "stations")
    first = _station_key(est(spark, folder)).withColumn("data_fundacao", F.lit(None).cast("date"))
    upsert.upsert_stations(spark, table, first, NOW)
    renamed = first.where(F.col("altitude") > 150).withColumn("nome", F.upper("nome"))
    upsert.upsert_stations(spark, table, renamed, "2024-02-02 00:00:00")
    return upsert.read_stations(spark, table).select(
        "codigo_wmo", "regiao", "uf", "nome", "latitude", "longitude", "altitude", "created_at", "updated_at"
    )


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    """Wide records written to the raw folder and read back."""
    target = sink.land_records(
        telemetry.wide_records(points(spark, folder)), devices(spark, folder), fresh_path(spark, "landing"), "20240201_000000"
    )
    keys = ", ".join(f"{k} string" for k in S.TELEMETRY_KEYS)
    back = spark.read.schema(
        f"device_id string, device_name string, codigo_wmo string, nome string, estado string, timestamp bigint, {keys}"
    ).json(target)
    return back.withColumns({k: F.col(k).cast("double") for k in S.TELEMETRY_KEYS})


def _prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to a fresh prediction log."""
    path = fresh_path(spark, "predictions")
    scored = pred_map.predictions(spark, folder).drop("id", "created_at")
    sink.append_predictions(scored, path, NOW)
    sink.append_predictions(scored.where(F.col("intensidade_predita") == S.HEAVY), path, "2024-02-02 00:00:00")
    log = spark.read.schema(S.PREDICTIONS).parquet(path)
    return log.groupBy("intensidade_predita", "created_at").agg(F.count("*").alias("registros"))


def _stored_orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as observations, upserted into a table of some eighty months."""
    table = fresh_path(spark, "observations")
    upsert.upsert_observations(spark, table, mapping.raw_observations(spark, folder, "orders"), NOW, ["id"])
    return upsert.read_observations(spark, table)


def _unknown_stations(spark: SparkSession, folder: str) -> DataFrame:
    """All events loaded while only high stations are known; where each row went."""
    table, rejects = fresh_path(spark, "observations"), fresh_path(spark, "rejects")
    known = est(spark, folder).where(F.col("altitude") > 150)
    upsert.upsert_observations(spark, table, _hourly(spark, folder, "events"), NOW, ["id"], stations=known, rejects=rejects)
    stored = upsert.read_observations(spark, table).select("codigo_wmo", "data", "hora_utc", F.lit("tabela").alias("destino"))
    rejected = spark.read.parquet(rejects).select("codigo_wmo", "data", "hora_utc", F.lit("rejeitada").alias("destino"))
    return stored.unionByName(rejected)


def _streamed(spark: SparkSession, folder: str, listed: DataFrame | None = None) -> dict[str, str]:
    """All documents streamed, then older drafts, into fresh tables; several batches."""
    tables = {name: fresh_path(spark, f"streamed-{name}") for name in ("table", "stations", "rejects")}
    query = ingest.start_ingest(
        spark,
        landing.telemetry_deliveries(spark, folder),
        devices(spark, folder) if listed is None else listed,
        checkpoint=fresh_path(spark, "checkpoint"),
        now=lambda: NOW,
        files_per_batch=8,
        **tables,
    )
    query.awaitTermination()
    return tables


def _stream_means(spark: SparkSession, folder: str, copies: int) -> DataFrame:
    """Closed half hours of a stream that delivers every row ``copies`` times."""
    source, target = fresh_path(spark, "stream-source"), fresh_path(spark, "stream-means")
    rows = obs(spark, folder).withColumn("created_at", F.lit(None).cast("timestamp_ntz")).select(*S.OBSERVATIONS.names)
    copied = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    copied.repartitionByRange("timestamp_utc").write.parquet(source)
    windows.start_half_hour_means(
        spark, source, "vento_velocidade_ms", target, fresh_path(spark, "checkpoint")
    ).awaitTermination()
    return spark.read.parquet(target)


def _file_name() -> Column:
    return F.regexp_replace(F.element_at(F.split("arquivo", "/"), -1), r"\.csv$", "")


def _file_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The station code found in the name of each file."""
    path = landing.station_files(spark, folder)
    found = station_csv.discover_stations(station_csv.read_lines(spark, path))
    coded = station_csv.file_stations(station_csv.list_files(spark, path), found, _file_name())
    return coded.select(_file_name().alias("arquivo"), "codigo_wmo")


# A window is emitted once the newest value lies two hours past its end. The
# watermark counts whole milliseconds.
STREAM_SQL = sql("""SELECT time_bucket(INTERVAL '30 minutes', timestamp_utc) AS time, intensidade_chuva,
  CAST(SUM(vento_velocidade_ms) AS DOUBLE) / COUNT(*) AS valor, COUNT(*) AS registros
FROM obs, (SELECT date_trunc('milliseconds', MAX(timestamp_utc)) AS newest FROM obs
  WHERE intensidade_chuva IS NOT NULL AND vento_velocidade_ms <> 0) AS w
WHERE intensidade_chuva IS NOT NULL AND vento_velocidade_ms <> 0
GROUP BY time_bucket(INTERVAL '30 minutes', timestamp_utc), intensidade_chuva, newest
HAVING time_bucket(INTERVAL '30 minutes', timestamp_utc) + INTERVAL '30 minutes' <= newest - INTERVAL '2 hours'""")

FILE_NAME = (
    "'ESTACAO_' || codigo_wmo || '_' || strftime(timestamp_utc, '%Y-%m') || '_' || "
    f"CAST(id // {landing.ROWS_PER_FILE} AS VARCHAR)"
)
LAST_ROW = f""", last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY codigo_wmo, data, {MINUTE} ORDER BY id DESC) AS rn FROM obs) AS r WHERE rn = 1)"""
LAST_HOUR = ", hr AS (SELECT *, substr(hora_utc, 1, 2) || ':00:00' AS clock FROM obs)"

DEVICE_OBS = f"""SELECT codigo_wmo, {text('CAST(hora AS DATE)')} AS data, strftime(hora, '%H:%M:%S') AS hora_utc,
  hora AS timestamp_utc, {WIDE_MEASURES} FROM pt GROUP BY codigo_wmo, hora"""

STORED_CTE = f""", stored AS (SELECT * EXCLUDE (intensidade_chuva, rn), {RULE} AS intensidade_chuva FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY codigo_wmo, data, hora_utc ORDER BY id DESC) AS rn FROM obs) AS r WHERE rn = 1 AND {between('orders')})"""

QUERIES = {
    "prj07_stored_monthly_total": Query(
        lambda s, d: dashboard.monthly_total(_stored_orders(s, d), *RANGES["orders"]),
        sql(
            f"""SELECT {text("CAST(date_trunc('month', timestamp_utc) AS DATE)")} AS time, intensidade_chuva,
  {dbl('SUM(precipitacao_mm)')} AS value, COUNT(*) AS total_registros
FROM stored GROUP BY date_trunc('month', timestamp_utc), intensidade_chuva""",
            "orders",
            STORED_CTE,
        ),
    ),
    "prj07_stored_range": Query(
        lambda s, d: filters.in_range(_stored_orders(s, d), *RANGES["orders"]).select(
            "codigo_wmo", "timestamp_utc", "precipitacao_mm", "intensidade_chuva"
        ),
        sql(
            f"SELECT codigo_wmo, timestamp_utc, {dbl('precipitacao_mm')} AS precipitacao_mm, intensidade_chuva FROM stored",
            "orders",
            STORED_CTE,
        ),
    ),
    "src01_station_file_list": Query(
        lambda s, d: station_csv.list_files(s, landing.station_files(s, d)).select(_file_name().alias("arquivo")).distinct(),
        sql(f"SELECT DISTINCT {FILE_NAME} AS arquivo FROM obs"),
    ),
    "src02_station_file_rows": Query(
        lambda s, d: files(s, d).observations.drop("arquivo", "bloco", "linha", "intensidade_chuva"),
        sql(f"""SELECT codigo_wmo, {text('data')} AS data, {MINUTE} AS hora_utc,
  date_trunc('minute', timestamp_utc) AS timestamp_utc, {MEASURES} FROM obs"""),
    ),
    "src03_width_rules": Query(
        lambda s, d: files(s, d, faults=True).observations.select("codigo_wmo", "data", "hora_utc", "precipitacao_mm", "vento_velocidade_ms"),
        sql(f"""SELECT codigo_wmo, {text('data')} AS data, {MINUTE} AS hora_utc,
  CASE WHEN id % 8 = {landing.SHORT} AND CAST(codigo_wmo AS BIGINT) % 2 = 1 THEN NULL ELSE {dbl('precipitacao_mm')} END AS precipitacao_mm,
  CASE WHEN id % 8 = {landing.SHORT} AND CAST(codigo_wmo AS BIGINT) % 2 = 0 THEN NULL ELSE {dbl('vento_velocidade_ms')} END AS vento_velocidade_ms
FROM obs WHERE id % 8 NOT IN ({landing.WIDE}, {landing.DATELESS}, {landing.HOURLESS}, {landing.LARGE}, {landing.BLANK})"""),
    ),
    "src05_rejected_files": Query(
        lambda s, d: station_csv.read_station_files(s, landing.broken_files(s, d)).files.select(_file_name().alias("arquivo"), "erro"),
        sql("""SELECT 'E' || codigo_wmo AS arquivo, CASE CAST(codigo_wmo AS BIGINT) % 4 WHEN 0 THEN 'no data header'
  WHEN 1 THEN 'no station code before the header' WHEN 2 THEN 'bad coordinate' END AS erro FROM est
WHERE codigo_wmo IN (SELECT codigo_wmo FROM obs)"""),
    ),
    "src07_rejected_rows": Query(
        _rejected_rows,
        sql(f"""SELECT id, codigo_wmo, CASE id % 8 WHEN {landing.WIDE} THEN '{station_csv.TOO_WIDE}' WHEN {landing.DATELESS} THEN '{station_csv.BAD_DATE}'
  WHEN {landing.HOURLESS} THEN '{station_csv.BAD_HOUR}' ELSE '{station_csv.OUT_OF_RANGE}' END AS motivo
FROM obs WHERE id % 8 IN ({landing.WIDE}, {landing.DATELESS}, {landing.HOURLESS}, {landing.LARGE})"""),
    ),
    "snk07_report_with_rejects": Query(
        lambda s, d: files(s, d, faults=True).report().groupBy("estacao", "erro").agg(
            F.sum("registros").alias("registros"), F.sum("rejeitados").alias("rejeitados")
        ),
        sql(f"""SELECT e.nome AS estacao, CAST(NULL AS VARCHAR) AS erro, COUNT(*) FILTER (WHERE id % 8 IN ({landing.SHORT}, 6, 7)) AS registros,
  COUNT(*) FILTER (WHERE id % 8 IN ({landing.WIDE}, {landing.DATELESS}, {landing.HOURLESS}, {landing.LARGE})) AS rejeitados
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo GROUP BY e.nome"""),
    ),
    "src04_file_stations": Query(
        lambda s, d: _station_key(files(s, d).stations).distinct(),
        sql(f"""SELECT codigo_wmo, regiao, uf, nome, {dbl('latitude')} AS latitude, {dbl('longitude')} AS longitude,
  {dbl('altitude')} AS altitude FROM est WHERE codigo_wmo IN (SELECT codigo_wmo FROM obs)"""),
    ),
    "src08_discovered_stations": Query(
        lambda s, d: station_csv.discover_stations(
            station_csv.read_lines(s, landing.station_files(s, d))
        ).select("codigo_wmo", "nome", "latitude", "longitude", "altitude"),
        sql(f"""SELECT codigo_wmo, nome, {dbl('latitude')} AS latitude, {dbl('longitude')} AS longitude,
  {dbl('altitude')} AS altitude FROM est WHERE codigo_wmo IN (SELECT codigo_wmo FROM obs)"""),
    ),
    "src09_replay_records": Query(
        lambda s, d: station_csv.replay_records(s, landing.station_files(s, d)).select(
            "ts", *[F.col("values")[k].alias(k) for k in S.TELEMETRY_KEYS]
        ),
        sql(
            "SELECT CAST(epoch_ms(date_trunc('minute', timestamp_utc)) AS BIGINT) AS ts, "
            + ", ".join(
                f"COALESCE({dbl(m)}, 0) AS {k}"
                if S.CSV_TITLES[m][0] == S.CSV_TITLES[m][1]
                else f"CASE WHEN CAST(codigo_wmo AS BIGINT) % 2 = 0 THEN COALESCE({dbl(m)}, 0) ELSE 0 END AS {k}"
                for k, m in S.TELEMETRY_KEYS.items()
            )
            + " FROM obs"
        ),
    ),
    "snk07_load_report": Query(
        lambda s, d: files(s, d).report().groupBy("estacao", "erro").agg(
            F.sum("registros").alias("registros"), F.sum("rejeitados").alias("rejeitados")
        ),
        sql("""SELECT e.nome AS estacao, CAST(NULL AS VARCHAR) AS erro, COUNT(*) AS registros, CAST(0 AS BIGINT) AS rejeitados
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo GROUP BY e.nome"""),
    ),
    "snk07_load_summary": Query(
        lambda s, d: station_csv.load_summary(files(s, d).report()),
        sql("""SELECT COUNT(DISTINCT codigo_wmo) AS total_arquivos, COUNT(DISTINCT codigo_wmo) AS estacoes_processadas,
  COUNT(*) AS total_registros, CAST(0 AS BIGINT) AS arquivos_com_erro FROM obs"""),
    ),
    "snk02_load_station_files": Query(
        lambda s, d: _loaded_files(s, d).drop("id", "created_at", S.MONTH_PARTITION),
        sql(
            f"""SELECT codigo_wmo, {text('data')} AS data, {MINUTE} AS hora_utc,
  date_trunc('minute', timestamp_utc) AS timestamp_utc, {MEASURES}, {RULE} AS intensidade_chuva FROM last""",
            extra=LAST_ROW,
        ),
    ),
    "snk02_observation_upsert": Query(
        lambda s, d: _two_loads(s, d).select(
            "codigo_wmo", "data", "hora_utc", "timestamp_utc", "precipitacao_mm", "temperatura_ar_c", "intensidade_chuva"
        ),
        sql(
            f"""SELECT codigo_wmo, {text('data')} AS data, clock AS hora_utc, date_trunc('hour', timestamp_utc) AS timestamp_utc,
  {dbl('precipitacao_mm')} AS precipitacao_mm, {dbl('temperatura_ar_c')} AS temperatura_ar_c, {RULE} AS intensidade_chuva
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY codigo_wmo, data, clock ORDER BY carga DESC, id DESC) AS rn FROM (
  SELECT id, codigo_wmo, data, clock, timestamp_utc, precipitacao_mm, temperatura_ar_c, 1 AS carga FROM hr
  UNION ALL SELECT id, codigo_wmo, data, clock, timestamp_utc,
    CAST(CAST(floor(precipitacao_mm * 10) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(8,2)), temperatura_ar_c, 2
  FROM hr WHERE umidade_rel_horaria_pct >= 50) AS loads) AS ranked WHERE rn = 1""",
            extra=LAST_HOUR,
        ),
    ),
    "snk02_unknown_stations": Query(
        _unknown_stations,
        sql(
            f"""SELECT DISTINCT codigo_wmo, {text('data')} AS data, clock AS hora_utc, 'tabela' AS destino
FROM hr WHERE codigo_wmo IN (SELECT codigo_wmo FROM est WHERE altitude > 150)
UNION ALL SELECT codigo_wmo, {text('data')}, clock, 'rejeitada'
FROM hr WHERE codigo_wmo NOT IN (SELECT codigo_wmo FROM est WHERE altitude > 150)""",
            extra=LAST_HOUR,
        ),
    ),
    "snk01_station_upsert": Query(
        _station_loads,
        sql(f"""SELECT codigo_wmo, regiao, uf, CASE WHEN altitude > 150 THEN upper(nome) ELSE nome END AS nome,
  {dbl('latitude')} AS latitude, {dbl('longitude')} AS longitude, {dbl('altitude')} AS altitude,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at,
  CASE WHEN altitude > 150 THEN TIMESTAMP '2024-02-02 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at
FROM est"""),
    ),
    "snk03_timestamp_from_parts": Query(
        lambda s, d: upsert.with_timestamp(
            mapping.raw_observations(s, d).withColumn(
                "timestamp_utc", F.when(F.col("precipitacao_mm") > 1, F.col("timestamp_utc"))
            )
        ).select("id", "timestamp_utc"),
        sql("""SELECT id, CASE WHEN precipitacao_mm > 1 THEN timestamp_utc ELSE date_trunc('second', timestamp_utc) END AS timestamp_utc
FROM obs"""),
    ),
    "snk04_prediction_append": Query(
        _prediction_log,
        sql(
            """SELECT intensidade_predita, TIMESTAMP '2024-02-01 00:00:00' AS created_at, COUNT(*) AS registros FROM pred GROUP BY 1
UNION ALL SELECT intensidade_predita, TIMESTAMP '2024-02-02 00:00:00', COUNT(*) FROM pred
WHERE intensidade_predita = 'forte' GROUP BY 1""",
            extra=pred_map.CTE,
        ),
    ),
    "snk05_raw_landing": Query(
        _landed,
        sql(
            f"""SELECT device_id, 'Estacao_' || pt.codigo_wmo || '_' || MAX(e.regiao) AS device_name, pt.codigo_wmo,
  MAX(e.nome) AS nome, MAX(e.uf) AS estado, ts AS timestamp, {WIDE_KEYS}
FROM pt JOIN est e ON e.codigo_wmo = pt.codigo_wmo GROUP BY device_id, pt.codigo_wmo, ts""",
            extra=HOUR_POINTS,
        ),
    ),
    "src10_telemetry_points": Query(
        lambda s, d: points(s, d).select("device_id", "key", "ts", F.col("value").cast("double").alias("value")),
        sql(f"SELECT device_id, key, ts, {dbl('valor')} AS value FROM pt", extra=HOUR_POINTS),
    ),
    "src10_points_with_attributes": Query(
        lambda s, d: telemetry.points_with_attributes(points(s, d), devices(s, d)).select(
            "device_id", "key", "ts", F.col("attributes")["nome"].alias("nome"), F.col("attributes")["estado"].alias("estado")
        ),
        sql(
            "SELECT device_id, key, ts, e.nome, e.uf AS estado FROM pt JOIN est e ON e.codigo_wmo = pt.codigo_wmo",
            extra=HOUR_POINTS,
        ),
    ),
    "src11_bounded_points": Query(
        lambda s, d: telemetry.bounded_points(points(s, d), 1706659199000, limit=40).select(
            "device_id", "key", "ts"
        ),
        sql(
            """SELECT device_id, key, ts FROM (SELECT device_id, key, ts,
  ROW_NUMBER() OVER (PARTITION BY device_id, key ORDER BY ts DESC) AS rn FROM pt
  WHERE ts BETWEEN 1706659199000 - 730 * CAST(86400000 AS BIGINT) AND 1706659199000) AS r WHERE rn <= 40""",
            extra=HOUR_POINTS,
        ),
    ),
    "src12_device_attributes": Query(
        lambda s, d: devices(s, d).select(
            "device_id", *[F.col("attributes")[k].alias(k) for k in ("codigo_wmo", "nome", "estado", "tipo")],
            F.col("attributes")["altitude"].cast("double").alias("altitude"), F.size("attributes").alias("chaves"),
        ),
        sql(f"""SELECT 'dev-' || codigo_wmo AS device_id, codigo_wmo, nome, uf AS estado, 'Estação Automática' AS tipo,
  {dbl('altitude')} AS altitude, 7 AS chaves FROM est"""),
    ),
    "nb05_wide_records": Query(
        lambda s, d: telemetry.wide_records(points(s, d)).withColumns(
            {k: F.col(k).cast("double") for k in S.TELEMETRY_KEYS}
        ),
        sql(f"SELECT device_id, ts, {WIDE_KEYS} FROM pt GROUP BY device_id, ts", extra=HOUR_POINTS),
    ),
    "prj13_telemetry_observations": Query(
        lambda s, d: telemetry.observations(telemetry.wide_records(points(s, d)), devices(s, d)).drop(
            "intensidade_chuva", *UNSENT
        ),
        sql(DEVICE_OBS, extra=HOUR_POINTS),
    ),
    "prj14_station_codes": Query(
        lambda s, d: devices(s, d).select(
            "device_id",
            telemetry.station_code(F.col("name"), F.col("attributes")).alias("com_atributos"),
            telemetry.station_code(F.col("name"), F.create_map().cast("map<string,string>")).alias("do_nome"),
            telemetry.station_code(F.col("label"), F.col("attributes")).alias("sem_sublinhado"),
        ),
        sql("""SELECT 'dev-' || codigo_wmo AS device_id, codigo_wmo AS com_atributos, codigo_wmo AS do_nome,
  CAST(NULL AS VARCHAR) AS sem_sublinhado FROM est"""),
    ),
    "prj15_telemetry_stations": Query(
        lambda s, d: telemetry.stations(telemetry.wide_records(points(s, d)), devices(s, d)).drop("data_fundacao"),
        sql(f"""SELECT codigo_wmo, 'NORDESTE' AS regiao, uf, nome, {dbl('latitude')} AS latitude, {dbl('longitude')} AS longitude,
  {dbl('altitude')} AS altitude FROM est WHERE codigo_wmo IN (SELECT codigo_wmo FROM obs)"""),
    ),
    "prj16_epoch_times": Query(
        lambda s, d: mapping.raw_observations(s, d).select("id", epoch_ms(F.col("timestamp_utc")).alias("ts")).select(
            "id", "ts", from_epoch_ms(F.col("ts")).alias("timestamp_utc")
        ),
        sql("""SELECT id, epoch_us(timestamp_utc) // 1000 AS ts, date_trunc('milliseconds', timestamp_utc) AS timestamp_utc FROM obs"""),
    ),
    "prj18_device_names": Query(
        lambda s, d: telemetry.fixed_device_names(devices(s, d)),
        sql("""SELECT 'dev-' || codigo_wmo AS device_id, 'Estacao_' || codigo_wmo || '_' || regiao AS old_name,
  replace('Estacao_' || codigo_wmo || '_' || regiao, ' ', '_') AS new_name, replace(nome || ' ' || regiao, ' ', '_') AS new_label
FROM est WHERE contains(regiao, ' ')"""),
    ),
    "prj18_normal_names": Query(
        lambda s, d: est(s, d).select(
            "codigo_wmo", telemetry.device_name(F.col("codigo_wmo"), F.concat_ws("-", "nome", "regiao")).alias("nome")
        ),
        sql("""SELECT codigo_wmo, 'Estacao_' || codigo_wmo || '_' || upper(replace(replace(nome || '-' || regiao, ' ', '_'), '-', '_')) AS nome
FROM est"""),
    ),
    "jn09_file_station_codes": Query(
        _file_codes,
        sql(f"""SELECT arquivo, arg_min(b.codigo_wmo, 'ESTACAO_' || b.codigo_wmo || '_2024-01_0/') AS codigo_wmo
FROM (SELECT DISTINCT {FILE_NAME} AS arquivo FROM obs) AS a JOIN (SELECT DISTINCT codigo_wmo FROM obs) AS b ON contains(a.arquivo, b.codigo_wmo) GROUP BY arquivo"""),
    ),
    "dq13_telemetry_coverage": Query(
        lambda s, d: profile.telemetry_coverage(points(s, d), devices(s, d)).select("device_id", "key", "pontos"),
        sql(
            """SELECT 'dev-' || e.codigo_wmo AS device_id, pt.key, COUNT(pt.id) AS pontos
FROM est e LEFT JOIN pt ON pt.codigo_wmo = e.codigo_wmo GROUP BY e.codigo_wmo, pt.key""",
            extra=HOUR_POINTS,
        ),
    ),
    "dq13_device_telemetry": Query(
        lambda s, d: profile.device_telemetry(points(s, d), devices(s, d)),
        sql(
            """SELECT 'dev-' || e.codigo_wmo AS device_id, 'Estacao_' || e.codigo_wmo || '_' || e.regiao AS name, 'estacao' AS type,
  7 AS atributos, TRUE AS tem_atributos, COUNT(pt.id) AS total_pontos
FROM est e LEFT JOIN pt ON pt.codigo_wmo = e.codigo_wmo GROUP BY e.codigo_wmo, e.regiao""",
            extra=HOUR_POINTS,
        ),
    ),
    "dq13_telemetry_summary": Query(
        lambda s, d: profile.telemetry_summary(points(s, d), devices(s, d)),
        sql(
            """SELECT COUNT(*) AS dispositivos, CAST(SUM(n) AS BIGINT) AS total_pontos, COUNT(*) FILTER (WHERE n > 0) AS com_telemetria,
  COUNT(*) FILTER (WHERE n = 0) AS sem_telemetria,
  CAST((2 * CAST(SUM(n) AS BIGINT) * 100 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS media_pontos
FROM (SELECT e.codigo_wmo, COUNT(pt.id) AS n FROM est e LEFT JOIN pt ON pt.codigo_wmo = e.codigo_wmo GROUP BY e.codigo_wmo) AS c""",
            extra=HOUR_POINTS,
        ),
    ),
    "st01_streamed_observations": Query(
        lambda s, d: upsert.read_observations(s, _streamed(s, d)["table"]).drop("id", "created_at", S.MONTH_PARTITION, *UNSENT),
        sql(
            f"""SELECT *, {RULE} AS intensidade_chuva FROM ({DEVICE_OBS}) AS w""",
            extra=HOUR_POINTS,
        ),
    ),
    "st01_streamed_stations": Query(
        lambda s, d: upsert.read_stations(s, _streamed(s, d)["stations"]).drop("data_fundacao", "created_at"),
        sql(f"""SELECT codigo_wmo, 'NORDESTE' AS regiao, uf, nome, {dbl('latitude')} AS latitude, {dbl('longitude')} AS longitude,
  {dbl('altitude')} AS altitude, TIMESTAMP '{NOW}' AS updated_at FROM est WHERE codigo_wmo IN (SELECT codigo_wmo FROM obs)"""),
    ),
    "st01_stream_rejects": Query(
        lambda s, d: s.read.parquet(
            _streamed(s, d, devices(s, d).where(F.substring("device_id", 5, 20).cast("bigint") % 7 != 0))["rejects"]
        ).select("device_id", "ts", "motivo").distinct(),
        sql(
            "SELECT DISTINCT device_id, ts, 'unknown device' AS motivo FROM pt WHERE CAST(codigo_wmo AS BIGINT) % 7 = 0",
            extra=HOUR_POINTS,
        ),
    ),
    "st02_stream_half_hours": Query(lambda s, d: _stream_means(s, d, 1), STREAM_SQL),
    "st03_stream_deduplicated": Query(lambda s, d: _stream_means(s, d, 2), STREAM_SQL),
}
