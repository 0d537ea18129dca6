"""Registered queries: labels, features, training, evaluation, scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.rainfall import rainfall_class
from pluvio.ml import evaluation, features, models, runs, scoring
from pluvio.session import fresh_path
from pluvio.sources import extracts
from pluvio.workload import predictions as pred_map
from pluvio.workload.common import Query, dbl, est, obs, sql

C = "intensidade_chuva"
NOW = dt.datetime(2024, 2, 1)
AS_OF = "2024-01-30 23:59:59"
FEATURE_SQL = {
    **{f: f"COALESCE({dbl(f)}, 0)" for f in S.FEATURES if f in S.MEASURES},
    "ano": dbl("extract('year' FROM timestamp_utc)"),
    "mes": dbl("extract('month' FROM timestamp_utc)"),
    "dia": dbl("extract('day' FROM timestamp_utc)"),
    "hora": dbl("extract('hour' FROM timestamp_utc)"),
    "dia_semana": dbl("extract('dow' FROM timestamp_utc)"),
}
PARTS_SQL = ", ".join(
    f"CAST(extract('{part}' FROM timestamp_utc) AS INTEGER) AS {name}"
    for part, name in [("year", "ano"), ("month", "mes"), ("day", "dia"), ("hour", "hora"), ("dow", "dia_semana")]
)
LABEL_SQL = "CASE {c} WHEN 'forte' THEN 0 WHEN 'leve' THEN 1 WHEN 'moderada' THEN 2 WHEN 'sem_chuva' THEN 3 END"
SIDES_CTE = f""", drawn AS (SELECT *, CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 14) AS BIGINT) AS draw,
  CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':43'), 1, 14) AS BIGINT) AS fold_draw FROM obs WHERE {C} IS NOT NULL),
sides AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY {C} ORDER BY draw) <= (COUNT(*) OVER (PARTITION BY {C}) * 40 + 100) // 200
  THEN 'teste' ELSE 'treino' END AS lado FROM drawn)"""
SUPPORT_SQL = f"""SELECT k.classe, COUNT(s.id) AS suporte, TRUE AS acima_do_piso
FROM (VALUES ('forte'), ('leve'), ('moderada'), ('sem_chuva')) AS k(classe)
LEFT JOIN (SELECT id, {C} FROM sides WHERE lado = 'teste') AS s ON s.{C} = k.classe GROUP BY k.classe"""


def training(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.training_rows(obs(spark, folder))


def _vectors(rows: DataFrame, column: str) -> DataFrame:
    cells = vector_to_array(column)
    return rows.select("id", *[cells[i].alias(f) for i, f in enumerate(S.FEATURES)])


def _assembled(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.model_rows(training(spark, folder))
    return _vectors(features.vector_stages()[0].transform(rows), "raw_features")


def _scaled(spark: SparkSession, folder: str) -> DataFrame:
    """All rows scaled by the mean and deviation of the training share."""
    rows = features.model_rows(training(spark, folder))
    train, _ = features.train_test_split(rows)
    assembler, scaler = features.vector_stages()
    fitted = scaler.fit(assembler.transform(train))
    cells = _vectors(fitted.transform(assembler.transform(rows)), "features")
    return cells.withColumns({f: F.round(f, 6) for f in S.FEATURES})


#: What a score must reach on rows that a model has not seen; the class follows from rain, a feature.
FLOOR = 0.9


def _scores(spark: SparkSession, folder: str, classifier: Callable[[int], Estimator]) -> DataFrame:
    """Fit on the training side, report the other: support of every class and whether the scores reach the floor."""
    path = fresh_path(spark, "sides")
    features.with_side(features.model_rows(training(spark, folder))).write.parquet(path)
    sides = spark.read.parquet(path)
    train, test = (sides.where(F.col("lado") == side) for side in ("treino", "teste"))
    scored = models.pipeline(classifier(train.count())).fit(train).transform(test)
    report = evaluation.class_report(scored)
    least = evaluation.report_summary(report).where("classe <> 'macro avg'").agg(F.min("f1")).first()[0]
    return report.select("classe", "suporte", F.lit(least >= FLOOR).alias("acima_do_piso"))


def _logistic(spark: SparkSession, folder: str) -> PipelineModel:
    rows = features.model_rows(training(spark, folder))
    return models.pipeline(models.logistic_regression(rows.count())).fit(rows)


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """Rule class against predicted class of every event, as label indices."""
    predicted = pred_map.predictions(spark, folder)
    return predicted.select(
        features.label_index(rainfall_class(F.col("precipitacao_mm"))).alias("label"),
        features.label_index(F.col("intensidade_predita")).alias("prediction"),
    )


def _cross_validated(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every class in every fold of the training side, and whether the mean accuracy reaches the floor."""
    path = fresh_path(spark, "folds")
    train, _ = features.train_test_split(features.model_rows(training(spark, folder)))
    features.with_fold(train, "parte").write.parquet(path)
    rows = spark.read.parquet(path)
    mean, deviation = evaluation.cross_validate(rows, models.pipeline(models.logistic_regression(rows.count())))
    return rows.groupBy("parte", C).agg(
        F.count("*").alias("registros"), F.lit(mean >= FLOOR).alias("media_acima_do_piso"), F.lit(0 <= deviation < 0.1).alias("desvio_pequeno")
    )


def _run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every classifier there is, trained, cross-validated and logged, best first."""
    path = fresh_path(spark, "runs")
    rows = training(spark, folder)
    staged = fresh_path(spark, "training")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    table = runs.train_all(spark, path, rows, NOW)
    scored = ["train_accuracy", "test_accuracy", "test_precision", "test_recall", "test_f1", "cv_accuracy_mean"]
    return runs.best_runs(table).select(
        "model_name",
        "status",
        (F.least(*scored) >= FLOOR).alias("acima_do_piso"),
        F.col("cv_accuracy_std").isNotNull().alias("com_desvio"),
        (F.size("params") > 0).alias("com_parametros"),
        F.col("model_path").endswith(F.col("run_id")).alias("com_modelo"),
        "created_at",
    )


def _batch_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Every row as a batch request; a text that is no number marks a bad row."""
    requests = obs(spark, folder).select(
        "id",
        *[F.col(m).cast("string").alias(m) for m in S.FEATURES if m in S.MEASURES and m != "vento_direcao_graus"],
        F.when(F.col("vento_direcao_graus") > 359, "norte").otherwise(F.col("vento_direcao_graus").cast("string")).alias(
            "vento_direcao_graus"
        ),
    )
    scored = scoring.score(scoring.batch_defaults(requests), _logistic(spark, folder), "LogisticRegression")
    shares = [F.col(f"probabilidade_{c}") for c in S.LABELS]
    whole = sum(shares[1:], shares[0])
    highest = F.get(F.array(*shares), F.col("codigo_predito"))
    return scored.select(
        "id",
        "erro",
        "modelo_usado",
        F.col("intensidade_predita").isin(S.CLASSES).alias("com_classe"),
        (F.abs(whole - 1) < 1e-9).alias("somam_um"),
        (highest == F.greatest(*shares)).alias("classe_mais_provavel"),
    )


def _scored_log(spark: SparkSession, folder: str) -> DataFrame:
    """Recent rows scored and appended to a fresh prediction log."""
    path = fresh_path(spark, "predictions")
    scoring.score_and_append(
        obs(spark, folder), est(spark, folder), _logistic(spark, folder), "LogisticRegression", path, AS_OF, 100
    )
    log = spark.read.schema(S.PREDICTIONS).parquet(path)
    return log.select(
        "codigo_wmo", "estacao_nome", "timestamp_utc", "precipitacao_mm", "modelo_usado", "created_at",
        F.col("intensidade_predita").isin(S.CLASSES).alias("com_classe"),
    )


def _request_rows(spark: SparkSession, folder: str) -> DataFrame:
    needed = ["precipitacao_mm", "pressao_estacao_mb", "temperatura_ar_c", "umidade_rel_horaria_pct", "vento_velocidade_ms"]
    optional = ["pressao_max_mb", "pressao_min_mb", "temperatura_max_c", "temperatura_min_c", "umidade_rel_max_pct",
                "umidade_rel_min_pct", "vento_direcao_graus", "vento_rajada_max_ms", "radiacao_global_kjm2"]
    return obs(spark, folder).select("id", *needed, *optional)


def _or(column: str, default: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {column} = 0 THEN {dbl(default)} ELSE {dbl(column)} END"


PRESS, TEMP, HUM = (
    _or("pressao_estacao_mb", "1013"),
    _or("temperatura_ar_c", "25"),
    _or("umidade_rel_horaria_pct", "70"),
)
WIND = _or("vento_velocidade_ms", "0")

QUERIES = {
    "ml01_label_index": Query(
        lambda s, d: features.label_indexer().transform(training(s, d)).select("id", C, "label"),
        sql(f"SELECT id, {C}, {dbl(LABEL_SQL.format(c=C))} AS label FROM obs WHERE {C} IS NOT NULL"),
    ),
    "ml02_feature_vector": Query(
        _assembled,
        sql(f"SELECT id, {', '.join(f'{v} AS {k}' for k, v in FEATURE_SQL.items())} FROM obs WHERE {C} IS NOT NULL"),
    ),
    "ml03_train_test_split": Query(
        lambda s, d: features.with_side(training(s, d)).select("id", "lado"),
        sql("SELECT id, lado FROM sides", extra=SIDES_CTE),
    ),
    "ml04_standard_scaling": Query(
        _scaled,
        sql(
            "SELECT f.id, "
            + ", ".join(
                f"CASE WHEN s_{k} = 0 THEN 0 ELSE round((f.{k} - m_{k}) / s_{k}, 6) END AS {k}" for k in S.FEATURES
            )
            + " FROM f, fit",
            extra=SIDES_CTE
            + f""", f AS (SELECT id, lado, {', '.join(f'{v} AS {k}' for k, v in FEATURE_SQL.items())} FROM sides),
fit AS (SELECT {', '.join(f'AVG({k}) AS m_{k}, stddev_samp({k}) AS s_{k}' for k in S.FEATURES)} FROM f WHERE lado = 'treino')""",
        ),
    ),
    "ml05_random_forest": Query(lambda s, d: _scores(s, d, lambda _: models.random_forest()), sql(SUPPORT_SQL, extra=SIDES_CTE)),
    "ml06_gradient_boosting": Query(lambda s, d: _scores(s, d, lambda _: models.gradient_boosting()), sql(SUPPORT_SQL, extra=SIDES_CTE)),
    "ml07_logistic_regression": Query(lambda s, d: _scores(s, d, models.logistic_regression), sql(SUPPORT_SQL, extra=SIDES_CTE)),
    "ml09_scores": Query(
        lambda s, d: evaluation.scores(_compared(s, d)).select(
            "accuracy", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
        ),
        sql(
            """SELECT SUM(tp) / SUM(support) AS accuracy,
  round(SUM(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END * support) / SUM(support), 9) AS precision,
  round(SUM(CASE WHEN support > 0 THEN tp / support ELSE 0 END * support) / SUM(support), 9) AS recall,
  round(SUM(CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END * support) / SUM(support), 9) AS f1
FROM (SELECT c.classe, CAST(COUNT(*) FILTER (WHERE real = c.classe AND predita = c.classe) AS DOUBLE) AS tp,
    CAST(COUNT(*) FILTER (WHERE predita = c.classe) AS DOUBLE) AS predicted,
    CAST(COUNT(*) FILTER (WHERE real = c.classe) AS DOUBLE) AS support
  FROM cmp, (VALUES ('forte'), ('leve'), ('moderada'), ('sem_chuva')) AS c(classe) GROUP BY c.classe) AS k""",
            extra=pred_map.COMPARED_CTE,
        ),
    ),
    "ml10_cross_validation": Query(
        _cross_validated,
        sql(
            f"""SELECT CAST((SELECT COUNT(*) FROM range(1, 5) AS j(j) WHERE (n * j) // 5 <= place) AS INTEGER) AS parte, {C}, COUNT(*) AS registros,
  TRUE AS media_acima_do_piso, TRUE AS desvio_pequeno
FROM (SELECT {C}, ROW_NUMBER() OVER (PARTITION BY {C} ORDER BY fold_draw) - 1 AS place, COUNT(*) OVER (PARTITION BY {C}) AS n
  FROM sides WHERE lado = 'treino') AS placed GROUP BY 1, 2""",
            extra=SIDES_CTE,
        ),
    ),
    "ml11_confusion_matrix": Query(
        lambda s, d: evaluation.confusion_matrix(_compared(s, d)),
        sql(
            """SELECT a.classe AS classe_real, b.classe AS classe_predita, COUNT(cmp.real) AS registros
FROM (VALUES ('forte'), ('leve'), ('moderada'), ('sem_chuva')) AS a(classe),
  (VALUES ('forte'), ('leve'), ('moderada'), ('sem_chuva')) AS b(classe)
LEFT JOIN cmp ON cmp.real = a.classe AND cmp.predita = b.classe GROUP BY a.classe, b.classe""",
            extra=pred_map.COMPARED_CTE,
        ),
    ),
    "ml11_class_report": Query(
        lambda s, d: evaluation.class_report(_compared(s, d)).drop("certos", "preditos"),
        sql(
            """SELECT classe, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precisao,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS revocacao,
  CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1, CAST(support AS BIGINT) AS suporte
FROM (SELECT c.classe, CAST(COUNT(*) FILTER (WHERE real = c.classe AND predita = c.classe) AS DOUBLE) AS tp,
    CAST(COUNT(*) FILTER (WHERE predita = c.classe) AS DOUBLE) AS predicted,
    CAST(COUNT(*) FILTER (WHERE real = c.classe) AS DOUBLE) AS support
  FROM cmp, (VALUES ('forte'), ('leve'), ('moderada'), ('sem_chuva')) AS c(classe) GROUP BY c.classe) AS k""",
            extra=pred_map.COMPARED_CTE,
        ),
    ),
    "ml11_report_summary": Query(
        lambda s, d: evaluation.report_summary(evaluation.class_report(_compared(s, d))).withColumns(
            {c: F.round(c, 9) for c in ("precisao", "revocacao", "f1")}
        ),
        sql(
            """SELECT r.classe, round(CASE r.classe WHEN 'macro avg' THEN mp WHEN 'weighted avg' THEN wp END, 9) AS precisao,
  round(CASE r.classe WHEN 'macro avg' THEN mr WHEN 'weighted avg' THEN wr END, 9) AS revocacao,
  round(CASE r.classe WHEN 'macro avg' THEN mf WHEN 'weighted avg' THEN wf ELSE acc END, 9) AS f1, suporte
FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) AS r(classe), (
  SELECT AVG(p) FILTER (WHERE predicted + support > 0) AS mp, AVG(r) FILTER (WHERE predicted + support > 0) AS mr,
    AVG(f) FILTER (WHERE predicted + support > 0) AS mf, SUM(p * support) / SUM(support) AS wp, SUM(r * support) / SUM(support) AS wr,
    SUM(f * support) / SUM(support) AS wf, SUM(tp) / SUM(support) AS acc, CAST(SUM(support) AS BIGINT) AS suporte
  FROM (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r,
      CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f
    FROM (SELECT c.classe, CAST(COUNT(*) FILTER (WHERE real = c.classe AND predita = c.classe) AS DOUBLE) AS tp,
        CAST(COUNT(*) FILTER (WHERE predita = c.classe) AS DOUBLE) AS predicted,
        CAST(COUNT(*) FILTER (WHERE real = c.classe) AS DOUBLE) AS support
      FROM cmp, (VALUES ('forte'), ('leve'), ('moderada'), ('sem_chuva')) AS c(classe) GROUP BY c.classe) AS k) AS s) AS t""",
            extra=pred_map.COMPARED_CTE,
        ),
    ),
    "ml12_run_log": Query(
        _run_log,
        # Every classifier there is: the optional one is left out of the statement where it is not installed.
        " UNION ALL ".join(
            f"SELECT '{name}' AS model_name, 'FINISHED' AS status, TRUE AS acima_do_piso, TRUE AS com_desvio, TRUE AS com_parametros, "
            f"TRUE AS com_modelo, TIMESTAMP '{NOW}' AS created_at"
            for name in ("RandomForest", "GradientBoosting", "LogisticRegression", *(["XGBoost"] if models.xgboost_installed() else []))
        ),
    ),
    "ml13_batch_scoring": Query(
        _batch_scored,
        sql(
            """SELECT id, erro, CASE WHEN erro IS NULL THEN 'LogisticRegression' END AS modelo_usado, CASE WHEN erro IS NULL THEN TRUE END AS com_classe,
  CASE WHEN erro IS NULL THEN TRUE END AS somam_um, CASE WHEN erro IS NULL THEN TRUE END AS classe_mais_provavel
FROM (SELECT id, CASE WHEN vento_direcao_graus > 359 THEN 'vento_direcao_graus is not a number' END AS erro FROM obs) AS o"""
        ),
    ),
    "ml14_request_defaults": Query(
        lambda s, d: scoring.request_defaults(_request_rows(s, d), NOW),
        sql(f"""SELECT id, {", ".join(f"{dbl(m)} AS {m}" for m in ["precipitacao_mm", "pressao_estacao_mb", "temperatura_ar_c", "umidade_rel_horaria_pct", "vento_velocidade_ms"])},
  {_or('pressao_max_mb', 'pressao_estacao_mb')} AS pressao_max_mb, {_or('pressao_min_mb', 'pressao_estacao_mb')} AS pressao_min_mb,
  {_or('temperatura_max_c', 'temperatura_ar_c')} AS temperatura_max_c, {_or('temperatura_min_c', 'temperatura_ar_c')} AS temperatura_min_c,
  {_or('umidade_rel_max_pct', 'umidade_rel_horaria_pct')} AS umidade_rel_max_pct,
  {_or('umidade_rel_min_pct', 'umidade_rel_horaria_pct')} AS umidade_rel_min_pct,
  {_or('vento_direcao_graus', '0')} AS vento_direcao_graus, {_or('vento_rajada_max_ms', 'vento_velocidade_ms')} AS vento_rajada_max_ms,
  {_or('radiacao_global_kjm2', '0')} AS radiacao_global_kjm2, 2024 AS ano, 2 AS mes, 1 AS dia, 0 AS hora, 4 AS dia_semana FROM obs"""),
    ),
    "ml15_table_defaults": Query(
        lambda s, d: scoring.table_defaults(obs(s, d).select("id", "timestamp_utc", *[f for f in S.FEATURES if f in S.MEASURES])),
        sql(f"""SELECT id, timestamp_utc, {_or('precipitacao_mm', '0')} AS precipitacao_mm, {PRESS} AS pressao_estacao_mb,
  {PRESS} AS pressao_max_mb, {PRESS} AS pressao_min_mb, {TEMP} AS temperatura_ar_c, {TEMP} AS temperatura_max_c,
  {TEMP} AS temperatura_min_c, {HUM} AS umidade_rel_horaria_pct, {HUM} AS umidade_rel_max_pct, {HUM} AS umidade_rel_min_pct,
  {WIND} AS vento_velocidade_ms, CAST(0 AS DOUBLE) AS vento_direcao_graus, {WIND} AS vento_rajada_max_ms,
  {_or('radiacao_global_kjm2', '0')} AS radiacao_global_kjm2, {PARTS_SQL} FROM obs"""),
    ),
    "ml16_batch_defaults": Query(
        lambda s, d: scoring.batch_defaults(obs(s, d).select("id", *[f for f in S.FEATURES if f in S.MEASURES])),
        sql(f"""SELECT id, {", ".join(f"COALESCE({dbl(m)}, 0) AS {m}" for m in S.FEATURES if m in S.MEASURES)},
  {", ".join(f"CAST(0 AS DOUBLE) AS {m}" for m in S.FEATURES if m not in S.MEASURES)}, CAST(NULL AS VARCHAR) AS erro FROM obs"""),
    ),
    "ml17_score_and_append": Query(
        _scored_log,
        sql(f"""SELECT o.codigo_wmo, e.nome AS estacao_nome, timestamp_utc, {_or('precipitacao_mm', '0')} AS precipitacao_mm,
  'LogisticRegression' AS modelo_usado, TIMESTAMP '{AS_OF}' AS created_at, TRUE AS com_classe
FROM obs o JOIN est e ON o.codigo_wmo = e.codigo_wmo WHERE timestamp_utc BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '24 hours' AND TIMESTAMP '{AS_OF}'
ORDER BY timestamp_utc DESC, o.codigo_wmo, id LIMIT 100"""),
    ),
}
