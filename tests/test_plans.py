from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pluvio.plans import charts, dashboard, panels, views
from pluvio.sinks.landing import prediction_rows
from pluvio.workload.common import est, obs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return obs(spark, SMALL), est(spark, SMALL)


def test_class_counts_add_up(spark, tables):
    rows, _ = tables
    bars = views.class_bars(rows).collect()
    assert sum(r.total_registros for r in bars) == rows.where("intensidade_chuva is not null").count()
    assert abs(sum(float(r.percentual) for r in bars) - 100) < 0.05
    assert sum(r.total_registros for r in views.class_distribution(rows).collect()) == rows.count()


def test_stations_without_rows_show_zeros(spark, tables):
    rows, stations = tables
    got = views.station_statistics(rows, stations)
    assert got.count() == stations.count()
    empty = got.where("total_registros = 0").first()
    assert (empty.precip_media, float(empty.precip_total), empty.registros_chuva_forte) == (0.0, 0.0, 0)
    assert empty.data_inicio is None
    assert got.agg(F.sum("total_registros")).first()[0] == rows.where("intensidade_chuva is not null").count()


def test_absent_classes_have_zero(spark, observations):
    df = observations([dict(id=1, codigo_wmo="A", timestamp_utc="2024-01-01", intensidade_chuva="leve")])
    assert {r.intensidade_chuva: (r.registros, r.percentual) for r in charts.class_counts(df).collect()} == {
        "sem_chuva": (0, 0.0), "leve": (1, 100.0), "moderada": (0, 0.0), "forte": (0, 0.0)}
    empty = charts.class_counts(df.limit(0)).collect()
    assert [r.percentual for r in empty] == [0.0] * 4


def test_empty_input(spark, tables):
    rows, stations = tables
    none = rows.limit(0)
    assert views.general_summary(none).first().total_registros == 0
    assert views.general_statistics(none).first().registros_com_chuva is None
    assert views.class_bars(none).count() == 0
    assert dashboard.top_heavy_rain(none, stations).count() == 0


def test_rule_against_model(spark, observations):
    stations = spark.createDataFrame([("A", "X")], "codigo_wmo string, nome string")
    df = observations([
        dict(id=1, codigo_wmo="A", timestamp_utc="2024-01-01 10:15:00", intensidade_chuva="leve"),
        dict(id=2, codigo_wmo="A", timestamp_utc="2024-01-01 11:00:00", intensidade_chuva="leve"),
        dict(id=3, codigo_wmo="Z", timestamp_utc="2024-01-01 10:00:00", intensidade_chuva="leve"),
        dict(id=4, codigo_wmo="A", timestamp_utc="2024-01-01 10:00:00"),
    ])
    scored = spark.sql("""select 'A' codigo_wmo, timestamp_ntz'2024-01-01 10:00:00' timestamp_utc, 'leve' intensidade_predita, 'm' modelo_usado
        union all select 'A', timestamp_ntz'2024-01-01 10:59:59', 'forte', 'm'""")
    got = views.rule_against_model(df, stations, prediction_rows(scored, "2024-01-02")).collect()
    assert sorted((str(r.time)[11:16], r.classificacao_ml, r.status_comparacao) for r in got if r.classificacao_ml) == [
        ("10:15", "forte", "diferenca"), ("10:15", "leve", "match")]
    assert [(r.status_comparacao, r.classificacao_ml) for r in got if str(r.time)[11:13] == "11"] == [("diferenca", None)]


def test_equal_name_prefixes_merge(spark, observations):
    stations = spark.createDataFrame([("A", "UMA ESTACAO LONGA 1"), ("B", "UMA ESTACAO LONGA 2")], "codigo_wmo string, nome string")
    df = observations([
        dict(id=i, codigo_wmo=c, timestamp_utc="2024-01-01", precipitacao_mm=p, intensidade_chuva="leve")
        for i, (c, p) in enumerate([("A", 1), ("A", 2), ("B", 0.5), ("B", None)])
    ])
    got = dashboard.class_by_short_name(df, stations).collect()
    assert [(r.estacao, r.total_registros) for r in got] == [("UMA ESTACAO LON", 4)]
    assert abs(got[0].precip_media - 3.5 / 3) < 1e-12


def test_half_hours_leave_out_zero(spark, observations):
    df = observations([
        dict(id=i, codigo_wmo="A", timestamp_utc=t, vento_velocidade_ms=w, intensidade_chuva="leve")
        for i, (t, w) in enumerate([("2024-01-01 00:10:00", 2), ("2024-01-01 00:29:59", 4), ("2024-01-01 00:20:00", 0),
                                    ("2024-01-01 00:30:00", 6), ("2024-01-01 00:40:00", None)])
    ])
    got = {str(r.time)[11:16]: r.valor for r in panels.half_hour_mean(df, "vento_velocidade_ms").collect()}
    assert got == {"00:00": 3.0, "00:30": 6.0}


def test_aggregates_meet_stations_after_the_shuffle(spark, tables):
    """Only aggregated rows are joined, so no fact row is shuffled for a join."""
    rows, stations = tables
    for plan in (views.class_by_station_name(rows, stations), dashboard.station_table(rows, stations)):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        join, scan = text.index("Join"), text.index("Aggregate", text.index("Join"))
        assert join < scan


def test_scan_reads_only_needed_columns(spark, tables):
    rows, _ = tables
    text = panels.rainy_class_mean(rows, "pressao_estacao_mb")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
