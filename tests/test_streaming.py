from __future__ import annotations

import os

from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.session import fresh_path
from pluvio.sinks import upsert
from pluvio.sources import telemetry
from pluvio.streaming import ingest, windows
from pluvio.workload import landing
from pluvio.workload.common import obs

SMALL = "/root/testdata/sf0.001"
NOW = "2024-02-01 00:00:00"


def test_stream_in_many_batches_equals_one_batch(spark):
    """Documents that cut an hour apart still give the whole rows."""
    path = fresh_path(spark, "docs")
    documents = telemetry.read_documents(spark, landing.telemetry_documents(spark, SMALL))
    for half in (0, 1):
        split = F.map_filter("telemetry", lambda k, _: (F.length(k) % 2) == half)
        documents.withColumn("telemetry", split).coalesce(2).write.mode("append").json(path)
    devices = telemetry.read_devices(spark, landing.device_list(spark, SMALL))
    table, checkpoint = fresh_path(spark, "table"), fresh_path(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        query = ingest.start_ingest(spark, path, devices, table, checkpoint, lambda: NOW, files_per_batch=1)
        query.awaitTermination()
    streamed = upsert.read_observations(spark, table).drop(S.MONTH_PARTITION)
    points = telemetry.points(telemetry.read_documents(spark, path))
    batch = telemetry.observations(telemetry.wide_records(points), devices)
    expected = upsert.merge_observations(None, batch, NOW, ["timestamp_utc"]).drop(S.MONTH_PARTITION)
    assert streamed.count() == expected.count() > 500
    assert streamed.exceptAll(expected).count() == 0


def test_late_rows_still_reach_the_table(spark, tmp_path):
    devices = spark.createDataFrame([("d", "Estacao_A_X", {})], "device_id string, name string, attributes map<string,string>")
    table, checkpoint, path = fresh_path(spark, "table"), fresh_path(spark, "checkpoint"), tmp_path / "docs"
    path.mkdir()
    for i, ts in enumerate([1706659200000, 1704067200000]):
        (path / f"{i}.json").write_text('{"device_id":"d","seq":%d,"telemetry":{"precipitacao_mm":[{"ts":%d,"value":"3"}]}}' % (i, ts))
        ingest.start_ingest(spark, str(path), devices, table, checkpoint, lambda: NOW).awaitTermination()
    got = upsert.read_observations(spark, table).orderBy("timestamp_utc").collect()
    assert [(str(r.data), r.intensidade_chuva) for r in got] == [("2024-01-01", "moderada"), ("2024-01-31", "moderada")]


def document(device: str, seq: int, ts: int, **values) -> tuple:
    return device, seq, {k: [(ts, v)] for k, v in values.items()}


def test_any_order_and_repeats_of_batches_give_one_table(spark):
    devices = spark.createDataFrame(
        [("d", "Estacao_A_X", {}), ("e", "Estacao_A_Y", {}), ("f", "nameless", {})], "device_id string, name string, attributes map<string,string>"
    )
    hour = 1706659200000
    batches = [
        [document("d", 1, hour, precipitacao_mm="1", temperatura_ar_c="20"), document("d", 2, hour, precipitacao_mm="3")],
        [document("d", 3, hour, precipitacao_mm=None), document("e", 1, hour, umidade_rel_pct="80", temperatura_ar_c="21")],
        [document("e", 4, hour, precipitacao_mm="12"), document("f", 9, hour, precipitacao_mm="99"), document("g", 9, hour, precipitacao_mm="99")],
    ]
    tables = set()
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 1, 0, 2)]):
        table, stations, rejects = (fresh_path(spark, k) for k in ("any-table", "any-stations", "any-rejects"))
        merge = ingest.upsert_batch(spark, devices, table, lambda: NOW, stations, rejects)
        for number, i in enumerate(order):
            merge(spark.createDataFrame(batches[i], S.TELEMETRY_DOCUMENTS), number)
        tables.add(str(sorted(upsert.read_observations(spark, table).drop("created_at").collect())))
        if n == 0:
            row = upsert.read_observations(spark, table).first()
            assert (float(row.precipitacao_mm), float(row.temperatura_ar_c), row.intensidade_chuva) == (12.0, 21.0, "forte")
            assert [r.codigo_wmo for r in upsert.read_stations(spark, stations).collect()] == ["A"]
            lost = spark.read.parquet(rejects).select("device_id", "motivo").collect()
            assert sorted(map(tuple, lost)) == [("f", "no station code"), ("g", "unknown device")]
    assert len(tables) == 1


def test_delivery_over_a_batch_load(spark, observations):
    devices = spark.createDataFrame([("d", "Estacao_A_X", {})], "device_id string, name string, attributes map<string,string>")
    table = fresh_path(spark, "both-table")
    row = dict(id=1, codigo_wmo="A", data="2024-01-31", hora_utc="00:00:00", timestamp_utc="2024-01-31 00:00:00", precipitacao_mm=20, temperatura_max_c=30, temperatura_ar_c=25)
    upsert.upsert_observations(spark, table, observations([row]).drop("created_at"), NOW, ["id"])
    merge = ingest.upsert_batch(spark, devices, table, lambda: NOW)
    for seq, rain in ((5, "4"), (3, "50")):  # the second is older and comes late
        merge(spark.createDataFrame([document("d", seq, 1706659200000, precipitacao_mm=rain)], S.TELEMETRY_DOCUMENTS), 0)
    got = upsert.read_observations(spark, table).first()
    assert (float(got.precipitacao_mm), got.intensidade_chuva, float(got.temperatura_max_c), float(got.temperatura_ar_c)) == (4.0, "moderada", 30.0, 25.0)


def test_a_stream_leaves_nothing_but_its_tables(spark, tmp_path):
    devices = spark.createDataFrame([("d", "Estacao_A_X", {})], "device_id string, name string, attributes map<string,string>")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    merge = ingest.upsert_batch(spark, devices, str(tmp_path / "table"), lambda: NOW, str(tmp_path / "stations"))
    for i in range(3):
        merge(spark.createDataFrame([document("d", i, 1706659200000, precipitacao_mm="1")], S.TELEMETRY_DOCUMENTS), i)
    merge(spark.createDataFrame([], S.TELEMETRY_DOCUMENTS), 4)
    assert set(os.listdir(shared)) == before


def test_closed_windows_equal_batch(spark):
    source, target = fresh_path(spark, "source"), fresh_path(spark, "target")
    rows = obs(spark, SMALL).withColumn("created_at", F.lit(None).cast("timestamp_ntz")).select(*S.OBSERVATIONS.names)
    rows.unionByName(rows).repartitionByRange(4, "timestamp_utc").write.parquet(source)
    windows.start_half_hour_means(spark, source, "vento_velocidade_ms", target, fresh_path(spark, "checkpoint")).awaitTermination()
    got = spark.read.parquet(target)
    from pluvio.plans.panels import half_hour_mean

    batch = half_hour_mean(rows, "vento_velocidade_ms")
    closed = batch.join(got.agg(F.max("time").alias("last")), F.col("time") <= F.col("last")).drop("last")
    assert got.drop("registros").exceptAll(closed.select("time", "intensidade_chuva", "valor")).count() == 0
    assert got.count() >= batch.count() - 12
