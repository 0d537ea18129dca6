from __future__ import annotations

import json
from decimal import Decimal

import pytest

from pluvio.operators import profile
from pluvio.sources import telemetry

T0 = 1704067200000


@pytest.fixture
def landed(spark, tmp_path):
    def write(documents, devices):
        for name, rows in (("docs", documents), ("devices", devices)):
            (tmp_path / name).mkdir()
            (tmp_path / name / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
        docs = telemetry.read_documents(spark, str(tmp_path / "docs"))
        return telemetry.points(docs), telemetry.read_devices(spark, str(tmp_path / "devices"))

    return write


def device(i, name, attributes):
    return {"device_id": i, "name": name, "type": "t", "label": "", "attributes": json.dumps(attributes) if attributes is not None else None}


def document(i, telemetry, seq=0):
    return {"device_id": i, "seq": seq, "telemetry": telemetry}


def test_wide_rows_attributes_and_codes(spark, landed):
    points, devices = landed(
        [
            document("d1", {"precipitacao_mm": [{"ts": T0, "value": "0.8"}, {"ts": T0, "value": 0.9}], "umidade_rel_pct": [{"ts": T0, "value": "70.5"}, {"value": "1"}]}),
            document("d1", {"pressao_mb": [{"ts": T0, "value": "bad"}]}, seq=1),
            document("d2", {"radiacao_kjm2": [{"ts": T0 + 3600000, "value": "12"}]}),
            document("d3", {"precipitacao_mm": [{"ts": T0, "value": "1"}]}),
        ],
        [
            device("d1", "Estacao_A301_RECIFE", [{"key": "codigo_wmo", "value": "A0"}, {"key": "codigo_wmo", "value": "A301"}, {"key": "nome", "value": "Recife"}, {"nothing": 1}]),
            device("d2", "Estacao_A302_X", None),
            device("d3", "sem nome", {"codigo_wmo": "A303"}),
            device("d4", "Estacao_A304_Y", {"codigo_wmo": "", "latitude": -8.1}),
        ],
    )
    records = telemetry.wide_records(points)
    rows = {r.codigo_wmo: r for r in telemetry.observations(records, devices).collect()}
    assert set(rows) == {"A301", "A302"}
    first = rows["A301"]
    assert (first.precipitacao_mm, first.umidade_rel_horaria_pct, first.pressao_estacao_mb) == (Decimal("0.90"), Decimal("70.50"), None)
    assert (str(first.data), first.hora_utc, str(rows["A302"].timestamp_utc)) == ("2024-01-01", "00:00:00", "2024-01-01 01:00:00")
    stations = {r.codigo_wmo: r for r in telemetry.stations(records, devices).collect()}
    assert (stations["A301"].nome, stations["A301"].regiao, stations["A301"].uf) == ("Recife", "NORDESTE", "PE")
    assert stations["A302"].nome == "Estacao_A302_X"
    codes = {r.device_id: r.c for r in devices.select("device_id", telemetry.station_code(devices.name, devices.attributes).alias("c")).collect()}
    assert codes == {"d1": "A301", "d2": "A302", "d3": None, "d4": "A304"}


def test_coverage_keeps_silent_devices(spark, landed):
    points, devices = landed(
        [document("d1", {"precipitacao_mm": [{"ts": T0 + i, "value": "1"} for i in range(5)]})],
        [device("d1", "a_1", {"x": 1}), device("d2", "b_2", None), device("d3", "c_3", {})],
    )
    row = profile.telemetry_summary(points, devices).first()
    assert (row.dispositivos, row.total_pontos, row.com_telemetria, row.sem_telemetria, str(row.media_pontos)) == (3, 5, 1, 2, "1.67")
    per_device = {r.device_id: (r.total_pontos, r.atributos, r.tem_atributos) for r in profile.device_telemetry(points, devices).collect()}
    assert per_device == {"d1": (5, 1, True), "d2": (0, 0, False), "d3": (0, 0, False)}


def test_bounded_points(spark, landed):
    points, _ = landed([document("d1", {"precipitacao_mm": [{"ts": T0 + i * 600000, "value": str(i)} for i in range(100)]})], [])
    got = telemetry.bounded_points(points, T0 + 50 * 600000, limit=20).collect()
    assert sorted(int(r.value) for r in got) == list(range(31, 51))
    assert telemetry.bounded_points(points, T0 + 50 * 600000, T0 + 45 * 600000).count() == 6


def test_device_names(spark, landed):
    _, devices = landed([], [device("d1", "Estacao A1 X Y", None), device("d2", "Estacao_A2", None)])
    got = telemetry.fixed_device_names(devices).collect()
    assert [(r.old_name, r.new_name, r.new_label) for r in got] == [("Estacao A1 X Y", "Estacao_A1_X_Y", "Estacao_A1_X_Y")]
