"""Queries that state no time range take every row, however early or late it is."""

from __future__ import annotations

import os

import duckdb
import pytest

from pluvio.workload import registry

SMALL = "/root/testdata/sf0.001"
TIMES = {"events": ("ts", "event_id"), "orders": ("o_orderdate", "o_orderkey")}
WHOLE = [
    "prj10_filter_lists",
    "q01_class_distribution",
    "q02_rain_points",
    "q03a_class_by_station_code",
    "q03b_class_by_short_name",
    "q03c_class_by_busiest_station",
    "q04_station_heat_map",
    "q05_daily_mean",
    "q06_daily_counts",
    "q07_top_heavy_rain",
    "q08_weather_by_time",
    "q09_class_pie",
    "q10_station_table",
    "q11_monthly_total",
    "q12_daily_trend",
    "q13_rain_against_humidity",
    "q14_class_comparison",
    "q15_accumulated_rain",
    "q16_hour_frequency",
    "q17_daily_extremes",
    "q18_state_distribution",
    "q19_wind_against_rain",
    "q20_daily_summary",
]


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """The small tables, with every observation long before or long after its time, or at none."""
    folder = str(tmp_path_factory.mktemp("far"))
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in os.listdir(SMALL):
        name = file.removesuffix(".parquet")
        columns = "*"
        if name in TIMES:
            ts, key = TIMES[name]
            moved = f"CASE {key} % 3 WHEN 0 THEN {ts} - INTERVAL 60 YEAR WHEN 1 THEN {ts} + INTERVAL 150 YEAR END"
            columns = f"* REPLACE ({moved} AS {ts})"
        elif name == "customer":  # every station in a state that some list asks for
            columns = "* REPLACE (CAST([1, 2, 7, 20][c_custkey % 4 + 1] AS INTEGER) AS c_nationkey)"
        connection.execute(f"COPY (SELECT {columns} FROM '{SMALL}/{file}') TO '{folder}/{file}' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return folder, connection


@pytest.mark.parametrize("name", WHOLE)
def test_rows_of_every_time_count(spark, far, name):
    folder, connection = far
    got = registry.queries()[name](spark, folder)
    columns = sorted(got.columns)
    chosen = ", ".join(f'"{c}"' for c in columns)
    expected = connection.execute(f"SELECT {chosen} FROM ({registry.oracle_sql()[name]}) AS whole").fetchall()
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    ordered = lambda some: sorted(some, key=lambda row: [(v is None, str(v)) for v in row])
    assert expected and ordered(rows) == ordered(expected)
