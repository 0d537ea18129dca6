"""One station, key or device with most of the rows: results and plans."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.operators import buckets, impute, quantiles
from pluvio.plans import dashboard, views
from pluvio.sinks import upsert
from pluvio.workload.common import obs


def crowded(spark, rows=20_000):
    """A third of all rows at one station, the rest over fifty."""
    i = F.col("id")
    station = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (i % 50).cast("string")))
    return spark.range(rows).select(
        "id",
        station.alias("codigo_wmo"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(i % 60_000).cast("int"))).alias("timestamp_utc"),
        ((i * 37) % 1500 / 100).cast("decimal(8,2)").alias("precipitacao_mm"),
        F.when(i % 4 > 0, ((i * 13) % 4000 / 100)).cast("decimal(5,2)").alias("temperatura_ar_c"),
        F.element_at(F.array(*[F.lit(c) for c in S.CLASSES]), (i % 4 + 1).cast("int")).alias("intensidade_chuva"),
    )


def shuffles(df):
    """Keys of every exchange in the plan as Spark chose it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)], text


def test_rows_are_never_shuffled_by_station_alone(spark):
    df = crowded(spark)
    keys, text = shuffles(buckets.running_total(df, "codigo_wmo", "timestamp_utc", "precipitacao_mm", "total"))
    for key, part in zip(keys, re.split(r"Exchange hashpartitioning", text)[1:]):
        if key == "codigo_wmo":
            assert "HashAggregate" in part.split("Exchange")[0], "only daily sums may meet per station"


def test_running_total_of_a_crowded_station(spark):
    df = crowded(spark)
    got = buckets.running_total(df, "codigo_wmo", "timestamp_utc", "precipitacao_mm", "total")
    want = df.selectExpr("id", "sum(precipitacao_mm) over (partition by codigo_wmo order by timestamp_utc) want")
    assert got.join(want, "id").where("total <> want").count() == 0 and got.count() == 20_000


def test_station_views_combine_before_the_shuffle(spark):
    df = crowded(spark)
    stations = df.select("codigo_wmo").distinct().select("codigo_wmo", F.col("codigo_wmo").alias("nome"), F.lit("PE").alias("uf"),
                                                         F.lit(0).alias("latitude"), F.lit(0).alias("longitude"))
    for plan in (views.station_statistics(df.withColumns({m: F.lit(None).cast("decimal(8,2)") for m in S.MEASURES if m not in df.columns}), stations),
                 dashboard.class_by_station_code(df, stations), dashboard.state_distribution(df, stations)):
        _, text = shuffles(plan)
        assert "partial_" in text
    total = sum(r.total_registros for r in dashboard.state_distribution(df, stations).collect())
    assert total == 20_000


def test_median_of_a_crowded_station(spark):
    df = crowded(spark)
    got = {r.codigo_wmo: r.temperatura_ar_c for r in quantiles.medians(df, ["temperatura_ar_c"], ["codigo_wmo"]).collect()}
    want = {r.codigo_wmo: r.m for r in df.groupBy("codigo_wmo").agg(F.median("temperatura_ar_c").alias("m")).collect()}
    assert all(abs(got[k] - float(want[k])) < 1e-9 for k in want)
    filled = impute.fill_with_medians(df, ["temperatura_ar_c"])
    assert filled.count() == 20_000 and filled.where("temperatura_ar_c is null").count() == 0


def test_copies_of_one_key(spark, tmp_path):
    copies = spark.range(30_000).selectExpr(
        "id", "if(id % 3 = 0, 'hot', concat('s', id)) codigo_wmo", "date'2024-01-01' data", "'00:00:00' hora_utc",
        "cast(id % 100 as decimal(8,2)) precipitacao_mm",
    )
    path = str(tmp_path / "obs")
    upsert.upsert_observations(spark, path, copies, "2024-02-01", ["id"])
    table = upsert.read_observations(spark, path)
    assert table.count() == 20_001
    assert float(table.where("codigo_wmo = 'hot'").first().precipitacao_mm) == 29_997 % 100


def test_repeated_deliveries_are_cut_before_the_shuffle(spark):
    rows = spark.range(20_000).selectExpr("concat('d', id % 2) device_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 3 as int)) t", "id")
    found = buckets.newest_per_group(rows, ["device_id"], "t", 5, F.to_date("t"), ["id"])
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 1
    assert sorted(r.id for r in found.where("device_id = 'd0'").collect()) == [2, 8, 14, 20, 26]


def test_distinct_counts_are_combined_first(spark):
    _, text = shuffles(views.monthly_by_class(obs(spark, "/root/testdata/sf0.001", "orders")))
    assert text.count("partial_") >= 2 and "Expand" not in text
