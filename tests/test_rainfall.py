from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.functions.numeric import half_up_ratio, rounded_mean
from pluvio.functions.rainfall import fill_class, rainfall_class, severity
from pluvio.functions.timeparts import weekday
from pluvio.functions.timeparts import epoch_ms, from_epoch_ms

GOLDEN = [
    (None, "sem_chuva"), ("0", "sem_chuva"), ("0.05", "sem_chuva"), ("0.10", "leve"), ("2.50", "leve"),
    ("2.55", "sem_chuva"), ("2.60", "moderada"), ("10.00", "moderada"), ("10.01", "forte"), ("-1", "sem_chuva"),
]


def test_rule(spark):
    df = spark.createDataFrame(GOLDEN, "p string, expected string")
    for kind in ("decimal(8,2)", "double", "string"):
        got = df.select(rainfall_class(F.col("p").cast(kind)).alias("c"), "expected").collect()
        assert all(r.c == r.expected for r in got), kind


def test_rule_on_nan_and_large(spark):
    df = spark.sql("select double('NaN') as a, double(1e9) as b")
    row = df.select(rainfall_class(F.col("a")).alias("a"), rainfall_class(F.col("b")).alias("b")).first()
    assert (row.a, row.b) == ("sem_chuva", "forte")


def test_fill_keeps_present_class(spark):
    df = spark.createDataFrame([("forte", 0.0), ("", 5.0), (None, 0.5)], "c string, p double")
    got = [r.x for r in df.select(fill_class(F.col("c"), F.col("p")).alias("x")).collect()]
    assert got == ["forte", "moderada", "leve"]


def test_severity_order(spark):
    df = spark.createDataFrame([("sem_chuva",), ("leve",), ("moderada",), ("forte",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(severity(F.col("c"))).collect()] == [1, 2, 3, 4, 5, 5]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.sql("select * from values (201L, 200L), (-201L, 200L), (1L, 0L) t(n, d)")
    got = [r[0] for r in df.select(half_up_ratio(F.col("n"), F.col("d"))).collect()]
    assert [None if g is None else str(g) for g in got] == ["0.01", "-0.01", None]
    exact = spark.sql("select cast(x as decimal(8,2)) x from values (0.01), (0.00) t(x)").agg(rounded_mean(F.col("x")))
    assert str(exact.first()[0]) == "0.01"


def test_sunday_is_zero_and_epoch_round_trip(spark):
    df = spark.sql("select timestamp_ntz'2024-01-07 23:59:59.123' t union all select timestamp_ntz'1969-12-31 23:59:59.5'")
    rows = df.select(weekday(F.col("t")).alias("w"), epoch_ms(F.col("t")).alias("m"), "t").collect()
    assert rows[0].w == 0
    assert [r.m for r in rows] == [1704671999123, -500]
    assert all(r.t == r.b for r in df.select("t", from_epoch_ms(epoch_ms(F.col("t"))).alias("b")).collect())
