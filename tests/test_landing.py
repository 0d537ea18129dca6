"""The given tables written out as station files."""

from __future__ import annotations

import os

import pytest

from pluvio.workload import landing


@pytest.fixture
def files(spark, tmp_path):
    rows = [("b", 100, 2, "2"), ("a", 1, 0, "Estação 12°"), ("b", 100, 1, "1 €"), ("a", 0, 0, None), ("a", 100, 7, "  "), ("b", 0, 0, 'x "y"')]
    target = str(tmp_path / "files")
    landing._write_files(spark.createDataFrame(rows, "arquivo string, ordem int, id bigint, linha string"), target)
    return target


def test_each_file_stands_by_itself(files):
    """No folder for each file, and nothing unfinished is left."""
    assert sorted(os.listdir(files)) == ["a.csv", "b.csv"]
    assert all(os.path.isfile(f"{files}/{name}") for name in os.listdir(files))


def test_lines_are_in_order_and_latin_1(files):
    with open(f"{files}/a.csv", "rb") as a, open(f"{files}/b.csv", "rb") as b:
        assert a.read() == "Estação 12°\n  \n".encode("latin-1")
        assert b.read() == b'x "y"\n1 ?\n2\n'


def test_a_file_longer_than_one_batch_is_one_file(spark, tmp_path):
    target = str(tmp_path / "long")
    lines = spark.range(25_000).selectExpr("'long' AS arquivo", "100 AS ordem", "id", "CAST(id AS STRING) AS linha")
    landing._write_files(lines, target)
    with open(f"{target}/long.csv") as file:
        assert file.read().split() == [str(i) for i in range(25_000)]


def test_numbers_have_decimal_commas_and_no_leading_zero(spark):
    line = spark.createDataFrame([("2024/01/05;0100 UTC;0.80;;-0.50;10.05;0.00;0.07;",)], "linha string")
    assert line.select(landing._decimal_commas(line.linha)).first()[0] == "2024/01/05;0100 UTC;,80;;-0,50;10,05;,00;,07;"
