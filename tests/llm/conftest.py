"""Documents, pages and vectors with every awkward row the operators must take."""

from __future__ import annotations

import random

import pytest

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(1500))
CLASH = "id bigint, ids string, text_ string, `set` string, name string, n int, score double, spans string, contamination string, quality int, first int, nats double, doomed boolean"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(["th", "er", "on", "an", "re", "he", "in", "ed"], k=draw.randint(1, 4))) for _ in range(n))


def awkward_texts() -> list[tuple]:
    a, b = prose(1, 120), prose(2, 120)
    near = a.split()
    near[60] = "changed"
    shared = prose(9, 70)
    return [
        (0, a), (1, a), (2, " ".join(near)), (3, b), (3, b), (4, ""), (5, None), (6, " \n\t "), (7, "!!! ... ???"),
        (8, LONG), (9, "a" * 5000), (10, "é" * 700), (11, "Ünïcödé 🙂 日本語 'll I'll  x"), (12, f"{prose(3, 60)} {shared} {prose(4, 60)}"),
        (13, f"{prose(5, 60)} {shared} {prose(6, 60)}"), (None, b), (None, None), (14, "one"), (15, "one"), (16, "ab " * 400),
        (17, a.upper()), (18, prose(7, 300)), (-5, prose(8, 50)), (10**15, prose(7, 300) + " tail"),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    langs = ["en", None, "de", "fr"]
    rows = [(i, t, langs[k % 4], None if k % 5 == 0 else "s", None if t is None else len(t), 1, "x", "y", "z", "w", 2, 0.5, "q", "c", 3, 4, 0.1, True) for k, (i, t) in enumerate(awkward_texts())]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def as_tables(tmp_path):
    """Writes frames as the tables of a folder and opens them in DuckDB."""

    def write(**frames):
        import duckdb

        connection = duckdb.connect()
        for name, frame in frames.items():
            frame.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
            connection.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
        return str(tmp_path), connection

    return write


def same_rows(frame, relation) -> bool:
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    got = sorted(str(tuple(r[c] for c in columns)) for r in frame.collect())
    return got == sorted(str(tuple(r[i] for i in places)) for r in relation.fetchall())
