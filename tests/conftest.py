from __future__ import annotations

import pytest

from pluvio.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "pluvio-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def observations(spark):
    """Builds observation rows from (station, time text, rain text[, more columns])."""
    from pluvio import schema as S

    def build(rows: list[dict]):
        columns = {f.name: f.dataType.simpleString() for f in S.OBSERVATIONS}
        frame = spark.createDataFrame(
            [tuple(None if row.get(c) is None else str(row[c]) for c in columns) for row in rows],
            ", ".join(f"{c} string" for c in columns),
        )
        return frame.selectExpr(*[f"cast({c} as {kind}) as {c}" for c, kind in columns.items()])

    return build
