"""Raw landing files and the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.operators.filters import Moment, moment


def land_records(records: DataFrame, devices: DataFrame, path: str, run: str) -> str:
    """Write one ingest run's wide records with device attributes as JSON lines.

    Attributes stand beside the values; a field that is missing is left out.
    Each run has its own folder, so a repeated run never mixes with another.
    """
    target = f"{path.rstrip('/')}/raw/telemetry_{run}"
    named = devices.select(
        "device_id", F.col("name").alias("device_name"), *[F.col("attributes")[k].alias(k) for k in S.ATTRIBUTE_KEYS]
    )
    wide = records.join(named, "device_id")
    wide.withColumnRenamed("ts", "timestamp").write.mode("overwrite").json(target)
    return target


def prediction_rows(scored: DataFrame, now: Moment) -> DataFrame:
    """Scored rows in the layout of the prediction log.

    ``timestamp_utc`` is the time of the observation and ``created_at`` the
    time of scoring. The id covers the observation's id where the rows have one,
    so two rows of one station and time stay apart.
    """
    present = set(scored.columns)
    columns = []
    for field in S.PREDICTIONS:
        if field.name == "id":
            own = [F.col("id")] if "id" in present else []
            column = F.xxhash64("codigo_wmo", "timestamp_utc", "modelo_usado", moment(now), *own)
        elif field.name == "created_at":
            column = moment(now)
        elif field.name in present:
            column = F.col(field.name).cast(field.dataType)
        else:
            column = F.lit(None).cast(field.dataType)
        columns.append(column.alias(field.name))
    return scored.select(*columns)


def append_predictions(scored: DataFrame, path: str, now: Moment) -> None:
    prediction_rows(scored.where(F.col("intensidade_predita").isNotNull()), now).write.mode("append").parquet(path)
