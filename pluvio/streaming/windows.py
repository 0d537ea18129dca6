"""Half-hour means over a stream of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pluvio import schema as S
from pluvio.functions.numeric import mean
from pluvio.operators.filters import classified, measured

WATERMARK = "2 hours"


def observation_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(S.OBSERVATIONS).parquet(path)


def with_event_time(observations: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Event time with a zone, which watermarks need, in a UTC session."""
    return observations.withColumn("_event_time", F.col("timestamp_utc").cast("timestamp")).withWatermark(
        "_event_time", delay
    )


def deduplicated(observations: DataFrame) -> DataFrame:
    """Drop repeated deliveries of a station and time."""
    return observations.dropDuplicatesWithinWatermark(["codigo_wmo", "_event_time"])


def half_hour_stream(observations: DataFrame, measure: str, width: str = "30 minutes") -> DataFrame:
    """Window and class: mean and number of values, once the window has closed."""
    timed = deduplicated(with_event_time(measured(classified(observations), measure)))
    return (
        timed.groupBy(F.window("_event_time", width).alias("_window"), "intensidade_chuva")
        .agg(mean(measure).alias("valor"), F.count("*").alias("registros"))
        .select(
            F.col("_window.start").cast("timestamp_ntz").alias("time"), "intensidade_chuva", "valor", "registros"
        )
    )


def start_half_hour_means(
    spark: SparkSession, source: str, measure: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Append closed windows to ``target`` until all present files are read."""
    return (
        half_hour_stream(observation_stream(spark, source), measure)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
