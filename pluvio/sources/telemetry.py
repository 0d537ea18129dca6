"""Telemetry of devices: documents of points, device attributes, wide rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pluvio import schema as S
from pluvio.functions.timeparts import clock_text, from_epoch_ms
from pluvio.operators.buckets import newest_per_group

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.TELEMETRY_DOCUMENTS).json(path)


def read_devices(spark: SparkSession, path: str) -> DataFrame:
    """Devices with their attributes as one map, whatever form they came in."""
    raw = spark.read.schema(S.DEVICES).json(path)
    return raw.withColumn("attributes", attribute_map(F.col("attributes")))


def attribute_map(text: Column) -> Column:
    """Attributes from JSON: an object, or a list of key/value pairs.

    In a list the last pair of a key counts. Anything else gives an empty map.
    """
    pairs = F.from_json(text, "array<struct<key:string,value:string>>")
    named = F.filter(F.coalesce(pairs, F.array()), lambda p: p["key"].isNotNull())
    final = F.filter(
        named,
        lambda p, i: ~F.exists(
            F.slice(named, i + 2, F.greatest(F.size(named) - i - 1, F.lit(0))), lambda q: q["key"] == p["key"]
        ),
    )
    as_object = F.from_json(text, "map<string,string>")
    chosen = F.when(F.ltrim(text).startswith("["), F.map_from_entries(final)).otherwise(as_object)
    return F.coalesce(chosen, F.create_map().cast("map<string,string>"))


def points(documents: DataFrame) -> DataFrame:
    """One row per point: device, key, time in ms, value, and delivery order."""
    keyed = documents.select("device_id", "seq", F.explode("telemetry").alias("key", "_items"))
    items = keyed.select("device_id", "seq", "key", F.posexplode("_items").alias("pos", "_item"))
    return items.where(F.col("_item.ts").isNotNull()).select(
        "device_id", "key", F.col("_item.ts").alias("ts"), F.col("_item.value").alias("value"), "seq", "pos"
    )


def points_with_attributes(all_points: DataFrame, devices: DataFrame) -> DataFrame:
    """Long rows with the device's name and attributes."""
    return all_points.join(devices.select("device_id", "name", "attributes"), "device_id")


def bounded_points(
    all_points: DataFrame,
    end_ms: int,
    start_ms: int | None = None,
    limit: int = S.TELEMETRY_POINT_LIMIT,
) -> DataFrame:
    """The newest points per device and key inside a time range.

    The range ends at ``end_ms`` and starts 730 days earlier unless given. The
    limit is located by hour, so no device's history is sorted in one task.
    """
    start_ms = end_ms - S.TELEMETRY_DAYS * DAY_MS if start_ms is None else start_ms
    inside = all_points.where(F.col("ts").between(start_ms, end_ms))
    hour = F.floor(F.col("ts") / HOUR_MS)
    return newest_per_group(inside, ["device_id", "key"], "ts", limit, hour, ["seq", "pos"])


def wide_records(all_points: DataFrame) -> DataFrame:
    """One row per device and time with a column per key; the last delivery wins.

    Aggregates with a condition instead of a pivot, so the same expression
    also serves a stream.
    """
    order = F.struct("seq", "pos")
    columns = []
    for key in S.TELEMETRY_KEYS:
        hit = F.col("key") == key
        columns.append(F.max_by(F.when(hit, F.col("value")), F.when(hit, order)).alias(key))
    return all_points.groupBy("device_id", "ts").agg(*columns)


def delivered_records(all_points: DataFrame) -> DataFrame:
    """As ``wide_records``, but each key is (seq, pos, value) of its last delivery.

    The maximum of these is associative: records of parts of the points, merged
    by maximum, are the record of all of them.
    """
    order = F.struct("seq", "pos", "value")
    return all_points.groupBy("device_id", "ts").agg(
        *[F.max(F.when(F.col("key") == key, order)).alias(key) for key in S.TELEMETRY_KEYS]
    )


def station_code(name: Column, attributes: Column) -> Column:
    """The code attribute, else the second part of the name.

    A name without an underscore has no code, even with an attribute.
    """
    attribute = F.nullif(F.get(F.map_values(F.map_filter(attributes, lambda k, _: k == "codigo_wmo")), F.lit(0)), F.lit(""))
    second = F.nullif(F.get(F.split(name, "_"), F.lit(1)), F.lit(""))
    return F.when(name.contains("_"), F.coalesce(attribute, second))


def with_devices(records: DataFrame, devices: DataFrame) -> DataFrame:
    """Wide records with the station code; records without one are left out."""
    known = devices.select(
        "device_id", "name", "attributes", station_code(F.col("name"), F.col("attributes")).alias("codigo_wmo")
    ).where(F.col("codigo_wmo").isNotNull())
    return records.join(known, "device_id")


def observations(records: DataFrame, devices: DataFrame) -> DataFrame:
    """Telemetry records as observations: renamed, typed and timed.

    Measures the telemetry does not carry are NULL. A value that is not a
    number, or does not fit its column, is NULL too.
    """
    timed = with_devices(records, devices).withColumn("timestamp_utc", from_epoch_ms(F.col("ts")))
    sent = {measure: key for key, measure in S.TELEMETRY_KEYS.items()}
    measures = [
        (F.col(sent[m]).try_cast(kind) if m in sent else F.lit(None).cast(kind)).alias(m)
        for m, kind in S.MEASURES.items()
    ]
    return timed.select(
        "codigo_wmo",
        F.to_date("timestamp_utc").alias("data"),
        clock_text(F.col("timestamp_utc")).alias("hora_utc"),
        "timestamp_utc",
        *measures,
        F.lit(None).cast("string").alias("intensidade_chuva"),
    )


def deliveries(records: DataFrame, devices: DataFrame) -> DataFrame:
    """Delivered records as parts of observations: every measure is (seq, pos, valor) or NULL."""
    timed = with_devices(records, devices).withColumn("timestamp_utc", from_epoch_ms(F.col("ts")))
    measures = [
        F.when(
            F.col(key).isNotNull(),
            F.struct(F.col(key)["seq"].alias("seq"), F.col(key)["pos"].alias("pos"), F.col(key)["value"].try_cast(S.MEASURES[m]).alias("valor")),
        ).alias(m)
        for key, m in S.TELEMETRY_KEYS.items()
    ]
    day, clock = F.to_date("timestamp_utc"), clock_text(F.col("timestamp_utc"))
    return timed.select("codigo_wmo", day.alias("data"), clock.alias("hora_utc"), "timestamp_utc", *measures)


def records_without_station(records: DataFrame, devices: DataFrame) -> DataFrame:
    """Device and time of records whose device is not listed or has no station code, with the reason."""
    listed = devices.select(
        "device_id", F.lit(True).alias("_listed"), station_code(F.col("name"), F.col("attributes")).alias("_code")
    )
    left = records.select("device_id", "ts").join(listed, "device_id", "left").where(F.col("_code").isNull())
    reason = F.when(F.col("_listed"), "no station code").otherwise("unknown device")
    return left.select("device_id", "ts", reason.alias("motivo"))


def stations(records: DataFrame, devices: DataFrame) -> DataFrame:
    """Stations behind the records, with the telemetry path's defaults.

    A code that several devices share is described by the first of them.
    """
    attribute = F.col("attributes")
    active = records.select("device_id").distinct()
    coded = with_devices(active, devices)
    first = Window.partitionBy("codigo_wmo").orderBy("device_id")

    def value(key: str, default: Column) -> Column:
        return F.when(F.map_contains_key(attribute, key), attribute[key]).otherwise(default)

    nothing = F.lit(None).cast("string")
    return (
        coded.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .select(
            "codigo_wmo",
            value("regiao", F.lit(S.DEFAULT_REGION)).alias("regiao"),
            value("estado", F.lit(S.DEFAULT_STATE)).alias("uf"),
            value("nome", F.col("name")).alias("nome"),
            value("latitude", nothing).try_cast("decimal(10,8)").alias("latitude"),
            value("longitude", nothing).try_cast("decimal(11,8)").alias("longitude"),
            value("altitude", nothing).try_cast("decimal(8,2)").alias("altitude"),
            F.lit(None).cast("date").alias("data_fundacao"),
        )
    )


def fixed_device_names(devices: DataFrame) -> DataFrame:
    """Change log of the names with spaces: old and new name, new label."""
    label = F.coalesce(F.nullif("label", F.lit("")), F.col("name"))
    return devices.where(F.col("name").contains(" ")).select(
        "device_id",
        F.col("name").alias("old_name"),
        F.translate("name", " ", "_").alias("new_name"),
        F.translate(label, " ", "_").alias("new_label"),
    )


def device_name(code: Column, station: Column) -> Column:
    """The name a station's device gets: no spaces, no hyphens, upper case."""
    return F.concat(F.lit("Estacao_"), code, F.lit("_"), F.upper(F.translate(station, " -", "__")))
