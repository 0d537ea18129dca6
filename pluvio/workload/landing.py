"""The given tables written out in the raw forms the sources read.

Station files and telemetry documents are derived by Spark from the whole
tables, written once per session under the shared folder, and read back by the
registered queries. No file and no document grows with the data: a station's
rows are cut into files by month and by blocks of ids, a device's points into
documents by blocks of ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio import schema as S
from pluvio.functions.timeparts import epoch_ms, hour_start
from pluvio.session import file_system, fresh_path
from pluvio.workload import mapping

ROWS_PER_FILE = 250_000
POINTS_PER_DOCUMENT = 64

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, folder: str, kind: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _written:
        path = fresh_path(spark, kind)
        write(path)
        _written[key] = path
    return _written[key]


def _accented() -> F.Column:
    """Even station codes use accented titles, odd ones the plain spelling."""
    return F.col("codigo_wmo").cast("bigint") % 2 == 0


def _decimal_commas(line: F.Column) -> F.Column:
    """A line of numbers behind its date and hour with decimal commas and no leading zero.

    Done once a line: seventeen times, it would be most of the work of writing the files.
    """
    return F.replace(F.replace(line, F.lit("."), F.lit(",")), F.lit(";0,"), F.lit(";,"))


#: Kinds of lines by id modulo eight in the folder with faults; all other ids have plain rows.
WIDE, SHORT, DATELESS, HOURLESS, LARGE, BLANK = range(6)
#: Cells that a short row keeps.
KEPT = 5


def faulty(cells: F.Column, day: F.Column, clock: F.Column) -> F.Column:
    """A row's line with the fault of its id; faults carry the id, so a reject can be told."""
    kind, own = F.col("id") % 8, F.col("id").cast("string")
    dew_point = list(S.MEASURES).index("temperatura_orvalho_c")
    place = F.when(_accented(), dew_point).otherwise(len(S.MEASURES) - 1 - dew_point)
    large = F.concat(F.lit("9999999"), own)
    changed = F.when(kind == LARGE, F.transform(cells, lambda c, i: F.when(i == place, large).otherwise(c))).when(kind == SHORT, F.slice(cells, 1, KEPT))
    first = F.when(kind == DATELESS, F.concat(F.lit("data "), own)).otherwise(day)
    second = F.when(kind == HOURLESS, F.concat(F.lit("hora "), own)).otherwise(clock)
    tail = F.when(kind == WIDE, F.concat(F.lit(";"), own)).when(kind != SHORT, F.lit(""))
    line = F.concat_ws(";", first, second, F.coalesce(changed, cells), tail)
    return F.when(kind == BLANK, F.lit("  ")).otherwise(line)


def station_lines(observations: DataFrame, stations: DataFrame, faults: bool = False) -> DataFrame:
    """All lines of all station files with their file key and order; with ``faults`` as ``faulty`` says."""
    rows = observations.withColumns(
        {"mes": F.date_format("timestamp_utc", "yyyy-MM"), "parte": F.floor(F.col("id") / ROWS_PER_FILE)}
    )
    keys = ["codigo_wmo", "mes", "parte"]
    measures = list(S.MEASURES)
    # Through a lambda, so that Spark compiles the cells in pieces; all in one they are more than Java's compiler takes.
    numbers = F.transform(F.array(*[F.col(m).cast("string") for m in measures]), lambda c: F.coalesce(c, F.lit("")))
    rows = rows.withColumn("_cells", numbers).withColumn("_cells", F.when(_accented(), F.col("_cells")).otherwise(F.reverse("_cells")))
    day = F.date_format("timestamp_utc", "yyyy/MM/dd")
    clock = F.concat(F.translate(F.substring("hora_utc", 1, 5), ":", ""), F.lit(" UTC"))
    data = rows.select(
        *keys,
        F.lit(100).alias("ordem"),
        "id",
        _decimal_commas(faulty(F.col("_cells"), day, clock) if faults else F.concat_ws(";", day, clock, F.col("_cells"), F.lit(""))).alias("linha"),
    )
    accented = ";".join(S.CSV_TITLES[m][0] for m in measures)
    plain = ";".join(S.CSV_TITLES[m][1] for m in reversed(measures))
    header = F.concat(F.lit("Data;Hora UTC;"), F.when(_accented(), accented).otherwise(plain), F.lit(";"))
    described = rows.select(*keys).distinct().join(stations, "codigo_wmo")
    values = {
        "REGIAO:": F.col("regiao"),
        "UF:": F.col("uf"),
        "ESTACAO:": F.col("nome"),
        "CODIGO (WMO):": F.col("codigo_wmo"),
        "LATITUDE:": F.translate(F.col("latitude").cast("string"), ".", ","),
        "LONGITUDE:": F.translate(F.col("longitude").cast("string"), ".", ","),
        "ALTITUDE:": F.translate(F.col("altitude").cast("string"), ".", ","),
        "DATA DE FUNDACAO:": F.lit("2003-02-01"),
    }
    top = F.array(*[F.concat(F.lit(k), F.lit(";"), v) for k, v in values.items()], header)
    head = described.select(*keys, F.posexplode(top).alias("ordem", "linha")).select(
        *keys, "ordem", F.lit(0).cast("bigint").alias("id"), "linha"
    )
    return head.unionByName(data)


def _write_files(lines: DataFrame, path: str) -> None:
    """The lines of each file in order, as Latin-1 text; a line of NULL is left out.

    Files are many and small, so workers open them themselves: Spark's writer makes a folder
    for each, and without Hadoop's native library starts a process for every one of both.
    A file has its name when it is whole, so a task that runs again does no harm.
    """
    system, below = file_system(lines.sparkSession, path)
    system.mkdirs(below())

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = path.replace("s3a://", "s3://")
        store, root = fs.FileSystem.from_uri(plain) if "://" in plain or plain.startswith("file:") else (fs.LocalFileSystem(), plain)
        name = out = None
        done = 0

        def close() -> None:
            nonlocal done
            if out is not None:
                out.close()
                store.move(unfinished, f"{root}/{name}.csv")
                done += 1

        for batch in batches:
            runs = pc.run_end_encode(batch.column("arquivo"))
            texts, start = batch.column("linha").to_pylist(), 0
            for end, of in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if of != name:
                    close()
                    name, unfinished = of, f"{root}/.{of}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(unfinished, compression=None)
                out.write("".join([f"{t}\n" for t in texts[start:end] if t is not None]).encode("iso-8859-1", "replace"))
                start = end
        close()
        yield pa.RecordBatch.from_pydict({"arquivos": [done]})

    ordered = lines.repartition("arquivo").sortWithinPartitions("arquivo", "ordem", "id").select("arquivo", "linha")
    ordered.mapInArrow(written, "arquivos bigint").write.format("noop").mode("overwrite").save()


def station_files(spark: SparkSession, folder: str, faults: bool = False) -> str:
    """Latin-1 station files of all events; returns their folder."""

    def write(path: str) -> None:
        lines = station_lines(mapping.raw_observations(spark, folder), mapping.stations(spark, folder), faults)
        _write_files(lines.withColumn("arquivo", F.concat_ws("_", F.lit("ESTACAO"), "codigo_wmo", "mes", "parte")), path)

    return _once(spark, folder, "faulty-files" if faults else "station-files", write)


def broken_files(spark: SparkSession, folder: str) -> str:
    """One file per station with events: by code without header, without code, with a latitude that is none, or whole."""

    def write(path: str) -> None:
        kind = F.col("codigo_wmo").cast("bigint") % 4
        header = ";".join(["Data", "Hora UTC", *[S.CSV_TITLES[m][0] for m in S.MEASURES], ""])
        top = F.array(
            F.concat(F.lit("ESTACAO:;"), "nome"),
            F.when(kind != 1, F.concat(F.lit("CODIGO (WMO):;"), "codigo_wmo")),
            F.concat(F.lit("LATITUDE:;"), F.when(kind == 2, F.lit("norte")).otherwise(F.translate(F.col("latitude").cast("string"), ".", ","))),
            F.when(kind != 0, F.lit(header)),
            F.lit("2024/01/01;0000 UTC;1,5;"),
        )
        active = mapping.raw_observations(spark, folder).select("codigo_wmo").distinct()
        lines = mapping.stations(spark, folder).join(active, "codigo_wmo").select("codigo_wmo", F.posexplode(top).alias("ordem", "linha")).where(F.col("linha").isNotNull())
        named = lines.withColumns({"arquivo": F.concat(F.lit("E"), "codigo_wmo"), "id": F.lit(0)})
        _write_files(named.coalesce(8), path)

    return _once(spark, folder, "broken-files", write)


def telemetry_points(spark: SparkSession, folder: str) -> DataFrame:
    """Long points of all events: device, key, hour in ms, value, id."""
    raw = mapping.raw_observations(spark, folder)
    keys = {key: F.col(measure).cast("string").alias(key) for key, measure in S.TELEMETRY_KEYS.items()}
    wide = raw.select(
        F.concat(F.lit("dev-"), "codigo_wmo").alias("device_id"),
        epoch_ms(hour_start(F.col("timestamp_utc"))).alias("ts"),
        "id",
        *keys.values(),
    )
    return wide.unpivot(["device_id", "ts", "id"], list(keys), "key", "value").where(F.col("value").isNotNull())


def telemetry_documents(spark: SparkSession, folder: str) -> str:
    """JSON documents of all events' points; returns their folder."""

    def write(path: str) -> None:
        points = telemetry_points(spark, folder).withColumn("seq", F.floor(F.col("id") / POINTS_PER_DOCUMENT))
        series = (
            points.groupBy("device_id", "seq", "key")
            .agg(F.sort_array(F.collect_list(F.struct("id", "ts", "value"))).alias("_items"))
            .withColumn("_items", F.transform("_items", lambda p: F.struct(p["ts"].alias("ts"), p["value"].alias("value"))))
        )
        documents = series.groupBy("device_id", "seq").agg(
            F.map_from_entries(F.collect_list(F.struct("key", "_items"))).alias("telemetry")
        )
        documents.write.json(path)

    return _once(spark, folder, "telemetry", write)


def telemetry_deliveries(spark: SparkSession, folder: str) -> str:
    """The documents, and behind them drafts of every second one: older by number, with other values."""

    def write(path: str) -> None:
        documents = spark.read.schema(S.TELEMETRY_DOCUMENTS).json(telemetry_documents(spark, folder))
        documents.write.json(path)
        draft = F.transform_values(
            "telemetry", lambda _, items: F.transform(items, lambda p: F.struct(p["ts"].alias("ts"), F.lit("0.5").alias("value")))
        )
        older = documents.where(F.col("seq") % 2 == 0).withColumns({"telemetry": draft, "seq": F.col("seq") - 1_000_000_000})
        older.coalesce(4).write.mode("append").json(path)

    return _once(spark, folder, "deliveries", write)


def device_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One device per station; attributes as an object or a list of pairs."""
    station = mapping.stations(spark, folder)
    values = {
        "codigo_wmo": F.col("codigo_wmo"),
        "nome": F.col("nome"),
        "latitude": F.col("latitude").cast("string"),
        "longitude": F.col("longitude").cast("string"),
        "altitude": F.col("altitude").cast("string"),
        "estado": F.col("uf"),
        "tipo": F.lit("Estação Automática"),
    }
    as_object = F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))
    as_list = F.to_json(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()]))
    return station.select(
        F.concat(F.lit("dev-"), "codigo_wmo").alias("device_id"),
        F.concat_ws("_", F.lit("Estacao"), "codigo_wmo", "regiao").alias("name"),
        F.lit("estacao").alias("type"),
        F.concat_ws(" ", "nome", "regiao").alias("label"),
        F.when(_accented(), as_object).otherwise(as_list).alias("attributes"),
    )


def device_list(spark: SparkSession, folder: str) -> str:
    return _once(spark, folder, "devices", lambda path: device_rows(spark, folder).write.json(path))
