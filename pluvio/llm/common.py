"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.session import fresh_path

#: Rows an operator hands back to Spark at once; bounds a worker's output buffer.
ROWS = 256


#: What operators keep in a worker between tasks, to save time only: who, and how it is let go.
_kept: dict[str, Callable[[], object]] = {}
_working: str | None = None


def kept_by(operator: str, drop: Callable[[], object]) -> None:
    """Registers what an operator keeps in a worker; ``drop`` lets it go."""
    _kept[operator] = drop


def working(operator: str) -> None:
    """Called by tasks: whatever other operators keep in this worker is let go.

    Workers are used again by the stages of a pipeline; without this each would
    carry the memory of all stages before. What is free then goes back to the machine:
    allocators keep it, in workers that wait for a task too.
    """
    global _working
    if operator != _working:
        for name, drop in _kept.items():
            if name != operator:
                drop()
        _working = operator
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # other C libraries than glibc have none
            ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(key: Column) -> Column:
    """The contract's fold: crc32 of the id as text, modulo five, is zero."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def by_slices(function: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = ROWS):
    """A mapInArrow function that works through every batch in slices of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield function(batch.slice(start, rows))

    return run


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores behind it while the frame has such a column already."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def kinds(df: DataFrame) -> str:
    """The frame's columns as a schema text."""
    quoted = [(f.name.replace("`", "``"), f.dataType.simpleString()) for f in df.schema]
    return ", ".join(f"`{name}` {kind}" for name, kind in quoted)


def with_values(df: DataFrame, source: str, name: str, kind: str, arrow: pa.DataType, function: Callable[[list], list], rows: int = ROWS) -> DataFrame:
    """The frame and a column ``name``, made by ``function`` from lists of values of ``source``."""
    place = df.columns.index(source)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = pa.array(function(batch.column(place).to_pylist()), arrow)
        return pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    return df.mapInArrow(by_slices(run, rows), f"{kinds(df)}, `{name}` {kind}")
