"""Time of observations: parts, epoch conversion and text pieces.

All conversions work on zone-less timestamps that mean UTC, so they do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(ts: Column) -> Column:
    """Day of the week with Sunday as 0."""
    return F.dayofweek(ts) - 1


def calendar_parts(ts: Column) -> list[Column]:
    return [
        F.year(ts).alias("ano"),
        F.month(ts).alias("mes"),
        F.dayofmonth(ts).alias("dia"),
        F.hour(ts).alias("hora"),
        weekday(ts).alias("dia_semana"),
    ]


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def hour_start(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 of a zone-less UTC timestamp."""
    day_ms = F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000
    clock_ms = F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
    second_ms = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return day_ms + clock_ms + second_ms


def from_epoch_ms(ms: Column) -> Column:
    """Zone-less UTC timestamp of an epoch in milliseconds."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = ms.cast("decimal(20,0)") * F.lit(0.001).cast("decimal(4,3)")
    return origin + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def clock_text(ts: Column, length: int = 8) -> Column:
    """``HH:mm:ss``, the stored form of the hour, or its first characters."""
    return F.substring(ts.cast("string"), 12, length)


def utc_timestamp(day: Column, clock: Column) -> Column:
    """Zone-less timestamp from a date and an ``HH:mm:ss`` text."""
    return F.concat_ws(" ", day.cast("string"), clock).try_cast("timestamp_ntz")
