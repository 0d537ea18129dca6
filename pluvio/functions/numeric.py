"""Means and percentages over exact decimal sums.

Sums of two-decimal columns are exact and do not depend on the order in which
partitions arrive, so dividing once at the end gives the same number in every
run. Rounded results use integer arithmetic, half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pluvio import schema as S

#: Digits of the measures' columns.
MEASURE_DIGITS = {name: int(kind[len("decimal(") :].split(",")[0]) for name, kind in S.MEASURES.items()}


def total(value: Column | str, scale: int = 2, digits: int | None = None) -> Column:
    """Aggregate: the exact sum, wide enough for any number of rows.

    A sum of ``decimal(5,2)`` is ``decimal(15,2)`` and ends at 1e13, which
    10**11 rows of humidity reach. Columns of at most eight digits are summed as
    ``decimal(8,scale)``: Spark adds those as 64-bit numbers, and ``decimal(18,scale)``
    holds 10**13 rows of 999.99. All others take ``decimal(28,scale)``. ``scale`` is
    the column's own; ``digits`` its digits, known for measures given by name.
    """
    if isinstance(value, str):
        digits = MEASURE_DIGITS.get(value) if digits is None else digits
        value = F.col(value)
    if digits is not None and digits <= 8:
        return F.sum(value.cast(f"decimal(8,{scale})")).cast(f"decimal(28,{scale})")
    return F.sum(value.cast(f"decimal({max(28, digits or 0)},{scale})"))


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in hundredths, rounded half away from zero.

    Both arguments are whole numbers and the numerator already counts
    hundredths. The result is a two-decimal number, NULL over zero.
    """
    bottom = F.nullif(denominator, F.lit(0))
    size = F.call_function("div", F.abs(numerator) * 2 + bottom, bottom * 2)
    signed = F.when(numerator < 0, -size).otherwise(size)
    return (signed.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(18,2)")


def mean(value: Column | str, scale: int = 2, digits: int | None = None) -> Column:
    """Aggregate: the exact sum over the number of non-null values, as double."""
    return F.try_divide(total(value, scale, digits).cast("double"), F.count(value))


def rounded_mean(value: Column | str) -> Column:
    """Aggregate: the mean of a two-decimal column, rounded to two decimals."""
    hundredths = (total(value) * 100).cast("bigint")
    return half_up_ratio(hundredths, F.count(value))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, rounded to two decimals."""
    return half_up_ratio(part * 10000, whole)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
