"""The rainfall rule and the order of its classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pluvio import schema as S


def rainfall_class(precipitation: Column) -> Column:
    """Class of one hour's rain in mm.

    Amounts are compared as two-decimal numbers, never as doubles. Missing,
    zero, negative and in-between amounts (0.05, 2.55) all mean no rain.
    """
    mm = precipitation.try_cast("decimal(18,2)")
    return (
        F.when(mm.between(F.lit(S.LIGHT_FROM), F.lit(S.LIGHT_TO)), S.LIGHT)
        .when(mm.between(F.lit(S.MODERATE_FROM), F.lit(S.MODERATE_TO)), S.MODERATE)
        .when(mm > F.lit(S.MODERATE_TO), S.HEAVY)
        .otherwise(S.NONE)
    )


def fill_class(current: Column, precipitation: Column) -> Column:
    """Keep a class that is already there; classify the rows without one."""
    missing = current.isNull() | (current == "")
    return F.when(missing, rainfall_class(precipitation)).otherwise(current)


def severity(rain_class: Column) -> Column:
    """1 for no rain up to 4 for heavy rain; 5 for anything else."""
    rank = F.lit(5)
    for position, name in reversed(list(enumerate(S.CLASSES, start=1))):
        rank = F.when(rain_class == name, position).otherwise(rank)
    return rank
