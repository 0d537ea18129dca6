"""Exact quantiles by selecting ranks from counts per value range.

No task ever gets the values of a measure. A first pass takes count, least and
greatest value of every measure; a second counts the rows of ``BINS`` equal ranges
between them, combined before the shuffle. A running count over the ranges tells
which one holds a wanted rank, and the range keeps its own least and greatest value,
so the next pass divides it again. After one to three of them, by the type, the few distinct
values left in a range are counted and the rank is found among them. What meets per
measure and group is at most ``BINS`` ranges, then the values of one range: decimals
of eight digits leave 1,526 at most, of ten 152,588, whatever the number of rows and
wherever they gather.

Decimals keep the largest scale among the measures and are exact; if one is a
binary floating-point column, all are compared as such, unrounded. NULL and NaN
have no value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.functions.numeric import total

BINS = 65_536


def scale_of(df: DataFrame, measures: Sequence[str]) -> int | None:
    """Decimal places that hold every value of the measures; nothing if one is floating point."""
    kinds = [df.schema[m].dataType for m in measures]
    if any(isinstance(k, T.FractionalType) and not isinstance(k, T.DecimalType) for k in kinds):
        return None
    return max(k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds)


def typed(df: DataFrame, measures: Sequence[str], *others: str) -> DataFrame:
    """The measures in one type, NaN as NULL, and the other columns."""
    scale = scale_of(df, measures)
    if scale is None:
        columns = [F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double")).alias(m) for m in measures]
    else:
        kinds = [df.schema[m].dataType for m in measures]
        whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else 19 for k in kinds)
        columns = [F.col(m).cast(f"decimal({min(whole + scale, 38)},{scale})").alias(m) for m in measures]
    return df.select(*others, *columns)


def _passes(kind: T.DataType) -> int:
    """Divisions after which few values are left in a range; floating-point values may gather anywhere."""
    return 3 if not isinstance(kind, T.DecimalType) else 1 if kind.precision <= 10 else 2


def _long(df: DataFrame, measures: Sequence[str], *others: str) -> DataFrame:
    """A row per value; ``_m`` is the place of its measure, which joins faster than its name."""
    rows = [F.struct(F.lit(i).alias("_m"), F.col(m).alias("valor")) for i, m in enumerate(measures)]
    return df.select(*others, F.inline(F.array(*rows))).where(F.col("valor").isNotNull())


def spans(values: DataFrame, measures: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Per group and measure: rows, gaps, sum, deviation, least and greatest value; one pass, rows not multiplied.

    The sample deviation comes from centred moments, which merge without
    subtracting large squares.
    """
    cells = []
    for i, m in enumerate(measures):
        kind = values.schema[m].dataType
        whole = total(m, kind.scale, kind.precision) if isinstance(kind, T.DecimalType) else F.sum(m)
        cells.append(
            F.struct(
                F.lit(m).alias("variavel"), F.lit(i).alias("_m"), F.count(m).alias("_total"), F.count_if(F.col(m).isNull()).alias("_gaps"),
                whole.alias("_sum"), F.stddev_samp(F.col(m).cast("double")).alias("_deviation"), F.min(m).alias("_low"), F.max(m).alias("_high"),
            )
        )
    return values.groupBy(*groups).agg(F.array(*cells).alias("_cells")).select(*groups, F.inline("_cells"))


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str], inside: Column | None = None) -> DataFrame:
    """An inner join in which NULL groups are equal too."""
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = _same(keys) if inside is None else _same(keys) & inside
    return left.join(named, same).drop(*[f"_r_{k}" for k in keys])


def _same(keys: Sequence[str]) -> Column:
    same = F.col("_m") == F.col("_r__m")
    for k in keys:
        if k != "_m":
            same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return same


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """The equal range of ``low`` to ``high`` that holds a value; never falls as the value grows."""
    low, value = low.cast("double"), value.cast("double")
    share = F.try_divide(value - low, high.cast("double") - low)
    # Infinite ends leave no share; such values go to the last range.
    whole = F.floor(F.least(F.nanvl(F.coalesce(share, F.lit(0.0)), F.lit(1.0)), F.lit(1.0)) * bins)
    return F.least(whole, F.lit(bins - 1)).cast("int")


def select_ranks(values: DataFrame, measures: Sequence[str], ranks: dict[str, Column], span: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Per group and measure (``_m``) of ``span`` with values: the value at every named zero-based rank.

    ``values`` comes from ``typed``; the ranks are columns over ``span``.
    """
    keys = [*groups, "_m"]
    rows = _long(values, measures, *groups)
    names = list(ranks)
    ranges = span.where(F.col("_total") > 0).select(*keys, "_low", "_high", *[r.cast("bigint").alias(n) for n, r in ranks.items()])

    def passed(counted: DataFrame, order: str, whole: Sequence[str]) -> DataFrame:
        """Ranks counted from the start of the range that holds them, NULL elsewhere; ranges without any are dropped."""
        until = F.sum("_n").over(Window.partitionBy(*whole).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        placed = counted.withColumn("_before", until - F.col("_n"))
        here = {n: F.when((F.col(n) >= F.col("_before")) & (F.col(n) < F.col("_before") + F.col("_n")), F.col(n) - F.col("_before")) for n in names}
        return placed.withColumns(here).where(F.coalesce(*names).isNotNull())

    wanted = [F.max(n).alias(n) for n in names]
    between = F.col("valor").between(F.col("_low"), F.col("_high"))
    for _ in range(_passes(span.schema["_low"].dataType)):
        # A handful of ranges per group and measure, each with its own ends.
        met = _meet(rows, ranges, keys, between)
        binned = met.withColumn("_bin", bin_of(F.col("valor"), F.col("_low"), F.col("_high"), BINS))
        counted = binned.groupBy(*keys, F.col("_low").alias("_from"), "_bin").agg(
            F.count("*").alias("_n"), F.min("valor").alias("_low"), F.max("valor").alias("_high"), *wanted
        )
        ranges = passed(counted, "_bin", [*keys, "_from"]).select(*keys, "_low", "_high", *names)
    counted = _meet(rows, ranges, keys, between).groupBy(*keys, F.col("_low").alias("_from"), "valor").agg(F.count("*").alias("_n"), *wanted)
    found = passed(counted, "valor", [*keys, "_from"])
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col(n).isNotNull(), F.col("valor"))).alias(n) for n in names])


def with_quantiles(values: DataFrame, measures: Sequence[str], probabilities: dict[str, float], span: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The rows of ``span`` and linearly interpolated quantiles as doubles, NULL where a measure has no value."""
    keys = [*groups, "_m"]
    kind = span.schema["_low"].dataType
    unit = F.lit(10**kind.scale if isinstance(kind, T.DecimalType) else 1)
    position = {name: F.lit(p) * (F.col("_total") - 1) for name, p in probabilities.items()}
    ranks = {f"_{side}_{name}": turn(at) for name, at in position.items() for side, turn in (("f", F.floor), ("c", F.ceil))}
    found = select_ranks(values, measures, ranks, span, groups)
    steps = {n: (F.col(n) * unit).cast("double") for n in ranks}
    named = found.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[v.alias(n) for n, v in steps.items()])
    results = {
        name: (F.col(f"_f_{name}") + (F.col(f"_c_{name}") - F.col(f"_f_{name}")) * (at - F.floor(at))) / unit for name, at in position.items()
    }
    return span.join(named, _same(keys), "left").withColumns(results).drop(*ranks, *[f"_r_{k}" for k in keys])


def quantiles(
    df: DataFrame, measures: Sequence[str], probabilities: dict[str, float], groups: Sequence[str] = ()
) -> DataFrame:
    """One row per group and measure with the named quantiles as doubles."""
    values = typed(df, measures, *groups)
    found = with_quantiles(values, measures, probabilities, spans(values, measures, groups), groups)
    return found.select(*groups, "variavel", *probabilities)


def medians(df: DataFrame, measures: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Exact medians, one column per measure and one row per group."""
    per_measure = quantiles(df, measures, {"mediana": 0.5}, groups)
    columns = [F.max(F.when(F.col("variavel") == m, F.col("mediana"))).alias(m) for m in measures]
    return per_measure.groupBy(*groups).agg(*columns)
