"""Ordered per-group operators that never sort a whole group in one task.

A group is cut into time buckets. Bucket totals are small, so a window over
them is cheap however large the group is; the rows themselves are only ever
ordered within one bucket. One station or device may hold most of the rows
without any task holding more than one bucket of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def running_total(
    df: DataFrame,
    group: str,
    order: str,
    value: str,
    output: str,
    bucket: Column | None = None,
) -> DataFrame:
    """Running sum of ``value`` per group by ``order``; equal times share a sum.

    Rows of one time are summed first, combined before the shuffle, so ties
    and repeated rows never gather. The default bucket is the calendar day: what
    is ordered in one task is the distinct times of a group's day, and a group
    has one total per day. The sums join the rows by group and time. NULL values
    add nothing, and a group's sum is NULL until its first value. Rows without a
    time come last, and rows without a group are a group.
    """
    kind = df.schema[value].dataType
    wide = F.col(value).cast(T.DecimalType(28, kind.scale)) if isinstance(kind, T.DecimalType) else F.col(value)
    day = F.to_date(order) if bucket is None else bucket
    times = df.groupBy(group, order).agg(F.sum(wide).alias("_sum")).withColumn("_bucket", day)
    earlier = Window.partitionBy(group).orderBy(F.asc_nulls_last("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        times.groupBy(group, "_bucket")
        .agg(F.sum("_sum").alias("_bucket_sum"))
        .select(F.col(group).alias("_of"), F.col("_bucket").alias("_in"), F.sum("_bucket_sum").over(earlier).alias("_before"))
    )
    within = F.sum("_sum").over(Window.partitionBy(group, "_bucket").orderBy(F.asc_nulls_last(order)))
    total = F.coalesce(F.col("_before") + F.col("_within"), F.col("_within"), F.col("_before"))
    there = F.col(group).eqNullSafe(F.col("_of")) & F.col("_bucket").eqNullSafe(F.col("_in"))
    sums = times.withColumn("_within", within).join(offsets, there)
    sums = sums.select(F.col(group).alias("_group"), F.col(order).alias("_order"), total.alias(output))
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(order).eqNullSafe(F.col("_order"))
    return df.join(sums, same).drop("_group", "_order")


def newest_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    limit: int,
    bucket: Column,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest ``limit`` rows of each group.

    Counts per bucket tell which buckets the limit reaches; all rows of older
    buckets are dropped before anything is sorted. The rows that remain are
    ranked within their bucket, behind the count of the newer buckets. However often
    a bucket's rows were delivered, no task sends on more than ``limit`` of them.
    """
    groups = list(groups)
    rows = df.withColumn("_bucket", bucket)
    newer = Window.partitionBy(*groups).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        rows.groupBy(*groups, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
        .where(F.col("_newer") < limit)
        .drop("_rows")
    )
    within = Window.partitionBy(*groups, "_bucket").orderBy(F.desc(order), *tie_break)
    return (
        rows.join(reach, [*groups, "_bucket"])
        .withColumn("_place", F.row_number().over(within))
        .where(F.col("_place") <= limit)
        .where(F.col("_newer") + F.col("_place") <= limit)
        .drop("_bucket", "_newer", "_place")
    )
