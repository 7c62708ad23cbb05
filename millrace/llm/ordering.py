"""Distributed prefix sums over a total order, in DataFrame operations only.

A range sort deals the rows into ordered partitions; sums run inside each partition
and one offset per (partition, group) is added. No group ever meets in one task,
so a group may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

PART = "_part"


def range_parts(df: DataFrame, order: list[Column], space: Workspace, name: str) -> DataFrame:
    """df written in range-sorted partitions, with the partition's number in _part.

    The written numbers hold through retries; a total order makes results independent
    of where the boundaries fall.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return space.save(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), name)


def prefix_sums(parted: DataFrame, group: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name in sums, the sum of its value over the group's earlier rows.

    group: a non-null column by which range_parts() sorted first. Values must not be null.
    """
    before = Window.partitionBy(PART, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = parted.select("*", *(F.coalesce(F.sum(v).over(before), F.lit(0).cast("bigint")).alias(n) for n, v in sums.items()))
    totals = parted.groupBy(F.col(group).alias("_g"), F.col(PART).alias("_p")).agg(*(F.sum(v).alias(n) for n, v in sums.items()))
    # A group has a row here for each partition that it reaches, never more than there are partitions.
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_g", "_p", *(F.sum(n).over(earlier).alias(f"_off_{n}") for n in sums))
    # Only groups that began in an earlier partition have one: at most one for each partition, so it is small.
    offsets = F.broadcast(offsets.where(F.col(f"_off_{next(iter(sums))}").isNotNull()))
    joined = inside.join(offsets, (F.col(group) == F.col("_g")) & (F.col(PART) == F.col("_p")), "left")
    return joined.select(*parted.columns, *((F.col(n) + F.coalesce(F.col(f"_off_{n}"), F.lit(0).cast("bigint"))).alias(n) for n in sums))
