"""As-of joins in two forms: by a window over the union of both sides, and by a broadcast of few right rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def backward(left: DataFrame, right: DataFrame, by: list[str], on: str, value: str) -> DataFrame:
    """left with ``value`` of the right row with the latest ``on`` at or before its own (null if none).

    One sort by key; both sides meet in one shuffle. right must hold one row per key and ``on``.
    """
    order = Window.partitionBy(*by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = left.withColumn("_side", F.lit(1)).unionByName(right.select(*by, on, value).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(order)).where("_side = 1").drop("_side")


def latest_dates(days: DataFrame, snapshots: DataFrame, day: str, snapshot: str) -> DataFrame:
    """Each day with the latest snapshot date at or before it; days before the first are left out.

    Both are distinct dates, some hundreds a year, so a comparison of all is cheap.
    """
    s = F.broadcast(snapshots.select(snapshot).distinct())
    return days.select(day).distinct().join(s, F.col(snapshot) <= F.col(day)).groupBy(day).agg(F.max(snapshot).alias(snapshot))
