"""Consecutive numbers over a distributed order, without one global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def place(frame: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Range-sort the frame and record where every row landed.

    Must be written out before numbering: the places are those of this one
    sort, and reading them back keeps them fixed when tasks are lost or rerun.
    """
    return frame.orderBy(*order_by).select(
        "*",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )


def number(placed: DataFrame, sections: Sequence[str], name: str) -> DataFrame:
    """Number placed rows 1..n, section by section in ascending order.

    Only one row per section and sort partition is brought together to add up
    the offsets; that count is set by the cluster, not by the data.
    """
    group = [*sections, "part"]
    ordered = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first_place"))
        .select(*group, "first_place", F.coalesce(F.sum("rows").over(ordered), F.lit(0)).alias("offset"))
    )
    return (
        placed.join(F.broadcast(offsets), group)
        .withColumn(name, F.col("offset") + F.col("place") - F.col("first_place") + 1)
        .drop("part", "place", "first_place", "offset")
    )
