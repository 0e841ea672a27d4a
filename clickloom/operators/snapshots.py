"""Visitor-day snapshots, the key of every point-in-time feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.timeline import day_index

KEY = ["visitorid", "snapshot_day"]


def add_snapshot_day(df: DataFrame) -> DataFrame:
    """Add the integer day index of the event."""
    return df.withColumn("snapshot_day", day_index("event_time"))


def require_rows(silver: DataFrame) -> None:
    if silver.isEmpty():
        raise ValueError("silver is empty: no snapshots can be built")


def silver_totals(silver: DataFrame) -> Column:
    """Number of items and last day of silver, as one scalar subquery."""
    per_item = silver.groupBy("itemid").agg(F.max("snapshot_day").alias("day"))
    return per_item.agg(
        F.struct(F.count(F.lit(1)).alias("items"), F.max("day").alias("last_day"))
    ).scalar()


def build_snapshot_dates(silver: DataFrame) -> DataFrame:
    """Every visitor-day with an event, and for every visitor the day after the
    last day of the whole data."""
    require_rows(silver)
    inference_day = (silver_totals(silver)["last_day"] + 1).cast("int")
    days = silver.select(*KEY).distinct()
    # Later than every event day, so the two parts cannot overlap.
    ahead = silver.select("visitorid").distinct().withColumn("snapshot_day", inference_day)
    return days.unionByName(ahead)


def days_before(first: int, last: int, by: str = "visitorid") -> WindowSpec:
    """Calendar-day frame ``[-first, -last]`` over the day index of one entity."""
    return Window.partitionBy(by).orderBy("snapshot_day").rangeBetween(-first, -last)
