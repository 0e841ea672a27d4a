"""The purchase label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import TRANSACTION
from .snapshots import KEY


def daily_purchases(silver: DataFrame) -> DataFrame:
    """Visitor-days with at least one transaction."""
    return silver.filter(F.col("event") == TRANSACTION).select(*KEY).distinct()


def create_purchase_target(user_data: DataFrame, purchases: DataFrame, days: int = 7) -> DataFrame:
    """Add ``purchase_next_<days>d``: 1 if a purchase falls on day D to D+days-1.

    Purchases are laid between the snapshots of the same visitor and seen through
    a forward day frame, so neither side is multiplied by the number of days.
    """
    mark = "_purchase"
    both = user_data.withColumn(mark, F.lit(0)).unionByName(
        purchases.select(*KEY).withColumn(mark, F.lit(1)), allowMissingColumns=True
    )
    ahead = Window.partitionBy("visitorid").orderBy("snapshot_day").rangeBetween(0, days - 1)
    name = f"purchase_next_{days}d"
    return (
        both.withColumn(name, F.max(mark).over(ahead).cast("byte"))
        .filter(F.col(mark) == 0)
        .drop(mark)
    )
