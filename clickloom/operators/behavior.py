"""Rolling event counts per visitor-day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ADD_TO_CART, LONG_WINDOW_DAYS, SHORT_WINDOW_DAYS, TRANSACTION, VIEW
from .snapshots import KEY, days_before


def daily_event_counts(silver: DataFrame) -> DataFrame:
    """Views, cart additions and transactions per visitor-day."""
    return silver.groupBy(*KEY).agg(
        F.count_if(F.col("event") == VIEW).alias("views"),
        F.count_if(F.col("event") == ADD_TO_CART).alias("addtocarts"),
        F.count_if(F.col("event") == TRANSACTION).alias("transactions"),
    )


def build_user_behavior(silver: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Views and cart additions of the last 7 days, transactions of the last 30."""
    counts = ["views", "addtocarts", "transactions"]
    daily = snapshots.join(daily_event_counts(silver), KEY, "left").fillna(0, counts)
    short, long = days_before(SHORT_WINDOW_DAYS, 1), days_before(LONG_WINDOW_DAYS, 1)
    frames = [
        ("user_views_7d", "views", short),
        ("user_addtocart_7d", "addtocarts", short),
        ("user_transactions_30d", "transactions", long),
    ]
    return daily.select(
        *KEY,
        *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(name) for name, c, w in frames],
    )
