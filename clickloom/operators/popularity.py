"""Item popularity, top sellers and cart features.

An item's 30-day popularity changes only when a sale enters or leaves the
window. It is kept as spans of days with one value instead of an items x days
grid: every sale gives two change points, whatever the number of days. The
distribution of popularity on a day is a small histogram built from the spans;
items without a sale in the window are its zero bucket, known from the number of
items alone.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    ADD_TO_CART,
    LONG_WINDOW_DAYS,
    SHORT_WINDOW_DAYS,
    TOP_SELLER_QUANTILE,
    TRANSACTION,
)
from .snapshots import KEY, days_before, silver_totals

ITEM_KEY = ["itemid", "snapshot_day"]
Method = Literal["disc", "linear"]


def item_day_counts(silver: DataFrame) -> DataFrame:
    """Sales and cart additions per item and day with any event.

    All that depends on items and days only follows from this table, which is far smaller
    than silver. The functions below take silver or the stored counts.
    """
    if "sold" in silver.columns:
        return silver
    return silver.groupBy(*ITEM_KEY).agg(
        F.count_if(F.col("event") == TRANSACTION).alias("sold"),
        F.count_if(F.col("event") == ADD_TO_CART).alias("carted"),
    )


def item_daily_transactions(silver: DataFrame) -> DataFrame:
    """Transactions per item and day."""
    sold = silver.filter(F.col("event") == TRANSACTION)
    return sold.groupBy(*ITEM_KEY).agg(F.count(F.lit(1)).alias("transactions"))


def silver_days(silver: DataFrame) -> DataFrame:
    """Days with any event; at most one row per calendar day."""
    return silver.select("snapshot_day").distinct()


def item_day_grid(silver: DataFrame) -> DataFrame:
    """Every item on every day, with its transactions of that day or zero.

    Kept for callers that want the dense table. The features below do not use it.
    """
    days = silver_days(silver).agg(F.collect_list("snapshot_day")).scalar()
    grid = silver.select("itemid").distinct().withColumn("snapshot_day", F.explode(days))
    return grid.join(item_daily_transactions(silver), ITEM_KEY, "left").fillna(0, ["transactions"])


def popularity_spans(silver: DataFrame, window_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """Spans ``[from_day, to_day)`` in which an item's popularity is constant and
    above zero."""
    changes = (
        "inline(array(struct(snapshot_day + 1 AS from_day, sold AS change), "
        f"struct(snapshot_day + {window_days + 1} AS from_day, -sold AS change)))"
    )
    if "event" in silver.columns:  # without stored counts: views are not read here
        silver = silver.filter(F.col("event") == TRANSACTION)
    steps = (
        item_day_counts(silver)
        .filter("sold > 0")
        .selectExpr("itemid", changes)
        .groupBy("itemid", "from_day")
        .agg(F.sum("change").alias("change"))
    )
    in_time = "PARTITION BY itemid ORDER BY from_day"
    return steps.selectExpr(
        "itemid",
        "from_day",
        f"lead(from_day) OVER ({in_time}) AS to_day",
        f"sum(change) OVER ({in_time} ROWS UNBOUNDED PRECEDING) AS item_transactions_30d",
    ).filter("item_transactions_30d > 0")


def _each_day(spans: DataFrame, *columns: str) -> DataFrame:
    """One row per span and day. A span is never longer than the window."""
    return spans.select(
        *columns, F.explode(F.sequence("from_day", F.col("to_day") - 1)).alias("snapshot_day")
    )


def item_popularity(silver: DataFrame, window_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """Popularity per item and day of the data, without the rows where it is zero."""
    rows = _each_day(popularity_spans(silver, window_days), "itemid", "item_transactions_30d")
    return rows.join(silver_days(silver), "snapshot_day", "left_semi").select(
        *ITEM_KEY, "item_transactions_30d"
    )


def popularity_histogram(silver: DataFrame, window_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """Number of items per calendar day and popularity above zero.

    The days of a span are counted before the shuffle, so what travels is one
    row per day and distinct popularity, not one per item and day.
    """
    days = _each_day(popularity_spans(silver, window_days), "item_transactions_30d")
    return days.groupBy("snapshot_day", "item_transactions_30d").agg(
        F.count(F.lit(1)).alias("items")
    )


def _thresholds_above_zero(
    silver: DataFrame, quantile: float, method: Method, window_days: int = LONG_WINDOW_DAYS
) -> DataFrame:
    """Popularity quantile over all items, for calendar days on which any item is
    popular. On every other day it is zero.

    The ordered step holds one row per distinct popularity of a day, and k
    distinct values need at least k(k+1)/2 sales within the window.
    """
    if method not in ("disc", "linear"):
        raise ValueError(f"unknown method {method!r}")
    ranked = (
        popularity_histogram(silver, window_days)
        .selectExpr(
            "snapshot_day",
            "item_transactions_30d AS value",
            "sum(items) OVER (PARTITION BY snapshot_day) AS popular",
            "sum(items) OVER (PARTITION BY snapshot_day ORDER BY item_transactions_30d"
            " ROWS UNBOUNDED PRECEDING) AS up_to",
        )
        .withColumn("all", silver_totals(silver)["items"])
        .withColumn("zeros", F.col("all") - F.col("popular"))
    )

    def at_rank(rank: Column) -> Column:
        above_zero = F.min(F.when(F.col("zeros") + F.col("up_to") >= rank, F.col("value")))
        reached_by_zeros = F.bool_and(F.col("zeros") >= rank)
        return F.when(reached_by_zeros, F.lit(0)).otherwise(above_zero).cast("double")

    if method == "disc":
        threshold = at_rank(F.greatest(F.ceil(F.lit(quantile) * F.col("all")), F.lit(1)))
    else:
        position = F.lit(quantile) * (F.col("all") - 1)
        low, high = at_rank(F.floor(position) + 1), at_rank(F.ceil(position) + 1)
        threshold = low + (high - low) * F.max(position - F.floor(position))
    return ranked.groupBy("snapshot_day").agg(threshold.alias("top_10_threshold"))


def top_seller_threshold(
    silver: DataFrame, quantile: float = TOP_SELLER_QUANTILE, method: Method = "disc"
) -> DataFrame:
    """Popularity quantile over all items, one row per day of the data.

    ``disc`` gives an observed value, ``linear`` interpolates between two.
    """
    above = _thresholds_above_zero(silver, quantile, method)
    return silver_days(silver).join(above, "snapshot_day", "left").fillna(0.0, ["top_10_threshold"])


def _with_flag(popularity: DataFrame, thresholds: DataFrame) -> DataFrame:
    # One threshold row per calendar day; adaptive execution broadcasts it if it is small.
    joined = popularity.join(thresholds, "snapshot_day", "left").fillna(
        0.0, ["top_10_threshold"]
    )
    top = F.col("item_transactions_30d") >= F.col("top_10_threshold")
    return joined.withColumn("is_top_seller", top.cast("int"))


def _with_zeros(silver: DataFrame, popular: DataFrame) -> DataFrame:
    """One more row per day of the data, for all items of zero popularity together.

    ``items`` is 1 on an item's own row; on the other row ``itemid`` is null and
    ``items`` is their number, 0 included.
    """
    counted = popular.groupBy("snapshot_day").agg(F.count(F.lit(1)).alias("popular"))
    zeros = (
        silver_days(silver)
        .join(counted, "snapshot_day", "left")
        .withColumn("all", silver_totals(silver)["items"])
        .select(
            F.lit(None).cast(popular.schema["itemid"].dataType).alias("itemid"),
            "snapshot_day",
            F.lit(0).cast("long").alias("item_transactions_30d"),
            (F.col("all") - F.coalesce("popular", F.lit(0))).alias("items"),
        )
    )
    return popular.withColumn("items", F.lit(1).cast("long")).unionByName(zeros)


def item_popularity_all(silver: DataFrame, window_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """Popularity of every item on every day, those of zero as one row per day."""
    return _with_zeros(silver, item_popularity(silver, window_days))


def top_sellers(
    silver: DataFrame, quantile: float = TOP_SELLER_QUANTILE, method: Method = "disc"
) -> DataFrame:
    """Popularity, threshold and flag per item and day; items of zero popularity, which are
    top sellers exactly on days whose threshold is zero, share one row per day."""
    return _with_flag(
        item_popularity_all(silver), _thresholds_above_zero(silver, quantile, method)
    ).select(*ITEM_KEY, "items", "item_transactions_30d", "top_10_threshold", "is_top_seller")


def cart_day_popularity(
    silver: DataFrame, quantile: float = TOP_SELLER_QUANTILE, method: Method = "disc"
) -> DataFrame:
    """Popularity and flag for the item-days on which a cart event happened.

    Sales and cart additions are counted per item and day first, so the rolling
    sum sees at most one row per calendar day of an item.
    """
    if "event" in silver.columns:  # without stored counts: views are not read here
        daily = item_day_counts(silver.filter(F.col("event").isin(ADD_TO_CART, TRANSACTION)))
    else:
        daily = silver
    rolled = F.sum("sold").over(days_before(LONG_WINDOW_DAYS, 1, by="itemid"))
    popularity = daily.select(
        *ITEM_KEY, "carted", F.coalesce(rolled, F.lit(0)).alias("item_transactions_30d")
    ).filter(F.col("carted") > 0)
    return _with_flag(popularity, _thresholds_above_zero(silver, quantile, method)).select(
        *ITEM_KEY, "item_transactions_30d", "is_top_seller"
    )


def cart_events_with_popularity(
    silver: DataFrame, quantile: float = TOP_SELLER_QUANTILE, method: Method = "disc"
) -> DataFrame:
    """Cart events with the popularity and flag of their item on that day."""
    carts = silver.filter(F.col("event") == ADD_TO_CART).select(
        "visitorid", "itemid", "snapshot_day"
    )
    return carts.join(cart_day_popularity(silver, quantile, method), ITEM_KEY, "left").select(
        "visitorid", *ITEM_KEY, "item_transactions_30d", "is_top_seller"
    )


def visitor_cart_totals(
    silver: DataFrame,
    quantile: float = TOP_SELLER_QUANTILE,
    method: Method = "disc",
    item_days: DataFrame | None = None,
) -> DataFrame:
    """Popularity sum, cart count and top-seller count per visitor-day with carts.

    Repeated additions of an item are counted before the join, and the other
    side has one row per item-day. ``item_days``: stored counts, if there are any.
    """
    source = silver if item_days is None else item_days
    carts = (
        silver.filter(F.col("event") == ADD_TO_CART)
        .groupBy("visitorid", *ITEM_KEY)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = carts.join(cart_day_popularity(source, quantile, method), ITEM_KEY, "left")
    n = F.col("n")
    return joined.groupBy(*KEY).agg(
        F.sum(n * F.col("item_transactions_30d")).alias("cart_item_popularity_sum"),
        F.sum(n).alias("cart_count"),
        F.sum(n * F.col("is_top_seller")).alias("top_seller_cart_count"),
    )


def daily_cart_stats(
    silver: DataFrame,
    snapshots: DataFrame,
    quantile: float = TOP_SELLER_QUANTILE,
    method: Method = "disc",
) -> DataFrame:
    """Cart totals of every snapshot, zero where nothing was added."""
    totals = visitor_cart_totals(silver, quantile, method)
    return snapshots.join(totals, KEY, "left").fillna(
        0, ["cart_item_popularity_sum", "cart_count", "top_seller_cart_count"]
    )


def rolling_cart_features(daily: DataFrame) -> DataFrame:
    """Average popularity and top-seller share of the carts of the last 7 days."""
    frame = days_before(SHORT_WINDOW_DAYS, 1)

    def share(column: str) -> Column:
        ratio = F.try_divide(F.sum(column).over(frame), F.sum("cart_count").over(frame))
        return F.coalesce(ratio, F.lit(0.0))

    return daily.select(
        *KEY,
        share("cart_item_popularity_sum").alias("user_cart_items_avg_popularity_7d"),
        share("top_seller_cart_count").alias("user_cart_top_seller_ratio_7d"),
    )


def build_item_popularity_features(
    silver: DataFrame,
    snapshots: DataFrame,
    quantile: float = TOP_SELLER_QUANTILE,
    method: Method = "disc",
) -> DataFrame:
    """Cart popularity features of every snapshot."""
    return rolling_cart_features(daily_cart_stats(silver, snapshots, quantile, method))
