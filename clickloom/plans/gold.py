"""Gold: all features of every visitor-day in one linear plan.

Silver is read three times: for its counts per item and day, which are stored and
answer all that depends on items and days only, for activity slots (one shuffle with
a combine before it), and for carts. A single shuffle by visitor then carries
sessions, daily sums, both rolling windows and the label without another exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import materialise
from ..functions.timeline import MICROS_PER_MINUTE, MICROS_PER_SECOND, epoch_micros
from ..operators.behavior import build_user_behavior
from ..operators.popularity import (
    Method,
    build_item_popularity_features,
    item_day_counts,
    visitor_cart_totals,
)
from ..operators.sessions import activity_slots, build_session_features
from ..operators.snapshots import KEY, require_rows, silver_totals
from ..schemas import (
    LONG_WINDOW_DAYS,
    MODEL_FEATURES,
    SESSION_TIMEOUT_MINUTES,
    SHORT_WINDOW_DAYS,
    TOP_SELLER_QUANTILE,
)

_SUMS = ["views", "addtocarts", "transactions", "popularity", "top_sellers"]
_DAILY = [*_SUMS, "duration", "sessions"]


def _frame(days: int) -> str:
    return (
        "OVER (PARTITION BY visitorid ORDER BY snapshot_day "
        f"RANGE BETWEEN {days} PRECEDING AND 1 PRECEDING)"
    )


def build_gold(
    silver: DataFrame,
    *,
    method: Method = "disc",
    quantile: float = TOP_SELLER_QUANTILE,
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
    whole_seconds: bool = True,
    inference_day: bool = True,
    label_days: int | None = None,
) -> DataFrame:
    """Features per visitor-day of silver that carries ``snapshot_day``.

    With ``inference_day`` every visitor also gets the day after the last one. With
    ``label_days`` the label ``purchase_next_<n>d`` is added: 1 if a purchase falls on day D
    to D + n - 1.
    """
    item_days = materialise(item_day_counts(silver))
    require_rows(item_days)
    slots = activity_slots(silver, timeout_minutes).selectExpr(
        "visitorid", "day AS snapshot_day", "0 AS kind", "first_time", "last_time",
        "views", "addtocarts", "transactions", "0L AS popularity", "0L AS top_sellers",
    )
    time_type = silver.schema["event_time"].dataType.simpleString()
    carts = visitor_cart_totals(silver, quantile, method, item_days).selectExpr(
        "visitorid", "snapshot_day", "1 AS kind",
        f"CAST(NULL AS {time_type}) AS first_time", f"CAST(NULL AS {time_type}) AS last_time",
        "0L AS views", "0L AS addtocarts", "0L AS transactions",
        "cart_item_popularity_sum AS popularity", "top_seller_cart_count AS top_sellers",
    )
    # The only shuffle by visitor. Windows and aggregates below have keys that
    # start with the visitor, so they keep this partitioning.
    rows = slots.unionAll(carts).repartition("visitorid")
    unit = MICROS_PER_SECOND if whole_seconds else 1
    activity = _with_session_starts(rows, timeout_minutes, unit)
    daily = activity.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in _DAILY], F.bool_or("is_last").alias("is_last")
    )
    if inference_day:
        daily = _with_inference_day(daily, item_days)

    short, long = _frame(SHORT_WINDOW_DAYS), _frame(LONG_WINDOW_DAYS)
    rolled = daily.selectExpr(
        *KEY,
        f"sum(views) {short} AS views",
        f"sum(addtocarts) {short} AS carts",
        f"sum(transactions) {long} AS transactions",
        f"sum(sessions) {long} AS sessions",
        f"sum(duration) {long} AS duration",
        f"sum(popularity) {short} AS popularity",
        f"sum(top_sellers) {short} AS top_sellers",
        *_label(label_days),
    )
    per_minute = 60 * MICROS_PER_SECOND // unit
    return rolled.selectExpr(
        *KEY,
        "coalesce(views, 0L) AS user_views_7d",
        "coalesce(carts, 0L) AS user_addtocart_7d",
        "coalesce(transactions, 0L) AS user_transactions_30d",
        "coalesce(sessions, 0L) AS user_sessions_30d",
        f"coalesce(try_divide(duration / {per_minute}.0D, sessions), 0D)"
        " AS avg_session_duration_30d",
        "coalesce(try_divide(popularity, carts), 0D) AS user_cart_items_avg_popularity_7d",
        "coalesce(try_divide(top_sellers, carts), 0D) AS user_cart_top_seller_ratio_7d",
        *([f"purchase_next_{label_days}d"] if label_days else []),
    )


def _label(days: int | None) -> list[str]:
    """The forward window over the daily sums, which are in the right place already."""
    if not days:
        return []
    ahead = (
        "OVER (PARTITION BY visitorid ORDER BY snapshot_day "
        f"RANGE BETWEEN CURRENT ROW AND {days - 1} FOLLOWING)"
    )
    bought = "CAST(CAST(transactions > 0 AS INT) AS BYTE)"
    return [f"max({bought}) {ahead} AS purchase_next_{days}d"]


def _with_session_starts(rows: DataFrame, timeout_minutes: float, unit: int) -> DataFrame:
    """Put ``sessions`` = 1 and the length of the session on the slot that starts it.

    The end of a session is known at the first slot of the next one, or at the
    visitor's last slot. Looking ahead to the nearest such slot needs the time
    order only, so all windows here share one sort. Lengths are whole numbers of
    ``unit`` microseconds, which add up to the same sum in any order.
    """
    in_time = "OVER (PARTITION BY visitorid, kind ORDER BY first_us)"
    limit = int(timeout_minutes * MICROS_PER_MINUTE)
    starts = f"kind = 0 AND coalesce(first_us - _previous > {limit}L, true)"
    return (
        rows.withColumns(
            {"first_us": epoch_micros("first_time"), "last_us": epoch_micros("last_time")}
        )
        .selectExpr(
            *KEY, "kind", *_SUMS, "first_us", "last_us",
            f"lag(last_us) {in_time} AS _previous",
            f"kind = 0 AND lead(first_us) {in_time} IS NULL AS is_last",
        )
        .selectExpr("*", f"{starts} AS starts")
        .selectExpr("*", "CASE WHEN starts THEN _previous WHEN is_last THEN last_us END AS _end")
        .selectExpr(
            *KEY, *_SUMS, "is_last", "starts", "first_us",
            f"coalesce(lead(_end) IGNORE NULLS {in_time}, last_us) AS _session_end",
        )
        .selectExpr(
            *KEY, *_SUMS, "is_last",
            f"IF(starts, (_session_end - first_us) div {unit}, 0L) AS duration",
            "IF(starts, 1L, 0L) AS sessions",
        )
    )


def _with_inference_day(daily: DataFrame, silver: DataFrame) -> DataFrame:
    """Give each visitor's last day a second, empty row on the inference day."""
    own = f"struct(snapshot_day, {', '.join(_DAILY)})"
    ahead = f"struct(_ahead AS snapshot_day, {', '.join(f'0L AS {c}' for c in _DAILY)})"
    inference = (silver_totals(silver)["last_day"] + 1).cast("int")
    return daily.withColumn("_ahead", inference).selectExpr(
        "visitorid", f"inline(IF(is_last, array({own}, {ahead}), array({own})))"
    )


def join_features(
    behavior: DataFrame, sessions: DataFrame, popularity: DataFrame
) -> DataFrame:
    """Gold from three separately built feature frames."""
    return (
        behavior.join(sessions, KEY, "left")
        .join(popularity, KEY, "left")
        .select(*KEY, *MODEL_FEATURES)
    )


def build_gold_by_parts(silver: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The same result through the single-feature operators."""
    return join_features(
        build_user_behavior(silver, snapshots),
        build_session_features(silver, snapshots),
        build_item_popularity_features(silver, snapshots),
    )


def build_training_frame(
    silver: DataFrame,
    *,
    target_days: int = 7,
    method: Method = "linear",
    whole_seconds: bool = False,
) -> DataFrame:
    """Features of every visitor-day over the full history, and the label."""
    return build_gold(
        silver,
        method=method,
        whole_seconds=whole_seconds,
        inference_day=False,
        label_days=target_days,
    )
