"""Inactivity sessions.

Two events of one visitor inside the same stretch of time no longer than the
timeout cannot be separated by a session boundary. Events are therefore first
collapsed to one row per visitor, day and timeout-long slot, a hash aggregate
that combines before the shuffle. The ordered step then sees at most 48 rows per
visitor and day however many events a visitor has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeline import (
    MICROS_PER_MINUTE,
    day_index,
    elapsed_minutes,
    epoch_micros,
)
from ..schemas import (
    ADD_TO_CART,
    LONG_WINDOW_DAYS,
    SESSION_TIMEOUT_MINUTES,
    TRANSACTION,
    VIEW,
)
from .snapshots import KEY, days_before

_PIECE = "_piece"


def _slot(ts_col: str, minutes: float) -> Column:
    return F.floor(epoch_micros(ts_col) / F.lit(minutes * MICROS_PER_MINUTE))


def activity_slots(
    events: DataFrame,
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
    visitor_col: str = "visitorid",
    ts_col: str = "event_time",
    counts: bool = True,
) -> DataFrame:
    """First and last event per visitor, day and slot, with event counts or without."""
    per_event = {
        "events": "count(1)",
        "views": f"count_if(event = '{VIEW}')",
        "addtocarts": f"count_if(event = '{ADD_TO_CART}')",
        "transactions": f"count_if(event = '{TRANSACTION}')",
    }
    return events.groupBy(
        F.col(visitor_col).alias("visitorid"),
        day_index(ts_col).alias("day"),
        _slot(ts_col, timeout_minutes).alias("slot"),
    ).agg(
        F.min(ts_col).alias("first_time"),
        F.max(ts_col).alias("last_time"),
        *[F.expr(f"{e} AS {name}") for name, e in per_event.items() if counts],
    )


def number_sessions(
    slots: DataFrame,
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
    by: tuple[str, ...] = ("visitorid",),
) -> DataFrame:
    """Add ``first_us``, ``last_us``, ``new_session`` and ``session_id`` to slots."""
    in_time = f"PARTITION BY {', '.join(by)} ORDER BY first_us"
    limit = int(timeout_minutes * MICROS_PER_MINUTE)
    gap = f"first_us - lag(last_us) OVER ({in_time})"
    return (
        slots.withColumns(
            {"first_us": epoch_micros("first_time"), "last_us": epoch_micros("last_time")}
        )
        .selectExpr("*", f"IF({gap} <= {limit}L, 0, 1) AS new_session")
        .selectExpr(
            "*",
            f"sum(new_session) OVER ({in_time} ROWS UNBOUNDED PRECEDING) AS session_id",
        )
    )


def session_table(
    events: DataFrame,
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
    visitor_col: str = "visitorid",
    ts_col: str = "event_time",
    whole_seconds: bool = True,
) -> DataFrame:
    """One row per session: start, end, events, transactions and duration."""
    slots = number_sessions(
        activity_slots(events, timeout_minutes, visitor_col, ts_col), timeout_minutes
    )
    return (
        slots.groupBy("visitorid", "session_id")
        .agg(
            F.min("first_time").alias("session_start"),
            F.max("last_time").alias("session_end"),
            F.sum("events").alias("events"),
            F.sum("transactions").alias("transactions"),
        )
        .withColumn("session_duration_min", _duration(whole_seconds))
        .withColumnRenamed("visitorid", visitor_col)
    )


def _duration(whole_seconds: bool) -> Column:
    return elapsed_minutes(
        epoch_micros("session_start"), epoch_micros("session_end"), whole_seconds
    )


def add_session_boundaries(
    events: DataFrame,
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
    visitor_col: str = "visitorid",
    ts_col: str = "event_time",
) -> DataFrame:
    """Add the previous event time, the gap and the new-session flag to events.

    The ordered step runs inside one-minute pieces of a visitor's history; the
    first event of a piece looks at the last event of the piece before it. Events
    of one time are ordered by type, item and transaction, so the flag does not
    depend on how the rows arrive.
    """
    ties = [c for c in ("event", "itemid", "transactionid") if c in events.columns]
    pieces = events.withColumn(_PIECE, _slot(ts_col, 1))
    inside = Window.partitionBy(visitor_col, _PIECE).orderBy(ts_col, *ties)
    across = Window.partitionBy(visitor_col).orderBy(_PIECE)
    last_before = (
        pieces.groupBy(visitor_col, _PIECE)
        .agg(F.max(ts_col).alias("_last"))
        .select(visitor_col, _PIECE, F.lag("_last").over(across).alias("_before"))
    )
    previous = f"previous_{ts_col}"
    return (
        pieces.withColumn("_inside", F.lag(ts_col).over(inside))
        .join(last_before, [visitor_col, _PIECE], "left")
        .select(
            *[F.col(c) for c in events.columns],
            F.coalesce("_inside", "_before").alias(previous),
        )
        .withColumn("time_diff", F.col(ts_col) - F.col(previous))
        .withColumn(
            "new_session",
            F.when(
                epoch_micros(ts_col) - epoch_micros(previous)
                <= F.lit(int(timeout_minutes * MICROS_PER_MINUTE)),
                0,
            ).otherwise(1),
        )
    )


def add_session_id(
    events: DataFrame, visitor_col: str = "visitorid", ts_col: str = "event_time"
) -> DataFrame:
    """Running number of ``new_session`` flags per visitor, ties sharing one number."""
    pieces = events.withColumn(_PIECE, _slot(ts_col, 1))
    inside = (
        Window.partitionBy(visitor_col, _PIECE)
        .orderBy(ts_col)
        .rangeBetween(Window.unboundedPreceding, 0)
    )
    across = (
        Window.partitionBy(visitor_col)
        .orderBy(_PIECE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    started_before = (
        pieces.groupBy(visitor_col, _PIECE)
        .agg(F.sum("new_session").alias("_n"))
        .select(
            visitor_col, _PIECE, F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before")
        )
    )
    return (
        pieces.withColumn("_inside", F.sum("new_session").over(inside))
        .join(started_before, [visitor_col, _PIECE], "left")
        .select(
            *[F.col(c) for c in events.columns],
            (F.col("_inside") + F.col("_before")).alias("session_id"),
        )
    )


def create_sessions(
    events: DataFrame,
    visitor_col: str = "visitorid",
    ts_col: str = "timestamp",
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
) -> DataFrame:
    """Add ``session_id`` to events, looked up from the numbered slots."""
    numbered = number_sessions(
        activity_slots(events, timeout_minutes, visitor_col, ts_col, counts=False),
        timeout_minutes,
    ).select(
        F.col("visitorid").alias(visitor_col),
        F.col("day").alias("_day"),
        F.col("slot").alias("_slot"),
        "session_id",
    )
    keyed = events.withColumns(
        {"_day": day_index(ts_col), "_slot": _slot(ts_col, timeout_minutes)}
    )
    return keyed.join(numbered, [visitor_col, "_day", "_slot"], "left").select(
        *[F.col(c) for c in events.columns], "session_id"
    )


def aggregate_sessions(
    events: DataFrame, whole_seconds: bool = True, ts_col: str = "event_time"
) -> DataFrame:
    """Start, end and duration of sessions from events that carry a session id."""
    return (
        events.groupBy("visitorid", "session_id")
        .agg(F.min(ts_col).alias("session_start"), F.max(ts_col).alias("session_end"))
        .withColumn("session_duration_min", _duration(whole_seconds))
    )


def build_daily_session_stats(sessions: DataFrame) -> DataFrame:
    """Total duration and number of sessions per visitor and start day."""
    return sessions.groupBy("visitorid", day_index("session_start").alias("snapshot_day")).agg(
        F.sum("session_duration_min").alias("total_duration"),
        F.count("session_id").alias("sessions"),
    )


def align_session_stats_with_snapshots(daily: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row per snapshot, zero where no session started."""
    keys = snapshots.select(*KEY).distinct()
    return keys.join(daily, KEY, "left").fillna({"sessions": 0, "total_duration": 0.0})


def build_rolling_session_features(daily: DataFrame) -> DataFrame:
    """Sessions and their average duration over the last 30 days."""
    frame = days_before(LONG_WINDOW_DAYS, 1)
    rolled = daily.select(
        *KEY,
        F.coalesce(F.sum("sessions").over(frame), F.lit(0)).alias("user_sessions_30d"),
        F.coalesce(F.sum("total_duration").over(frame), F.lit(0.0)).alias("_duration"),
    )
    average = F.try_divide("_duration", "user_sessions_30d")
    return rolled.select(
        *KEY,
        "user_sessions_30d",
        F.coalesce(average, F.lit(0.0)).alias("avg_session_duration_30d"),
    )


def build_session_features(
    silver: DataFrame,
    snapshots: DataFrame,
    timeout_minutes: float = SESSION_TIMEOUT_MINUTES,
    whole_seconds: bool = True,
) -> DataFrame:
    """Rolling session features of every snapshot."""
    sessions = session_table(silver, timeout_minutes, whole_seconds=whole_seconds)
    daily = build_daily_session_stats(sessions)
    return build_rolling_session_features(align_session_stats_with_snapshots(daily, snapshots))
