"""Exploration aggregates over events, visitors, items and sessions."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import bin_order, right_closed_bin
from ..functions.ordered import running_totals
from ..functions.timeline import elapsed_hours
from ..schemas import ADD_TO_CART, EVENT_TYPES, TRANSACTION, VIEW
from .profile import describe_numbers
from .sessions import session_table

# Report percentiles, bin edges and labels.
TAIL_PERCENTILES = (0.5, 0.9, 0.95, 0.99, 0.999)
DURATION_EDGES = [0, 1, 2, 5, 10, 20, 30, 60, 120, math.inf]
DURATION_LABELS = ["0-1", "1-2", "2-5", "5-10", "10-20", "20-30", "30-60", "60-120", ">120"]
RECENCY_EDGES = [0, 1, 6, 12, 24, 48, 72, 24 * 7, 24 * 14, 24 * 30, math.inf]
RECENCY_LABELS = [
    "<1h", "1-6h", "6-12h", "12-24h", "1-2d", "2-3d", "3-7d", "1-2w", "2-4w", ">30d",
]
WEEKDAYS = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]


def _event_counts(events: DataFrame, *keys) -> DataFrame:
    return events.groupBy(*keys).agg(
        *[F.count_if(F.col("event") == name).alias(name) for name in EVENT_TYPES]
    )


def visitor_event_counts(events: DataFrame) -> DataFrame:
    """Counts per visitor and event type, zero-filled."""
    return _event_counts(events, "visitorid")


def item_event_counts(events: DataFrame) -> DataFrame:
    """Counts per item and event type, zero-filled."""
    return _event_counts(events, "itemid")


def describe_tail(counts: DataFrame, columns: Sequence[str] = tuple(EVENT_TYPES)) -> DataFrame:
    """Description with high percentiles, one row per count column."""
    return describe_numbers(counts, columns, TAIL_PERCENTILES)


def event_ratios(events: DataFrame) -> DataFrame:
    """Transactions per view, carts per view and transactions per cart, in percent."""
    totals = events.agg(
        *[F.count_if(F.col("event") == name).alias(name) for name in EVENT_TYPES]
    )

    def percent(part: str, whole: str):
        return F.try_divide(F.col(part) * 100.0, F.col(whole))

    return totals.select(
        percent(TRANSACTION, VIEW).alias("view_to_transaction_pct"),
        percent(ADD_TO_CART, VIEW).alias("view_to_cart_pct"),
        percent(TRANSACTION, ADD_TO_CART).alias("cart_to_transaction_pct"),
    )


def pareto_analysis(df: DataFrame, entity_col: str, value_col: str, entity_name: str) -> DataFrame:
    """Cumulative share of value and of entities, largest value first.

    Entities of equal value are ordered by their id.
    """
    value, share = f"cum_{value_col}", f"cum_{value_col}_pct"
    ranked = running_totals(
        df.select(entity_col, value_col),
        order=[F.desc(value_col), F.asc(entity_col)],
        sums={value: F.col(value_col)},
        rank="rank",
        totals=True,
    )
    return ranked.select(
        entity_col,
        value_col,
        "rank",
        value,
        F.try_divide(F.col(value), F.col(f"{value}_total")).alias(share),
        (F.col("rank") / F.col("rank_total")).alias(f"cum_{entity_name}_pct"),
    )


def pareto_point(
    pareto: DataFrame, value_col: str, entity_name: str, threshold: float
) -> DataFrame:
    """First row whose cumulative value share reaches the threshold."""
    share = f"cum_{value_col}_pct"
    return (
        pareto.filter(F.col(share) >= threshold)
        .orderBy("rank")
        .limit(1)
        .select(share, f"cum_{entity_name}_pct")
    )


def top_entities(
    counts: DataFrame, entity_col: str, by: str = TRANSACTION, n: int = 30
) -> DataFrame:
    """The n entities with the largest count; ties by id."""
    return counts.orderBy(F.desc(by), F.asc(entity_col)).limit(n)


def monthly_events(
    events: DataFrame, ts_col: str = "event_time", leave_out: Sequence[str] = ()
) -> DataFrame:
    """Rows per month and event type, optionally without some event types."""
    rows = events.filter(~F.col("event").isin(*leave_out)) if leave_out else events
    return rows.groupBy(F.date_format(ts_col, "yyyy-MM").alias("month"), "event").agg(
        F.count(F.lit(1)).alias("count")
    )


def daily_transactions(
    events: DataFrame, ts_col: str = "event_time", before: dt.date | None = None
) -> DataFrame:
    """Transactions per day, optionally only days before a date."""
    rows = events.filter(F.col("event") == TRANSACTION)
    if before is not None:
        rows = rows.filter(F.to_date(ts_col) < F.lit(before))
    return rows.groupBy(F.to_date(ts_col).alias("date")).agg(
        F.count(F.lit(1)).alias("transactions")
    )


def weekday_events(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Counts per weekday and event type, Monday first."""
    number = F.weekday(F.to_date(ts_col))
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return (
        _event_counts(events, number.alias("weekday_no"))
        .withColumn("weekday", F.element_at(names, F.col("weekday_no") + 1))
        .select("weekday_no", "weekday", *EVENT_TYPES)
        .orderBy("weekday_no")
    )


def hourly_events(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Counts per hour of the day and event type."""
    return _event_counts(events, F.hour(ts_col).alias("hour")).orderBy("hour")


def build_funnel(counts: DataFrame, entity_name: str) -> DataFrame:
    """Entities with at least one view, cart addition and transaction."""
    # Stage names.
    stages = [("View", VIEW), ("Add to Cart", ADD_TO_CART), ("Transaction", TRANSACTION)]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage_no"),
                F.lit(stage).alias("stage"),
                F.count_if(F.col(c) > 0).alias(entity_name),
            )
            for i, (stage, c) in enumerate(stages, 1)
        ]
    )
    return counts.agg(rows.alias("rows")).select(F.inline("rows"))


def compute_conversion_rates(funnel: DataFrame, count_col: str) -> DataFrame:
    """Percent of entities passing from one stage to a later one."""
    # Transition names.
    transitions = [
        ("View → Add to Cart", 1, 2),
        ("Add to Cart → Transaction", 2, 3),
        ("View → Transaction", 1, 3),
    ]
    at = {
        i: F.max(F.when(F.col("stage_no") == i, F.col(count_col))).cast("double") for i in (1, 2, 3)
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("transition"),
                F.try_divide(at[end] * 100, at[start]).alias("conversion_rate"),
            )
            for name, start, end in transitions
        ]
    )
    return funnel.agg(rows.alias("rows")).select(F.inline("rows"))


def session_summary(
    events: DataFrame, timeout_minutes: float = 30, ts_col: str = "event_time"
) -> DataFrame:
    """Start, end, events, transactions, exact duration and a purchase flag per session."""
    sessions = session_table(events, timeout_minutes, ts_col=ts_col, whole_seconds=False)
    return sessions.select(
        "visitorid",
        "session_id",
        F.col("session_start").alias("start"),
        F.col("session_end").alias("end"),
        "events",
        "transactions",
        F.col("session_duration_min").alias("duration_minutes"),
        (F.col("transactions") > 0).alias("has_transaction"),
    )


def conversion_summary(
    df: DataFrame,
    value_col: str,
    converted_col: str,
    edges: Sequence[float],
    labels: Sequence[str],
    entity_name: str,
    converted_name: str = "transactions",
) -> DataFrame:
    """Entities, conversions, rate and share per interval of a value.

    Values outside the intervals are left out, and so are empty intervals.
    """
    per_bin = (
        df.select(
            right_closed_bin(F.col(value_col), edges, labels).alias("bin"),
            F.col(converted_col).cast("int").alias("_converted"),
        )
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias(entity_name), F.sum("_converted").alias(converted_name)
        )
    )
    # One row per label at most.
    total = F.sum(entity_name).over(Window.partitionBy(F.lit(0)))
    return per_bin.select(
        "bin",
        entity_name,
        converted_name,
        F.bround(F.col(converted_name) / F.col(entity_name) * 100, 2).alias("conversion_rate_pct"),
        F.bround(F.col(entity_name) / total * 100, 2).alias("share_pct"),
    ).orderBy(bin_order(F.col("bin"), labels))


def visitor_recency(
    events: DataFrame, ts_col: str = "event_time", only: str | None = None
) -> DataFrame:
    """Hours from each visitor's last event to the last event of the data.

    With ``only`` the visitor's last event of that type is taken; the reference
    point stays the last event of any type.
    """
    latest = events.agg(F.max(ts_col)).scalar()
    rows = events.filter(F.col("event") == only) if only else events
    name = "hours_since_last_purchase" if only == TRANSACTION else "hours_since_last_event"
    return (
        rows.groupBy("visitorid")
        .agg(F.max(ts_col).alias("_last"))
        .select("visitorid", elapsed_hours(F.col("_last"), latest).alias(name))
    )


def purchase_recency(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    return visitor_recency(events, ts_col, only=TRANSACTION)


def visitor_recency_transactions(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Recency, transactions and purchase flag per visitor.

    Recency and counts have the same key, so one aggregate yields both.
    """
    latest = events.agg(F.max(ts_col)).scalar()
    per_visitor = events.groupBy("visitorid").agg(
        F.max(ts_col).alias("_last"),
        F.count_if(F.col("event") == TRANSACTION).alias(TRANSACTION),
    )
    return per_visitor.select(
        "visitorid",
        elapsed_hours(F.col("_last"), latest).alias("hours_since_last_event"),
        TRANSACTION,
        (F.col(TRANSACTION) > 0).alias("has_transaction"),
    )


def recency_conversion(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    return conversion_summary(
        visitor_recency_transactions(events, ts_col),
        "hours_since_last_event",
        "has_transaction",
        RECENCY_EDGES,
        RECENCY_LABELS,
        "visitors",
        "purchasers",
    )


def recency_transactions(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Visitors, transactions and their ratio per recency interval."""
    hours = F.col("hours_since_last_event")
    return (
        visitor_recency_transactions(events, ts_col)
        .select(right_closed_bin(hours, RECENCY_EDGES, RECENCY_LABELS).alias("bin"), TRANSACTION)
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("visitors"), F.sum(TRANSACTION).alias("transactions"))
        .withColumn("transactions_per_visitor", F.col("transactions") / F.col("visitors"))
        .orderBy(bin_order(F.col("bin"), RECENCY_LABELS))
    )
