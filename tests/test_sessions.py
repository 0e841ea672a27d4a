import pytest
from pyspark.sql import functions as F

from clickloom.operators import sessions, snapshots
from frames import rows

MIN = 60
GAPS = [
    (0, 1, "view", 1, None),
    (30 * MIN, 1, "view", 1, None),
    (60 * MIN + 1e-6, 1, "view", 1, None),
    (60 * MIN + 1.5, 1, "view", 1, None),
]


def test_gap_of_exactly_the_timeout_keeps_the_session(make_events):
    events = make_events(GAPS)
    by_slot = sessions.create_sessions(events, ts_col="event_time")
    by_event = sessions.add_session_id(sessions.add_session_boundaries(events))
    expected = [1, 1, 2, 2]
    for result in (by_slot, by_event):
        assert [r.session_id for r in result.orderBy("event_time").collect()] == expected


def test_sessions_need_visitor_and_time_only(spark, make_events):
    bare = make_events(GAPS).selectExpr("visitorid AS who", "event_time AS timestamp")
    found = sessions.create_sessions(bare, visitor_col="who").orderBy("timestamp")
    assert found.columns == ["who", "timestamp", "session_id"]
    assert [r.session_id for r in found.collect()] == [1, 1, 2, 2]


def test_whole_second_and_exact_duration(make_events):
    one = make_events([GAPS[0], (60 * MIN + 1.5, 1, "view", 1, None)])
    whole = sessions.session_table(one, timeout_minutes=120).first()
    exact = sessions.session_table(one, timeout_minutes=120, whole_seconds=False).first()
    assert whole.session_duration_min == 3601 / 60
    assert exact.session_duration_min == pytest.approx(3601.5 / 60, abs=1e-12)


@pytest.mark.parametrize("timeout", [1, 7, 30, 45, 1000])
def test_slots_equal_plain_windows(spark, make_events, timeout):
    """Collapsed slots give the sessions of the event-by-event definition."""
    base = spark.range(4000).select(
        (F.lit("2024-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(secs=(F.rand(3) * 400_000).cast("decimal(18,6)"))).alias("event_time"),
        F.when(F.rand(5) < 0.5, 1).otherwise((F.rand(7) * 30).cast("long")).cast("long").alias("visitorid"),
        F.lit("view").alias("event"),
    ).checkpoint()
    w = "PARTITION BY visitorid ORDER BY event_time"
    base.createOrReplaceTempView("plain")
    plain = spark.sql(f"""
      SELECT event_time, visitorid, sum(fresh) OVER ({w} RANGE UNBOUNDED PRECEDING) AS session_id
      FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER ({w})
              <= INTERVAL {timeout} MINUTES THEN 0 ELSE 1 END AS fresh FROM plain)""")
    by_slot = sessions.create_sessions(base, ts_col="event_time", timeout_minutes=timeout)
    by_event = sessions.add_session_id(
        sessions.add_session_boundaries(base, timeout_minutes=timeout)
    )
    want = rows(plain)
    assert rows(by_slot, "event_time", "visitorid", "session_id") == want
    assert rows(by_event, "event_time", "visitorid", "session_id") == want


def test_session_belongs_to_its_start_day(make_events, day0):
    night = make_events(
        [(86400 - 60, 1, "view", 1, None), (86400 + 60, 1, "view", 1, None)]
    )
    daily = sessions.build_daily_session_stats(sessions.session_table(night))
    assert rows(daily) == [(1, day0, 2.0, 1)]


def test_rolling_average_without_sessions_is_zero(spark, day0):
    snaps = spark.createDataFrame([(1, day0), (1, day0 + 1)], "visitorid long, snapshot_day int")
    daily = spark.createDataFrame(
        [(1, day0, 4.0, 2)],
        "visitorid long, snapshot_day int, total_duration double, sessions long",
    )
    aligned = sessions.align_session_stats_with_snapshots(daily, snaps)
    assert rows(sessions.build_rolling_session_features(aligned)) == [
        (1, day0, 0, 0.0),
        (1, day0 + 1, 2, 2.0),
    ]


def test_hot_visitor_is_collapsed_before_the_shuffle(spark):
    """The ordered step of one visitor holds slots, not events."""
    events = spark.range(200_000).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id / 10) AS event_time",
        "1L AS visitorid",
        "'view' AS event",
    )
    slots = sessions.activity_slots(events)
    assert slots.count() <= 48
    assert slots.agg(F.sum("events")).first()[0] == 200_000


def test_empty_silver_is_refused(make_events):
    with pytest.raises(ValueError, match="empty"):
        snapshots.build_snapshot_dates(snapshots.add_snapshot_day(make_events([])))
