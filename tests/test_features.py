import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators import behavior, popularity, snapshots, target
from clickloom.plans import gold
from clickloom.schemas import GOLD, MODEL_FEATURES
from clickloom.sources import star_schema
from frames import rows

D = 86400
SF = "/root/testdata/sf0.001"


def with_day(df):
    return snapshots.add_snapshot_day(df)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return with_day(star_schema.click_events(spark, SF)).checkpoint()


def test_frames_exclude_today_and_day_eight(make_events, day0):
    silver = with_day(make_events([(d * D, 1, "view", 1, None) for d in (0, 1, 7, 8)]))
    features = behavior.build_user_behavior(silver, snapshots.build_snapshot_dates(silver))
    views = {r.snapshot_day - day0: r.user_views_7d for r in features.collect()}
    assert views == {0: 0, 1: 1, 7: 2, 8: 2, 9: 2}


def test_inference_day_for_every_visitor(make_events, day0):
    silver = with_day(
        make_events([(2 * D, 1, "view", 1, None), (10 * D, 2, "view", 1, None)])
    )
    expected = [(1, day0 + 2), (1, day0 + 11), (2, day0 + 10), (2, day0 + 11)]
    assert rows(snapshots.build_snapshot_dates(silver)) == expected
    assert rows(gold.build_gold(silver), "visitorid", "snapshot_day") == expected


def grid_popularity(silver):
    frame = Window.partitionBy("itemid").orderBy("snapshot_day").rangeBetween(-30, -1)
    return popularity.item_day_grid(silver).select(
        "itemid",
        "snapshot_day",
        F.coalesce(F.sum("transactions").over(frame), F.lit(0)).alias("p"),
    )


@pytest.mark.parametrize("max_item", [3, 5, 30, 1000])
@pytest.mark.parametrize("method", ["disc", "linear"])
def test_sparse_threshold_equals_grid(spark, max_item, method):
    """Also where nearly all items never sell and the threshold is zero."""
    events = with_day(star_schema.click_events(spark, "/root/testdata/sf0.01"))
    silver = events.filter(
        ((F.col("event") != "transaction") | (F.col("itemid") < max_item))
        & ~F.col("snapshot_day").isin(19730, 19731, 19740)
    )
    grid = grid_popularity(silver)
    exact = "percentile_approx(p, 0.9)" if method == "disc" else "percentile(p, 0.9)"
    want = grid.groupBy("snapshot_day").agg(F.expr(exact).cast("double").alias("t"))
    got = popularity.top_seller_threshold(silver, method=method)
    assert [(d, round(t, 9)) for d, t in rows(got)] == [(d, round(t, 9)) for d, t in rows(want)]
    sparse = popularity.item_popularity(silver)
    assert rows(sparse) == rows(grid.filter("p > 0"))


def test_zero_threshold_makes_every_item_a_top_seller(make_events, day0):
    rows_ = [(0, 1, "view", i, None) for i in range(20)]
    rows_ += [(0, 1, "transaction", 1, 100), (D, 1, "addtocart", 7, None)]
    silver = with_day(make_events(rows_))
    (cart,) = popularity.cart_events_with_popularity(silver).collect()
    assert (cart.item_transactions_30d, cart.is_top_seller) == (0, 1)


def test_disc_and_linear_quantile(make_events, day0):
    """Nine items without sales and one with five."""
    rows_ = [(0, 1, "view", i, None) for i in range(10)]
    rows_ += [(k, 2, "transaction", 0, k) for k in range(1, 6)] + [(D, 1, "view", 0, None)]
    silver = with_day(make_events(rows_))
    on_day_one = F.col("snapshot_day") == day0 + 1
    disc = popularity.top_seller_threshold(silver).filter(on_day_one).first()
    linear = popularity.top_seller_threshold(silver, method="linear").filter(on_day_one).first()
    assert disc.top_10_threshold == 0.0
    assert linear.top_10_threshold == pytest.approx(0.5)
    with pytest.raises(ValueError):
        popularity.top_seller_threshold(silver, method="other")


def test_popularity_window_edges(make_events, day0):
    """A sale counts from the day after it for thirty days."""
    rows_ = [(0, 1, "transaction", 1, 9)] + [
        (d * D, 1, "addtocart", 1, None) for d in (0, 1, 30, 31)
    ]
    silver = with_day(make_events(rows_))
    carts = popularity.cart_events_with_popularity(silver)
    assert {r.snapshot_day - day0: r.item_transactions_30d for r in carts.collect()} == {
        0: 0, 1: 1, 30: 1, 31: 0,
    }


def test_no_carts_give_zero_features(make_events):
    silver = with_day(make_events([(0, 1, "view", 1, None)]))
    for row in gold.build_gold(silver).collect():
        assert row.user_cart_items_avg_popularity_7d == 0.0
        assert row.user_cart_top_seller_ratio_7d == 0.0


@pytest.mark.parametrize("copies", [1, 50])
def test_gold_equals_its_parts(spark, silver, copies):
    """Also when one visitor and one item hold most of the rows."""
    hot = silver.filter("visitorid = 3 AND event <> 'transaction'").withColumn(
        "itemid", F.lit(5).cast("long")
    )
    data = silver
    if copies > 1:
        shifted = hot.crossJoin(spark.range(1, copies)).select(
            (F.col("event_time") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("event_time"),
            *[c for c in silver.columns if c not in ("event_time", "snapshot_day")],
        )
        data = silver.unionByName(with_day(shifted))
    fused = gold.build_gold(data)
    parts = gold.build_gold_by_parts(data, snapshots.build_snapshot_dates(data))
    key = ["visitorid", "snapshot_day", *MODEL_FEATURES]

    def rounded(df):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df, *key)]

    assert rounded(fused) == rounded(parts)


def test_gold_schema_and_invariants(silver):
    result = gold.build_gold(silver)
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in GOLD
    ]
    snaps = snapshots.build_snapshot_dates(silver)
    assert result.count() == snaps.count() == snaps.distinct().count()
    bad = result.filter(
        "user_cart_top_seller_ratio_7d NOT BETWEEN 0 AND 1 OR avg_session_duration_30d < 0"
    )
    assert bad.count() == 0


def test_gold_plan_has_one_shuffle_by_visitor_and_no_nested_loop(silver):
    plan = plan_of(gold.build_gold(silver))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    by_visitor = [x for x in plan.splitlines() if "Exchange hashpartitioning(visitorid" in x]
    # slots, carts per item and day, cart totals; then one exchange by visitor alone
    assert sum("REPARTITION_BY_COL" in x for x in by_visitor) == 1
    assert len(by_visitor) == 4


def test_later_events_never_change_features(silver, day0):
    """Features of day D see days before D only. Sessions that cross midnight are
    the known exception, so durations are compared for the other visitors."""
    cut = day0 + 15
    before = silver.filter(F.col("snapshot_day") <= cut)
    changed = silver.filter(F.col("snapshot_day") < cut).unionByName(
        silver.filter(F.col("snapshot_day") == cut).withColumn("event", F.lit("addtocart"))
    )
    free = [c for c in MODEL_FEATURES if c != "avg_session_duration_30d"]
    # The item universe behind the threshold is global, so keep it the same.
    a = gold.build_gold(before, inference_day=False).filter(F.col("snapshot_day") <= cut)
    b = gold.build_gold(changed, inference_day=False).filter(F.col("snapshot_day") <= cut)
    assert rows(a, "visitorid", "snapshot_day", *free) == rows(
        b, "visitorid", "snapshot_day", *free
    )


def test_session_across_midnight_is_the_known_leak(make_events, day0):
    early = make_events([(D - 60, 1, "view", 1, None), (2 * D, 1, "view", 1, None)])
    late = make_events(
        [(D - 60, 1, "view", 1, None), (D + 60, 1, "view", 1, None), (2 * D, 1, "view", 1, None)]
    )
    on_day_one = F.col("snapshot_day") == day0 + 1
    assert gold.build_gold(with_day(early)).filter(on_day_one).count() == 0
    (row,) = gold.build_gold(with_day(late)).filter(on_day_one).collect()
    assert row.avg_session_duration_30d == 2.0


def test_purchase_target_window(spark, day0):
    days = spark.createDataFrame(
        [(1, d) for d in (3, 4, 10, 11)] + [(2, 4)], "visitorid long, snapshot_day int"
    ).withColumn("extra", F.lit("kept"))
    bought = spark.createDataFrame([(1, 10)], "visitorid long, snapshot_day int")
    result = target.create_purchase_target(days, bought, 7)
    assert result.columns == ["visitorid", "snapshot_day", "extra", "purchase_next_7d"]
    assert rows(result, "visitorid", "snapshot_day", "purchase_next_7d") == [
        (1, 10, 1), (1, 11, 0), (1, 3, 0), (1, 4, 1), (2, 4, 0),
    ]


def test_zoned_timestamps_give_the_same_features(spark, silver):
    zoned = silver.withColumn("event_time", F.col("event_time").cast("timestamp"))
    columns = ["visitorid", "snapshot_day", *MODEL_FEATURES]
    assert rows(gold.build_gold(zoned), *columns) == rows(gold.build_gold(silver), *columns)
