"""Every operator as a query over the given tables.

``flat`` brings results into a form that hashes the same in both engines: whole
numbers as long, times as epoch microseconds, dates as day numbers, fractions
rounded to six digits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import bins, ordered, probability, storage, timeline
from clickloom.operators import (
    asof,
    behavior,
    catalog,
    evaluate,
    explore,
    newton,
    popularity,
    profile,
    quality,
    score,
    sessions,
    snapshots,
    split,
    target,
    train,
)
from clickloom.plans import batch_job, gold, training
from clickloom.schemas import EVENT_TYPES, MODEL_FEATURES, TARGET
from clickloom.sources import catalog as catalog_files
from clickloom.sources import events as event_files
from clickloom.sources import layers, star_schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = ["visitorid", "snapshot_day"]

# The test tables span 30 days, so cut-offs of 30 days would leave nothing.
FEATURE_DAYS = 10
HISTORY_DAYS = 14
# A fixed linear model, so that scores can be checked in SQL.
WEIGHTS = dict(zip(MODEL_FEATURES, [0.02, 0.15, 0.05, -0.03, 0.01, 0.002, 0.4]))
INTERCEPT = -0.5
SLOPE, OFFSET = 0.8, -0.1
# One member of each search grid, with its fewest trees or rounds.
FORESTS = {"numTrees": 100, "maxDepth": 10, "positive_weight": "balanced"}
BOOSTED = {"maxIter": 100, "maxDepth": 2, "stepSize": 0.1}
CANDIDATES = {
    "Baseline Logistic Regression": train.ModelSpec(*train.BASELINES["Baseline Logistic Regression"]),
    "Baseline Boosted Trees": train.ModelSpec(*train.BASELINES["Baseline Boosted Trees"]),
    "Tuned Logistic Regression": train.ModelSpec("logistic", {"C": 0.1, "positive_weight": 5}),
    "Tuned Histogram Boosting": train.ModelSpec(
        "boosted",
        {"maxIter": 200, "stepSize": 0.1, "maxDepth": 5, "maxLeaves": 15, "positive_weight": 20},
    ),
    "Tuned Random Forest": train.ModelSpec("forest", FORESTS),
    "Tuned Gradient Boosting": train.ModelSpec("boosted", BOOSTED),
    "Tuned Subsampled Boosting": train.ModelSpec(
        "boosted", {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "subsamplingRate": 0.8}
    ),
}
#: Results of trained models, which no SQL over the tables can give. A query beside each, with
#: SQL, checks properties that a scorer which learned nothing would not have.
TRAINED: set[str] = set()


def flat(df: DataFrame) -> DataFrame:
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = timeline.epoch_micros(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.unix_date(c).cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int").cast("long")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return flat(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def trained(name: str) -> Callable[[Query], Query]:
    TRAINED.add(name)
    return query(name)


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.add_snapshot_day(star_schema.click_events(spark, sf_dir))


def counted_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_copies(star_schema.dirty_events(spark, sf_dir))


def training_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_training_frame(silver_of(spark, sf_dir))


def prepared_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active rows inside the bounds, stored because several steps read them."""
    active = storage.materialise(split.interaction_filter(training_of(spark, sf_dir)))
    return split.temporal_boundaries(active, feature_days=FEATURE_DAYS)


def split_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.chronological_split(prepared_of(spark, sf_dir))


def folds_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.materialise(
        split.expanding_folds(split_of(spark, sf_dir).filter(F.col("split") == "train").drop("split"))
    )


def fixed_score(df: DataFrame) -> DataFrame:
    raw = probability.linear_score(WEIGHTS, INTERCEPT)
    return df.withColumn("raw_probability", raw).withColumn(
        score.PROBABILITY, probability.calibrate_probability(raw, SLOPE, OFFSET)
    )


def two_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels scored by two models in long form."""
    fine = star_schema.scored_labels(spark, sf_dir).withColumn("model", F.lit("fine"))
    coarse = star_schema.scored_labels(spark, sf_dir, ties=True).withColumn(
        "model", F.lit("coarse")
    )
    return fine.unionByName(coarse)


# --- ingestion, sources and sinks ------------------------------------------------


@query("i01_read_raw_events")
def _(spark, d):
    path = storage.shared_path(spark, "raw")
    star_schema.raw_events(spark, d).write.parquet(path)
    return event_files.read_raw_events(spark, path)


@query("i02_read_layer")
def _(spark, d):
    path = storage.shared_path(spark, "bronze")
    layers.write_bronze(star_schema.dirty_events(spark, d), path)
    return layers.read_bronze(spark, path)


@query("i03_reference_date")
def _(spark, d):
    raw = star_schema.raw_events(spark, d)
    latest = event_files.get_reference_date(raw)
    return (
        raw.filter(F.to_date("timestamp") == F.lit(latest))
        .groupBy(F.to_date("timestamp").alias("reference_day"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query("i04_feature_window")
def _(spark, d):
    raw = star_schema.raw_events(spark, d)
    return event_files.filter_feature_window(
        raw, event_files.get_reference_date(raw), HISTORY_DAYS
    )


@query("i05_cast_to_bronze")
def _(spark, d):
    return event_files.cast_to_bronze(star_schema.raw_events(spark, d))


@query("i06_write_gold")
def _(spark, d):
    path = storage.shared_path(spark, "gold")
    layers.write_gold(gold.build_gold(silver_of(spark, d)), path, by_day=True)
    return layers.read_gold(spark, path).select(*KEY, *MODEL_FEATURES)


@query("i07_write_silver")
def _(spark, d):
    base = storage.shared_path(spark, "validated")
    layers.write_silver(
        star_schema.dirty_events(spark, d), f"{base}/silver", f"{base}/quarantine"
    )
    good = layers.read_silver(spark, f"{base}/silver")
    bad = layers.read_layer(spark, f"{base}/quarantine")
    return good.withColumn("_dq_error", F.lit(None).cast("string")).unionByName(bad)


@query("i08_convert_events")
def _(spark, d):
    base = storage.shared_path(spark, "log")
    raw = star_schema.raw_events(spark, d)
    raw.withColumn(
        "timestamp", F.unix_millis(F.col("timestamp").cast("timestamp"))
    ).write.option("header", True).csv(f"{base}/csv")
    event_files.convert_events(spark, f"{base}/csv", f"{base}/monthly")
    return event_files.read_raw_events(spark, f"{base}/monthly").withColumn(
        "year_month", F.col("year_month").cast("string")
    )


def _property_csvs(spark: SparkSession, d: str, base: str) -> list[str]:
    rows = star_schema.item_properties(spark, d).withColumn(
        "timestamp", F.unix_millis(F.col("timestamp").cast("timestamp"))
    )
    first = F.col("property") == "categoryid"
    for i, part in enumerate([rows.filter(first), rows.filter(~first)], 1):
        part.write.option("header", True).csv(f"{base}/part{i}")
    return [f"{base}/part1", f"{base}/part2"]


@query("i09_convert_item_properties")
def _(spark, d):
    base = storage.shared_path(spark, "properties")
    catalog_files.convert_item_properties(spark, _property_csvs(spark, d, base), f"{base}/out")
    return spark.read.parquet(f"{base}/out")


@query("i10_convert_category_tree")
def _(spark, d):
    base = storage.shared_path(spark, "tree")
    star_schema.category_tree(spark, d).write.option("header", True).csv(f"{base}/csv")
    catalog_files.convert_category_tree(spark, f"{base}/csv", f"{base}/out")
    return spark.read.parquet(f"{base}/out")


@query("i11_read_many_files")
def _(spark, d):
    base = storage.shared_path(spark, "parts")
    raw = star_schema.raw_events(spark, d)
    view = F.col("event") == "view"
    raw.filter(view).write.parquet(f"{base}/views")
    raw.filter(~view).write.parquet(f"{base}/others")
    return event_files.read_raw_events(spark, [f"{base}/views", f"{base}/others"])


@query("i12_training_frame_save_load")
def _(spark, d):
    path = storage.shared_path(spark, "training")
    layers.write_layer(training_of(spark, d), path)
    return layers.read_layer(spark, path)


@query("i13_monthly_volume")
def _(spark, d):
    return event_files.monthly_volume(star_schema.dirty_events(spark, d), "event_time")


# --- data quality and profiling --------------------------------------------------


@query("q01_dq_classify")
def _(spark, d):
    return quality.validate(star_schema.dirty_events(spark, d))


@query("q02_silver_quarantine_split")
def _(spark, d):
    good, bad = quality.split_validated(quality.validate(star_schema.dirty_events(spark, d)))
    good = good.withColumn("_dq_error", F.lit(None).cast("string"))
    return good.withColumn("layer", F.lit("silver")).unionByName(
        bad.withColumn("layer", F.lit("quarantine"))
    )


@query("q03_quality_metrics")
def _(spark, d):
    return quality.quality_metrics_from_counts(counted_of(spark, d))


@query("q03_error_counts")
def _(spark, d):
    return quality.error_counts(counted_of(spark, d))


@query("q04_drop_duplicates")
def _(spark, d):
    return quality.drop_exact_duplicates(star_schema.dirty_events(spark, d))


@query("q05_duplicate_listing")
def _(spark, d):
    return quality.list_duplicates(star_schema.dirty_events(spark, d))


@query("q06_duplicates_by_event")
def _(spark, d):
    return quality.duplicates_by(star_schema.dirty_events(spark, d), "event")


@query("q07_missing_summary")
def _(spark, d):
    return profile.missing_summary(star_schema.dirty_events(spark, d))


@query("q07_missing_summary_tree")
def _(spark, d):
    return profile.missing_summary(star_schema.category_tree(spark, d))


@query("q08_missing_by_category")
def _(spark, d):
    return profile.missing_by_category(
        star_schema.dirty_events(spark, d), "transactionid", ["event"], min_missing=1.0
    )


@query("q09_describe")
def _(spark, d):
    return profile.describe(
        star_schema.dirty_events(spark, d), ["visitorid", "itemid", "transactionid"], ["event"]
    )


@query("q10_id_statistics")
def _(spark, d):
    return profile.id_statistics(star_schema.dirty_events(spark, d), ["visitorid", "itemid"])


@query("q11_time_range")
def _(spark, d):
    return profile.time_range(star_schema.dirty_events(spark, d), "event_time")


@query("q11_rows_per_date")
def _(spark, d):
    return profile.rows_per_date(star_schema.dirty_events(spark, d), "event_time")


@query("q12_value_distribution")
def _(spark, d):
    return profile.value_distribution(star_schema.dirty_events(spark, d), "event")


@query("q13_integrality")
def _(spark, d):
    return profile.all_whole_numbers(star_schema.category_tree(spark, d), "parentid")


@query("q14_normalise_tree")
def _(spark, d):
    return profile.normalise_tree(star_schema.category_tree(spark, d))


@query("q15_root_rows")
def _(spark, d):
    return profile.root_rows(star_schema.category_tree(spark, d))


# --- point-in-time features ------------------------------------------------------


@query("f01_snapshot_day")
def _(spark, d):
    return silver_of(spark, d)


@query("f02_snapshot_dates")
def _(spark, d):
    return snapshots.build_snapshot_dates(silver_of(spark, d))


@query("f03_daily_event_counts")
def _(spark, d):
    return behavior.daily_event_counts(silver_of(spark, d))


@query("f04_user_behavior")
def _(spark, d):
    silver = silver_of(spark, d)
    return behavior.build_user_behavior(silver, snapshots.build_snapshot_dates(silver))


@query("f05_session_boundaries")
def _(spark, d):
    rows = sessions.add_session_boundaries(star_schema.click_events(spark, d))
    gap = timeline.epoch_micros("event_time") - timeline.epoch_micros("previous_event_time")
    return rows.withColumn("time_diff", gap)


@query("f06_session_id")
def _(spark, d):
    rows = sessions.add_session_boundaries(star_schema.click_events(spark, d))
    return sessions.add_session_id(rows).drop("previous_event_time", "time_diff")


@query("f07_create_sessions")
def _(spark, d):
    return sessions.create_sessions(
        star_schema.click_events(spark, d), ts_col="event_time", timeout_minutes=45
    )


@query("f08_aggregate_sessions")
def _(spark, d):
    marked = sessions.add_session_boundaries(star_schema.click_events(spark, d))
    numbered = sessions.add_session_id(marked)
    return sessions.aggregate_sessions(numbered)


@query("f09_daily_session_stats")
def _(spark, d):
    table = sessions.session_table(star_schema.click_events(spark, d), whole_seconds=False)
    return sessions.build_daily_session_stats(table)


@query("f10_aligned_session_stats")
def _(spark, d):
    silver = silver_of(spark, d)
    return sessions.align_session_stats_with_snapshots(
        sessions.build_daily_session_stats(sessions.session_table(silver)),
        snapshots.build_snapshot_dates(silver),
    )


@query("f11_rolling_session_features")
def _(spark, d):
    silver = silver_of(spark, d)
    daily = sessions.build_daily_session_stats(
        sessions.session_table(silver, whole_seconds=False)
    )
    days = silver.select(*KEY).distinct()
    return sessions.build_rolling_session_features(
        sessions.align_session_stats_with_snapshots(daily, days)
    )


@query("f12_session_features")
def _(spark, d):
    silver = silver_of(spark, d)
    return sessions.build_session_features(silver, snapshots.build_snapshot_dates(silver))


@query("f13_item_daily_transactions")
def _(spark, d):
    return popularity.item_daily_transactions(silver_of(spark, d))


@query("f14_item_day_grid")
def _(spark, d):
    return popularity.item_day_grid(silver_of(spark, d))


@query("f15_item_popularity")
def _(spark, d):
    return popularity.item_popularity_all(silver_of(spark, d))


@query("f16_top_seller_threshold")
def _(spark, d):
    return popularity.top_seller_threshold(silver_of(spark, d))


@query("f16_top_seller_threshold_linear")
def _(spark, d):
    return popularity.top_seller_threshold(silver_of(spark, d), method="linear")


@query("f17_top_sellers")
def _(spark, d):
    return popularity.top_sellers(silver_of(spark, d))


@query("f18_cart_events")
def _(spark, d):
    return popularity.cart_events_with_popularity(silver_of(spark, d))


@query("f19_daily_cart_stats")
def _(spark, d):
    silver = silver_of(spark, d)
    return popularity.daily_cart_stats(silver, snapshots.build_snapshot_dates(silver))


@query("f20_cart_features_linear")
def _(spark, d):
    silver = silver_of(spark, d)
    days = silver.select(*KEY).distinct()
    return popularity.rolling_cart_features(
        popularity.daily_cart_stats(silver, days, method="linear")
    )


@query("f21_popularity_features")
def _(spark, d):
    silver = silver_of(spark, d)
    return popularity.build_item_popularity_features(
        silver, snapshots.build_snapshot_dates(silver)
    )


@query("f22_gold")
def _(spark, d):
    return gold.build_gold(silver_of(spark, d))


@query("f22_gold_by_parts")
def _(spark, d):
    silver = silver_of(spark, d)
    return gold.build_gold_by_parts(silver, snapshots.build_snapshot_dates(silver))


@query("f23_daily_purchases")
def _(spark, d):
    return target.daily_purchases(silver_of(spark, d))


@query("f24_purchase_target")
def _(spark, d):
    silver = silver_of(spark, d)
    return target.create_purchase_target(
        behavior.daily_event_counts(silver), target.daily_purchases(silver), days=2
    )


@query("f24_training_frame")
def _(spark, d):
    return training_of(spark, d)


# --- exploration -----------------------------------------------------------------


@query("x01_visitor_events")
def _(spark, d):
    return explore.visitor_event_counts(star_schema.click_events(spark, d))


@query("x02_item_events")
def _(spark, d):
    return explore.item_event_counts(star_schema.click_events(spark, d))


@query("x03_heavy_tail_describe")
def _(spark, d):
    return explore.describe_tail(
        explore.visitor_event_counts(star_schema.click_events(spark, d))
    )


@query("x04_event_ratios")
def _(spark, d):
    return explore.event_ratios(star_schema.click_events(spark, d))


@query("x05_pareto_visitors")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return explore.pareto_analysis(counts, "visitorid", "transaction", "visitors")


@query("x05_pareto_point_items")
def _(spark, d):
    counts = explore.item_event_counts(star_schema.click_events(spark, d))
    pareto = explore.pareto_analysis(counts, "itemid", "transaction", "items")
    return explore.pareto_point(pareto, "transaction", "items", 0.80)


@query("x05_pareto_items")
def _(spark, d):
    counts = explore.item_event_counts(star_schema.click_events(spark, d))
    return explore.pareto_analysis(counts, "itemid", "transaction", "items")


@query("x05_pareto_point_visitors")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    pareto = explore.pareto_analysis(counts, "visitorid", "transaction", "visitors")
    return explore.pareto_point(pareto, "transaction", "visitors", 0.80)


@query("x06_top_visitors")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return explore.top_entities(counts, "visitorid", n=30)


@query("x06_top_items")
def _(spark, d):
    counts = explore.item_event_counts(star_schema.click_events(spark, d))
    return explore.top_entities(counts, "itemid", n=20)


@query("x07_monthly_events")
def _(spark, d):
    return explore.monthly_events(star_schema.click_events(spark, d))


@query("x07_monthly_events_without_views")
def _(spark, d):
    return explore.monthly_events(star_schema.click_events(spark, d), leave_out=["view"])


@query("x08_daily_transactions")
def _(spark, d):
    return explore.daily_transactions(star_schema.click_events(spark, d))


@query("x08_daily_transactions_before")
def _(spark, d):
    return explore.daily_transactions(
        star_schema.click_events(spark, d), before=dt.date(2024, 1, 15)
    )


@query("x09_weekday_events")
def _(spark, d):
    return explore.weekday_events(star_schema.click_events(spark, d))


@query("x10_hourly_events")
def _(spark, d):
    return explore.hourly_events(star_schema.click_events(spark, d))


@query("x11_visitor_funnel")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return explore.build_funnel(counts, "visitors")


@query("x11_item_funnel")
def _(spark, d):
    counts = explore.item_event_counts(star_schema.click_events(spark, d))
    return explore.build_funnel(counts, "items")


@query("x13_item_conversion_rates")
def _(spark, d):
    counts = explore.item_event_counts(star_schema.click_events(spark, d))
    return explore.compute_conversion_rates(explore.build_funnel(counts, "items"), "items")


@query("x12_property_as_of")
def _(spark, d):
    return catalog.property_as_of(
        star_schema.item_properties(spark, d), F.lit("2024-01-16").cast("timestamp_ntz")
    )


@query("x12_property_as_of_snapshots")
def _(spark, d):
    return asof.property_as_of_snapshots(
        silver_of(spark, d), star_schema.item_properties(spark, d), ["categoryid", "brand", "type"]
    )


@query("x13_conversion_rates")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return explore.compute_conversion_rates(explore.build_funnel(counts, "visitors"), "visitors")


@query("x14_session_summary")
def _(spark, d):
    return explore.session_summary(star_schema.click_events(spark, d))


@query("x15_session_conversion")
def _(spark, d):
    return explore.conversion_summary(
        explore.session_summary(star_schema.click_events(spark, d)),
        "duration_minutes",
        "has_transaction",
        explore.DURATION_EDGES,
        explore.DURATION_LABELS,
        "sessions",
    )


@query("x16_recency")
def _(spark, d):
    return explore.visitor_recency(star_schema.click_events(spark, d))


@query("x17_purchase_recency")
def _(spark, d):
    return explore.purchase_recency(star_schema.click_events(spark, d))


@query("x18_visitor_recency")
def _(spark, d):
    return explore.visitor_recency_transactions(star_schema.click_events(spark, d))


@query("x18_recency_conversion")
def _(spark, d):
    return explore.recency_conversion(star_schema.click_events(spark, d))


@query("x19_recency_transactions")
def _(spark, d):
    return explore.recency_transactions(star_schema.click_events(spark, d))


@query("x20_histogram_purchase_recency")
def _(spark, d):
    recency = explore.purchase_recency(star_schema.click_events(spark, d))
    return bins.histogram(recency, "hours_since_last_purchase", 50)


@query("x20_histogram_views")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return bins.histogram(counts, "view", 100)


@query("x20_histogram_carts")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return bins.histogram(counts, "addtocart", 50)


@query("x20_histogram_transactions")
def _(spark, d):
    counts = explore.visitor_event_counts(star_schema.click_events(spark, d))
    return bins.histogram(counts, "transaction", 50)


@query("x20_histogram_session_length")
def _(spark, d):
    lengths = explore.session_summary(star_schema.click_events(spark, d))
    return bins.histogram(lengths, "events", 20)


@query("x21_property_frequency")
def _(spark, d):
    return catalog.property_frequency(star_schema.item_properties(spark, d)).limit(30)


@query("x22_property_history")
def _(spark, d):
    return catalog.property_history(star_schema.item_properties(spark, d))


@query("x22_describe_property_history")
def _(spark, d):
    return catalog.describe_property_history(star_schema.item_properties(spark, d))


@query("x23_root_and_child_counts")
def _(spark, d):
    tree = profile.normalise_tree(star_schema.category_tree(spark, d))
    return catalog.root_and_child_counts(tree)


@query("x23_children_per_parent")
def _(spark, d):
    tree = profile.normalise_tree(star_schema.category_tree(spark, d))
    return catalog.children_per_parent(tree)


@query("x24_category_depth")
def _(spark, d):
    tree = profile.normalise_tree(star_schema.category_tree(spark, d))
    return catalog.build_category_depth(tree)


@query("x25_depth_distribution")
def _(spark, d):
    tree = profile.normalise_tree(star_schema.category_tree(spark, d))
    return catalog.depth_distribution(catalog.build_category_depth(tree))


@query("x26_item_categories")
def _(spark, d):
    return catalog.item_categories(star_schema.item_properties(spark, d))


@query("x27_category_events")
def _(spark, d):
    return catalog.category_events(
        star_schema.click_events(spark, d),
        catalog.item_categories(star_schema.item_properties(spark, d)),
    )


@query("x28_items_per_category")
def _(spark, d):
    pairs = catalog.item_categories(star_schema.item_properties(spark, d))
    return catalog.items_per_category(pairs)


def _category_purchases(spark: SparkSession, d: str) -> DataFrame:
    return catalog.category_purchases(
        star_schema.click_events(spark, d),
        catalog.item_categories(star_schema.item_properties(spark, d)),
    )


@query("x29_category_purchases")
def _(spark, d):
    return _category_purchases(spark, d)


@query("x30_best_converting_categories")
def _(spark, d):
    return catalog.best_converting(_category_purchases(spark, d))


def _with_parent(spark: SparkSession, d: str) -> DataFrame:
    tree = profile.normalise_tree(star_schema.category_tree(spark, d))
    return catalog.with_parent(_category_purchases(spark, d), tree)


@query("x31_category_parent_lookup")
def _(spark, d):
    return _with_parent(spark, d)


@query("x32_parent_purchases")
def _(spark, d):
    return catalog.parent_purchases(_with_parent(spark, d))


# --- training-set preparation and models -----------------------------------------


@query("m01_interaction_filter")
def _(spark, d):
    return split.interaction_filter(training_of(spark, d))


@query("m02_temporal_boundaries")
def _(spark, d):
    return prepared_of(spark, d)


@query("m03_chronological_split")
def _(spark, d):
    return split_of(spark, d).select(*KEY, "split")


@query("m04_split_report")
def _(spark, d):
    return split.split_report(split_of(spark, d))


@query("m05_standardise")
def _(spark, d):
    return train.standardise(prepared_of(spark, d)).select(*KEY, *MODEL_FEATURES)


@query("m06_class_weights")
def _(spark, d):
    weighted = train.add_class_weight(prepared_of(spark, d), "balanced")
    return weighted.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("rows"), F.max(train.WEIGHT).alias("weight")
    )


def inside(p: str) -> Column:
    """1 where a probability lies in 0 to 1."""
    return F.coalesce(F.col(p).between(0, 1), F.lit(False)).cast("long").alias("inside")


def varies(scored: DataFrame, p: str) -> Column:
    """1 if rows differ in their score by more than rounding.

    Trees grown on a single class split on the rounding of their sums.
    """
    rounded = F.round(p, 9)
    return scored.select((F.min(rounded) < F.max(rounded)).cast("long")).scalar().alias("varies")


def learns(model, rows: DataFrame) -> int:
    """1 if the model ranks the rows it was fitted on better than chance does."""
    scored = train.score_rows(model, rows)
    precision = evaluate.evaluate_model(scored, label=TARGET).first().pr_auc
    return int(precision > rows.agg(F.avg(TARGET)).first()[0])


def _validated(spark: SparkSession, d: str, spec: train.ModelSpec) -> tuple[DataFrame, int]:
    """Scores of the validation rows, and whether the model learned from the train rows."""
    rows = storage.materialise(split_of(spark, d))
    fitted_on = rows.filter(F.col("split") == "train")
    model = train.fit_model(fitted_on, spec)
    scored = train.score_rows(model, rows.filter(F.col("split") == "validation"))
    return scored.select(*KEY, TARGET, "p"), learns(model, fitted_on)


def _validated_scores(spark: SparkSession, d: str, spec: train.ModelSpec) -> DataFrame:
    scored, learned = _validated(spark, d, spec)
    flag = F.lit(learned).cast("long").alias("learns")
    return scored.select(*KEY, TARGET, inside("p"), varies(scored, "p"), flag)


def score_equations(
    scored: DataFrame, features: str, weight: Column, penalty: float, slopes: list[float]
) -> DataFrame:
    """What a penalised logistic fit leaves of its equations, relative to the weight: the sum
    of w (p - y) x plus the penalty, zero at the optimum for each term."""
    x = F.col(features)
    terms = [(f"slope {k}", x[k], penalty * b) for k, b in enumerate(slopes)]
    terms.append(("intercept", F.lit(1.0), 0.0))
    wrong = weight * (F.col("p") - F.col("y"))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("term"),
                F.count(F.lit(1)).alias("rows"),
                F.abs(F.round(F.sum(wrong * value) / F.sum(weight) + shift, 3)).alias("left"),
            )
            for name, value, shift in terms
        ]
    )
    return scored.agg(rows.alias("rows")).select(F.inline("rows"))


@query("m07_logistic_regression")
def _(spark, d):
    spec = train.ModelSpec("logistic", {"C": 1.0, "positive_weight": 12})
    rows = split_of(spark, d).filter(F.col("split") == "train")
    model = train.fit_model(rows, spec)
    fitted = model.transform(rows).select(
        F.col(TARGET).alias("y"),
        vector_to_array("features").alias("x"),
        vector_to_array("probability")[1].alias("p"),
    )
    logistic = model.stages[-1]
    weight = F.when(F.col("y") == 1, 12.0).otherwise(1.0)
    slopes = [float(b) for b in logistic.coefficients]
    return score_equations(fitted, "x", weight, logistic.getRegParam(), slopes)


@query("m08_random_forest")
def _(spark, d):
    return _validated_scores(spark, d, train.ModelSpec("forest", FORESTS))


@query("m09_boosted_trees")
def _(spark, d):
    return _validated_scores(spark, d, train.ModelSpec("boosted", BOOSTED))


@trained("m08_random_forest_scores")
def _(spark, d):
    return _validated(spark, d, train.ModelSpec("forest", FORESTS))[0]


@trained("m09_boosted_trees_scores")
def _(spark, d):
    return _validated(spark, d, train.ModelSpec("boosted", BOOSTED))[0]


@query("m10_expanding_folds")
def _(spark, d):
    return split.expanding_folds(prepared_of(spark, d)).select(*KEY, "fold")


def in_order(place: str, score: str, names: str) -> list[Column]:
    """Whether the score falls with the place, and how many different names there are."""
    every = Window.partitionBy(F.lit(0))
    falls = F.coalesce(F.lag(score).over(every.orderBy(place)) >= F.col(score), F.lit(True))
    return [
        falls.cast("long").alias("falls"),
        F.size(F.collect_set(names).over(every)).cast("long").alias("different"),
    ]


@query("m11_randomised_search")
def _(spark, d):
    folds = folds_of(spark, d)
    family, draws, grid = train.GRIDS["Tuned Logistic Regression"]
    found = train.randomised_search(folds, family, grid, n_iter=draws)
    # One row per draw.
    report = train.search_report(folds, found)
    return report.select("place", "family", *in_order("place", "mean_pr_auc", "params"))


@trained("m11_search_scores")
def _(spark, d):
    folds = folds_of(spark, d)
    family, draws, grid = train.GRIDS["Tuned Logistic Regression"]
    return train.search_report(folds, train.randomised_search(folds, family, grid, n_iter=draws))


@query("m11_search_equations")
def _(spark, d):
    """Every fit of the search: its rows, and that its equations hold at its coefficients."""
    folds = storage.materialise(folds_of(spark, d))
    _, draws, grid = train.GRIDS["Tuned Logistic Regression"]
    fits = newton.search_fits(train.sample_params(grid, draws), n_splits=3)
    left = newton.score_equations(folds, newton.fit_together(folds, fits))
    return left.withColumn("name", F.col("name").cast("long")).withColumnRenamed("name", "draw")


_selections: dict[tuple[str, str], tuple[str, DataFrame, score.PurchaseScorer]] = {}


def selection_of(spark: SparkSession, d: str) -> tuple[str, DataFrame, score.PurchaseScorer]:
    """Winner of all candidates, the metrics of each, and the winner's scorer.

    Fitted once for an application and folder, and shared by the queries on it.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _selections:
        rows = storage.materialise(split_of(spark, d))
        winner, report = training.select_model(rows, CANDIDATES, parallelism=7)
        _selections[key] = winner, report, training.refit(rows, CANDIDATES[winner])
    return _selections[key]


@query("m12_compare_models")
def _(spark, d):
    winner, report, _ = selection_of(spark, d)
    # One row per model.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("pr_auc"), "model"))
    placed = report.withColumn("place", place)
    best = (F.col("model") == winner) == (F.col("place") == 1)
    return placed.select(
        "model", *in_order("place", "pr_auc", "model"), best.cast("long").alias("winner_is_first")
    )


@trained("m12_model_scores")
def _(spark, d):
    return selection_of(spark, d)[1]


@query("m13_development_set")
def _(spark, d):
    return split.development_set(split_of(spark, d)).select(*KEY, TARGET)


def _oof(spark: SparkSession, d: str) -> DataFrame:
    development = split.development_set(split_of(spark, d)).drop("split")
    folds = storage.materialise(split.expanding_folds(development))
    return train.out_of_fold_scores(folds, train.ModelSpec("logistic"))


@query("m14_oof_predictions")
def _(spark, d):
    scored = storage.materialise(_oof(spark, d))
    return scored.select(*KEY, "fold", TARGET, inside("p"), varies(scored, "p"))


@trained("m14_oof_scores")
def _(spark, d):
    return _oof(spark, d).select(*KEY, "fold", TARGET, "p")


@query("m15_logit")
def _(spark, d):
    return star_schema.scored_labels(spark, d).withColumn(
        "logit", probability.logit(F.col("p"))
    )


@query("m16_platt_calibrator")
def _(spark, d):
    scored = storage.materialise(_oof(spark, d))
    slope, intercept = train.fit_calibrator(scored)
    fitted = scored.select(
        F.col(TARGET).alias("y"),
        F.array(probability.logit(F.col("p"))).alias("x"),
        probability.calibrate_probability(F.col("p"), slope, intercept).alias("p"),
    )
    return score_equations(fitted, "x", F.lit(1.0), 1.0 / scored.count(), [slope])


@query("m17_calibrate_probability")
def _(spark, d):
    return star_schema.scored_labels(spark, d).select(
        "id",
        "p",
        probability.calibrate_probability(F.col("p"), SLOPE, OFFSET).alias("calibrated"),
    )


def _test_scores(spark: SparkSession, d: str) -> DataFrame:
    """Test rows scored by the refitted winner."""
    rows = split_of(spark, d).filter(F.col("split") == "test")
    return storage.materialise(selection_of(spark, d)[2].transform(rows))


@query("m18_final_refit")
def _(spark, d):
    scored = _test_scores(spark, d)
    return scored.select(*KEY, inside("raw_probability"), varies(scored, "raw_probability"))


@trained("m18_refit_scores")
def _(spark, d):
    return _test_scores(spark, d).select(*KEY, "raw_probability", score.PROBABILITY)


def _validation_model(spark: SparkSession, d: str):
    """A logistic model of the train rows, and the validation rows."""
    rows = storage.materialise(split_of(spark, d))
    model = train.fit_model(rows.filter(F.col("split") == "train"), train.ModelSpec("logistic"))
    return model, rows.filter(F.col("split") == "validation")


@query("m19_permutation_importance")
def _(spark, d):
    """Importances lie in -1 to 1; shuffled columns keep their rows, sums and extremes."""
    _, rows = _validation_model(spark, d)
    numbered = train.numbered_rows(rows)
    n = numbered.count()
    sums = []
    for repeat in range(5):
        both = train.shuffled_features(numbered, n, train.SEED + repeat)
        columns = F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.count(f"_s_{c}").alias("rows"),
                    F.sum(F.col(f"_s_{c}").cast("double")).alias("total"),
                    F.max(F.col(f"_s_{c}").cast("double")).alias("largest"),
                    (F.count_if(~F.col(f"_s_{c}").eqNullSafe(F.col(c))) > 0).cast("long").alias("moved"),
                )
                for c in MODEL_FEATURES
            ]
        )
        sums.append(
            both.agg(columns.alias("c")).select(F.lit(repeat).alias("repeat"), F.inline("c"))
        )
    return evaluate.union_all(sums)


@trained("m19_importances")
def _(spark, d):
    return train.permutation_importance(*_validation_model(spark, d))


@query("m20_ranked_predictions_fixed")
def _(spark, d):
    rows = split_of(spark, d).filter(F.col("split") == "test")
    return score.rank_predictions(fixed_score(rows))


@query("m21_composite_scorer")
def _(spark, d):
    scored = _test_scores(spark, d)
    ranked = score.rank_predictions(scored)
    return ranked.select(*KEY, inside(score.PROBABILITY), varies(scored, score.PROBABILITY))


@trained("m21_ranked_scores")
def _(spark, d):
    return score.rank_predictions(_test_scores(spark, d)).select(*KEY, score.PROBABILITY)


@query("m22_reload_equivalence")
def _(spark, d):
    rows = split_of(spark, d)
    scorer = selection_of(spark, d)[2]
    path = storage.shared_path(spark, "scorer")
    scorer.save(spark, path)
    again = score.PurchaseScorer.load(spark, path)
    test = rows.filter(F.col("split") == "test")
    return score.prediction_difference(scorer.transform(test), again.transform(test), KEY)


@query("m23_features_and_label")
def _(spark, d):
    return split.features_and_label(split_of(spark, d))


# --- evaluation and scoring ------------------------------------------------------


@query("e01_roc_auc")
def _(spark, d):
    return evaluate.evaluate_model(two_scores(spark, d), group=["model"]).select(
        "model", "roc_auc"
    )


@query("e02_average_precision")
def _(spark, d):
    return evaluate.evaluate_model(two_scores(spark, d), group=["model"]).select("model", "pr_auc")


@query("e03_brier_score")
def _(spark, d):
    return evaluate.evaluate_model(star_schema.scored_labels(spark, d)).select("brier_score")


@query("e04_threshold_analysis")
def _(spark, d):
    return evaluate.threshold_analysis(star_schema.scored_labels(spark, d))


@query("e05_ranking_analysis")
def _(spark, d):
    return evaluate.ranking_analysis(star_schema.scored_labels(spark, d, ties=True))


@query("e06_roc_points")
def _(spark, d):
    return evaluate.roc_points(two_scores(spark, d), group=["model"])


@query("e07_precision_recall_points")
def _(spark, d):
    return evaluate.precision_recall_points(two_scores(spark, d), group=["model"])


@query("e08_calibration_points")
def _(spark, d):
    return evaluate.calibration_points(star_schema.scored_labels(spark, d))


@query("e09_raw_vs_calibrated")
def _(spark, d):
    scored = star_schema.scored_labels(spark, d).withColumn(
        "calibrated", probability.calibrate_probability(F.col("p"), SLOPE, OFFSET)
    )
    return evaluate.compare_scores(scored, {"Raw": "p", "Calibrated": "calibrated"})


@query("p01_prepare_inference_data")
def _(spark, d):
    return score.prepare_inference_data(gold.build_gold(silver_of(spark, d)))


@query("p02_fix_types")
def _(spark, d):
    return score.fix_types(gold.build_gold(silver_of(spark, d)))


@query("p03_predict_fixed")
def _(spark, d):
    inference = score.prepare_inference_data(gold.build_gold(silver_of(spark, d)))
    return score.predict(fixed_score, inference)


def _trained_predictions(spark: SparkSession, d: str) -> DataFrame:
    inference = score.prepare_inference_data(gold.build_gold(silver_of(spark, d)))
    return storage.materialise(score.predict(selection_of(spark, d)[2], inference))


@query("p03_predict_trained")
def _(spark, d):
    scored = _trained_predictions(spark, d)
    return scored.select("visitorid", inside(score.PROBABILITY), varies(scored, score.PROBABILITY))


@trained("p03_trained_scores")
def _(spark, d):
    return _trained_predictions(spark, d)


@query("p04_write_predictions")
def _(spark, d):
    inference = score.prepare_inference_data(gold.build_gold(silver_of(spark, d)))
    path = storage.shared_path(spark, "predictions")
    layers.write_predictions(score.predict(fixed_score, inference), path)
    return layers.read_layer(spark, path)


@query("p05_end_to_end")
def _(spark, d):
    base = storage.shared_path(spark, "job")
    star_schema.raw_events(spark, d).write.parquet(f"{base}/raw")
    batch_job.run_all(spark, f"{base}/raw", base, fixed_score)
    return layers.read_layer(spark, f"{base}/predictions")


@query("p05_end_to_end_in_memory")
def _(spark, d):
    return batch_job.score_raw_events(star_schema.raw_events(spark, d), fixed_score)
