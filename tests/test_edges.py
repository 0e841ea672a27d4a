"""Ties, empty layers, undefined scores, duplicates, and what is stored and read."""

import math

import pytest
from pyspark.sql import functions as F

from clickloom.functions import bins, storage
from clickloom.operators import catalog, evaluate, sessions, split, train
from clickloom.operators.snapshots import add_snapshot_day
from clickloom.plans import batch_job, gold
from clickloom.sources import layers, star_schema

SF = "/root/testdata/sf0.001"


def test_new_session_flag_of_tied_events(spark, make_events):
    rows = [(0, 1, "view", 10, None), (3600, 1, "view", 12, None), (3600, 1, "view", 11, None)]
    for order in (rows, rows[::-1]):
        marked = sessions.add_session_boundaries(make_events(order).repartition(1))
        flags = {r.itemid: r.new_session for r in marked.collect()}
        assert flags == {10: 1, 11: 1, 12: 0}


def test_silver_without_rows(spark, make_events, tmp_path):
    bronze = make_events([(0, 1, "signup", 1, None)])
    counts = layers.write_silver(bronze, f"{tmp_path}/s", f"{tmp_path}/q")
    assert counts == {"total_rows": 1, "valid_rows": 0, "quarantined_rows": 1}
    with pytest.raises(ValueError, match="silver is empty"):
        batch_job.run_features(spark, f"{tmp_path}/s", f"{tmp_path}/g")


def test_undefined_scores_are_left_out_everywhere(spark):
    good = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.3), (4, 0, 0.1)]
    bad = [(5, 1, float("nan")), (6, 0, None), (7, None, 0.5)]
    schema = "id long, y int, p double"
    clean, mixed = spark.createDataFrame(good, schema), spark.createDataFrame(good + bad, schema)
    for metric in (evaluate.evaluate_model, evaluate.threshold_analysis, evaluate.ranking_analysis):
        assert metric(mixed).collect() == metric(clean).collect()


@pytest.mark.parametrize("levels", [1, 3, 1000])
def test_ranking_orders_ties_by_id(spark, levels):
    rows = [(k * 7919 % 500, int(k * k % 7 < 2), (k * 31 % levels) / levels) for k in range(500)]
    shares = [0.001, 0.01, 0.1, 0.37, 1.0]
    df = spark.createDataFrame(rows, "id long, y int, p double").repartition(5)
    got = {r.top_k: r for r in evaluate.ranking_analysis(df, shares).collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    for share in shares:
        n = max(1, math.ceil(500 * share))
        hits = sum(y for _, y, _ in order[:n])
        assert got[share].n_users == n
        assert got[share].precision_at_k == pytest.approx(hits / n)
        assert got[share].recall_at_k == pytest.approx(hits / sum(y for _, y, _ in rows))


def test_nan_is_in_no_bin(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,), (None,)], "v double")
    label = bins.right_closed_bin(F.col("v"), [0, 1, math.inf], ["low", "high"])
    assert [r[0] for r in df.select(label).collect()] == [None, "high", None]


def test_folds_need_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "visitorid long, snapshot_day int")
    with pytest.raises(Exception, match="3 folds need at least 4 rows"):
        split.expanding_folds(df).collect()


def test_category_listed_twice(spark):
    tree = spark.createDataFrame([(1, -1), (2, 1), (2, 1)], "categoryid long, parentid long")
    with pytest.raises(ValueError, match="more than once"):
        catalog.build_category_depth(tree)


def test_finished_categories_leave_the_walk(spark):
    """Nine in ten categories are roots; the rest hang below each other in chains of eight."""
    n = 100_000
    tree = spark.range(n).select(
        F.col("id").alias("categoryid"),
        F.when((F.col("id") >= 90_000) & (F.col("id") % 8 != 0), F.col("id") - 1).otherwise(-1).alias("parentid"),
    )
    depths = catalog.build_category_depth(tree)
    expected = {0: 90_000 + 1250} | {k: 1250 for k in range(1, 8)}
    assert {r.depth: r["count"] for r in depths.groupBy("depth").count().collect()} == expected


def test_scoring_reads_one_day_of_the_jobs_gold(spark, tmp_path):
    star_schema.raw_events(spark, SF).write.parquet(f"{tmp_path}/raw")
    batch_job.run_ingestion(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze")
    batch_job.run_validation(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/bad")
    batch_job.run_features(spark, f"{tmp_path}/silver", f"{tmp_path}/gold")
    from clickloom.operators.score import prepare_inference_data

    plan = prepare_inference_data(layers.read_gold(spark, f"{tmp_path}/gold"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_day" in text


def test_stored_tables_are_removed(spark):
    labels = star_schema.scored_labels(spark, SF)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(storage.shared_dir(spark))
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def tables():
        return {s.getPath().getName() for s in store.listStatus(folder)}

    before = tables()
    with storage.scope(spark):
        evaluate.evaluate_model(labels).collect()
        assert tables() > before
    assert tables() == before


def test_training_frame_needs_no_more_exchanges_than_gold(spark):
    silver = add_snapshot_day(star_schema.click_events(spark, SF))

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    plain = gold.build_gold(silver, inference_day=False)
    assert exchanges(gold.build_training_frame(silver)) <= exchanges(plain) + 1


def test_tree_limits():
    assert train.tree_depth({"maxDepth": 18, "maxLeaves": 127}) == 7
    assert train.tree_depth({"maxDepth": None, "maxLeaves": 15}) == 4
    assert train.tree_depth({"C": 1.0}) is None
    with pytest.raises(ValueError):
        train.tree_depth({"maxDepth": None})
    with pytest.raises(ValueError):
        train.tree_depth({"maxDepth": 31})
