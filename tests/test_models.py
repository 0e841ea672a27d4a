import math

import pytest
from pyspark.sql import functions as F

from clickloom.functions import probability
from clickloom.operators import evaluate, score, split, train
from clickloom.schemas import MODEL_FEATURES, TARGET
from frames import rows


@pytest.fixture(scope="module")
def hand(spark):
    return spark.createDataFrame(
        [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7), (4, 0, 0.6)], "id long, y int, p double"
    )


@pytest.fixture(scope="module")
def visits(spark):
    """Feature rows of 40 visitors on 30 days with a label that follows the views."""
    n = F.col("id")
    frame = spark.range(1200).select(
        (F.xxhash64(n) % 100 / 100.0).alias("noise"),
        (n % 40).alias("visitorid"),
        (n / 40).cast("int").alias("snapshot_day"),
        *[
            (F.abs(F.xxhash64(n, F.lit(i)) % 50)).cast("long" if i < 4 else "double").alias(c)
            for i, c in enumerate(MODEL_FEATURES)
        ],
    )
    return frame.withColumn(
        TARGET, ((F.col("user_views_7d") + 10 * F.col("noise")) > 30).cast("int")
    ).drop("noise").checkpoint()


def test_metrics_by_hand(hand):
    auc, ap, brier = evaluate.evaluate_model(hand).first()
    assert auc == 0.75
    assert ap == pytest.approx((1 + 2 / 3) / 2)
    assert brier == pytest.approx((0.01 + 0.64 + 0.09 + 0.36) / 4)


def test_tied_scores_count_half(spark):
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5)], "y int, p double")
    auc, ap, _ = evaluate.evaluate_model(tied).first()
    assert (auc, ap) == (0.5, 0.5)


def test_one_class_only(spark):
    ones = spark.createDataFrame([(1, 0.5), (1, 0.4)], "y int, p double")
    auc, ap, _ = evaluate.evaluate_model(ones).first()
    assert auc is None and ap == 1.0


def test_area_below_the_points_is_the_auc(spark):
    scored = spark.range(500).select(
        (F.xxhash64("id") % 2 == 0).cast("int").alias("y"),
        (F.abs(F.xxhash64("id", F.lit(1)) % 37) / 37.0).alias("p"),
    )
    points = sorted((r.fpr, r.tpr) for r in evaluate.roc_points(scored).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(evaluate.evaluate_model(scored).first().roc_auc)
    recall_end = evaluate.precision_recall_points(scored).filter("threshold IS NULL").first()
    assert (recall_end.precision, recall_end.recall) == (1.0, 0.0)


def test_points_on_a_line_are_left_out(spark):
    import random

    for n, parts in ((1, 1), (2, 3), (60, 1), (400, 7)):
        rng = random.Random(n)
        data = [(int(rng.random() < (0.02 if k % 80 < 60 else 0.5)), k / n) for k in range(n)]
        scored = spark.createDataFrame(data, "y int, p double").repartition(parts)
        steps = [(y, 1 - y) for y, _ in reversed(data)]  # every score is its own point
        kept = {k for k in range(n) if k in (0, n - 1) or steps[k] != steps[k + 1]}
        thresholds = {data[n - 1 - k][1] for k in kept}
        points = evaluate.roc_points(scored).filter("threshold IS NOT NULL").collect()
        assert {r.threshold for r in points} == thresholds
        every = evaluate.roc_points(scored, drop_intermediate=False).collect()
        assert len(every) == n + 1


def test_neighbours_are_handed_over_between_partitions(spark):
    from clickloom.functions import ordered

    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = ordered.running_totals(
        df, [F.asc("id")], {}, group=["g"], rank="rn", following=["id"], order_key=F.col("id")
    )
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wrong = got.filter(
        F.coalesce(F.col("following.id") != F.col("id") + 3, F.col("id") + 3 < 20_000)
    )
    assert got.count() == 20_000 and wrong.count() == 0


def test_small_share_selects_one_row(spark):
    scored = spark.range(50).select("id", (F.col("id") == 49).cast("int").alias("y"), (F.col("id") / 50.0).alias("p"))
    got = evaluate.ranking_analysis(scored, [0.001, 0.1])
    assert rows(got) == [(0.001, 1, 1.0, 1.0, 50.0), (0.1, 5, 0.2, 1.0, 10.0)]


def test_ranking_without_positives(spark):
    scored = spark.createDataFrame([(1, 0, 0.5)], "id long, y int, p double")
    assert rows(evaluate.ranking_analysis(scored, [0.5])) == [(0.5, 1, 0.0, 0.0, None)]


def test_threshold_with_nothing_predicted(hand):
    assert rows(evaluate.threshold_analysis(hand, [0.65, 0.95])) == [
        (0.65, 2 / 3, 1.0, 0.75),
        (0.95, 0.0, 0.0, 0.0),
    ]


def test_calibration_edges_belong_to_the_lower_bin(spark):
    scored = spark.createDataFrame([(0, 0.0), (1, 0.5), (1, 1.0)], "y int, p double")
    got = rows(evaluate.calibration_points(scored, n_bins=2), "bin", "mean_predicted", "rows")
    assert got == [(0, 0.25, 2), (1, 1.0, 1)]


def test_logit_is_clipped(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "p double")
    low, middle, high = [r[0] for r in df.select(probability.logit(F.col("p"))).collect()]
    assert middle == 0.0
    assert low == pytest.approx(math.log(1e-6 / (1 - 1e-6)))
    assert high == pytest.approx(-low)


def test_positive_slope_keeps_the_ranking(hand):
    both = hand.withColumn("c", probability.calibrate_probability(F.col("p"), 0.4, -2.0))
    report = {r.model: r for r in evaluate.compare_scores(both, {"raw": "p", "cal": "c"}).collect()}
    assert report["raw"].roc_auc == report["cal"].roc_auc
    assert report["raw"].pr_auc == pytest.approx(report["cal"].pr_auc)


def test_expanding_folds(visits):
    folds = split.expanding_folds(visits.filter("snapshot_day < 29"))
    sizes = dict(rows(folds.groupBy("fold").count()))
    n = 29 * 40
    assert sizes == {0: n - 3 * (n // 4), 1: n // 4, 2: n // 4, 3: n // 4}
    spans = rows(folds.groupBy("fold").agg(F.min("snapshot_day"), F.max("snapshot_day")))
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_split_cuts_by_distinct_dates(visits):
    spans = {
        r.split: (r.first_day, r.last_day, r.rows)
        for r in split.split_report(split.chronological_split(visits)).collect()
    }
    assert spans == {"train": (0, 17, 720), "validation": (18, 23, 240), "test": (24, 29, 240)}


def test_boundaries_follow_the_rows_given(visits):
    days = rows(split.temporal_boundaries(visits, 10, 6).select("snapshot_day").distinct())
    assert [d for (d,) in days] == sorted(range(10, 24), key=str)


def test_standardise_uses_the_population_deviation(visits):
    scaled = train.standardise(visits.withColumn("user_sessions_30d", F.lit(3)))
    stats = scaled.agg(
        F.avg("user_views_7d"), F.stddev_pop("user_views_7d"), F.max("user_sessions_30d")
    ).first()
    assert tuple(stats) == pytest.approx((0.0, 1.0, 0.0), abs=1e-12)


def test_balanced_weights_share_evenly(visits):
    weighted = train.add_class_weight(visits, "balanced")
    per_class = [r[1] for r in rows(weighted.groupBy(TARGET).agg(F.sum(train.WEIGHT)))]
    assert per_class == pytest.approx([600.0, 600.0])


def test_search_samples_without_repeats():
    drawn = train.sample_params({"a": [1, 2, 3], "b": [1, 2]}, 6)
    assert len({tuple(sorted(d.items())) for d in drawn}) == 6
    assert drawn == train.sample_params({"b": [1, 2], "a": [1, 2, 3]}, 6)


@pytest.mark.parametrize(
    "spec",
    [
        train.ModelSpec("logistic", {"C": 1.0, "positive_weight": 12}),
        train.ModelSpec("forest", {"numTrees": 5, "maxDepth": 4, "positive_weight": "balanced"}),
        train.ModelSpec("boosted", {"maxIter": 3, "maxDepth": 3}),
    ],
)
def test_models_learn_and_repeat(visits, spec):
    rows_ = split.chronological_split(visits)
    fitted = train.fit_model(rows_.filter("split = 'train'"), spec)
    again = train.fit_model(rows_.filter("split = 'train'"), spec)
    test = rows_.filter("split = 'test'")
    first = train.score_rows(fitted, test)
    metrics = evaluate.evaluate_model(first, label=TARGET).first()
    base = test.agg(F.avg(TARGET)).first()[0]
    assert metrics.pr_auc > base + 0.1
    same = score.prediction_difference(
        first, train.score_rows(again, test), ["visitorid", "snapshot_day"], column="p"
    ).first()
    assert same.all_close and same.rows == 240


def test_unknown_family(visits):
    with pytest.raises(ValueError):
        train.fit_model(visits, train.ModelSpec("other"))


def test_scorer_round_trip_and_importance(spark, visits, tmp_path):
    rows_ = split.chronological_split(visits)
    development = split.development_set(rows_).drop("split")
    folds = split.expanding_folds(development).checkpoint()
    spec = train.ModelSpec("logistic")
    oof = train.out_of_fold_scores(folds, spec)
    assert oof.count() == folds.filter("fold > 0").count()
    slope, intercept = train.fit_calibrator(oof)
    assert slope > 0
    scorer = score.PurchaseScorer(train.fit_model(development, spec), slope, intercept)
    scorer.save(spark, str(tmp_path / "scorer"))
    again = score.PurchaseScorer.load(spark, str(tmp_path / "scorer"))
    test = rows_.filter("split = 'test'")
    key = ["visitorid", "snapshot_day"]
    check = score.prediction_difference(scorer.transform(test), again.transform(test), key).first()
    assert check.all_close and check.max_difference == 0.0 and check.rows == 240
    raw_rank = [r[0] for r in scorer.transform(test).orderBy(F.desc("raw_probability"), *key).select("visitorid").collect()]
    final_rank = [r[0] for r in score.rank_predictions(scorer.transform(test)).select("visitorid").collect()]
    assert raw_rank == final_rank

    importance = train.permutation_importance(scorer.model, test, n_repeats=2)
    ranked = importance.collect()
    assert len(ranked) == 7 and ranked[0].feature == "user_views_7d"
    assert ranked[0].importance > 0.1


def test_search_and_comparison(visits):
    folds = split.expanding_folds(visits).checkpoint()
    found = train.randomised_search(folds, "logistic", {"C": [0.01, 1], "positive_weight": [1, 5]}, n_iter=2)
    assert len(found) == 2 and found[0][1] >= found[1][1] > 0.5
    assert train.search_report(folds, found).count() == 2
    models = {"a": train.fit_model(folds, found[0][0]), "b": train.fit_model(folds, found[1][0])}
    table = train.compare_models(models, folds).collect()
    assert table[0].pr_auc >= table[1].pr_auc


def test_missing_row_is_not_close(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.5)], "k long, purchase_probability double")
    assert not score.prediction_difference(a, a.filter("k = 1"), ["k"]).first().all_close


def test_tasks_of_tree_fits_follow_the_rows():
    assert [train.tree_tasks(n) for n in (0, 1, 1 << 17, (1 << 17) + 1)] == [1, 1, 1, 2]
    assert [train.tree_tasks(n) for n in (1 << 20, 1 << 21, (1 << 21) + 1, 1 << 30)] == [4, 4, 5, 2048]


def test_a_boosted_fit_does_not_run_a_task_for_every_file(visits, monkeypatch):
    parts = []

    class Fitted:
        def fit(self, frame):
            parts.append(frame.rdd.getNumPartitions())

    monkeypatch.setattr(train, "_estimator", lambda *_: Fitted())
    monkeypatch.setattr(train, "LEAST_ROWS", 100)
    spec = train.ModelSpec("boosted", {"maxIter": 4, "maxDepth": 2})
    train.fit_model(visits.repartition(40).checkpoint(), spec)
    assert parts == [4]


def test_fits_with_folds_equal_separate_fits(visits):
    spec = train.ModelSpec("boosted", {"maxIter": 3, "maxDepth": 3})
    folds = split.expanding_folds(visits.filter("snapshot_day < 20")).checkpoint()
    model, scored = train.fit_with_folds(folds, spec)
    alone = train.out_of_fold_scores(folds, spec)
    assert rows(scored, "visitorid", "snapshot_day", "fold", "p") == rows(
        alone, "visitorid", "snapshot_day", "fold", "p"
    )
    whole = train.fit_model(folds.drop("fold"), spec)
    assert model.stages[-1].toDebugString.split("\n")[1:] == whole.stages[-1].toDebugString.split("\n")[1:]


def test_refit_runs_its_fits_at_the_same_time(visits, monkeypatch):
    import threading

    from clickloom.plans import training

    together = threading.Barrier(4, timeout=120)  # broken if the fits follow each other
    fit = train.fit_model

    def waiting(frame, spec, label=TARGET):
        together.wait()
        return fit(frame, spec, label)

    monkeypatch.setattr(train, "fit_model", waiting)
    marked = split.chronological_split(visits)
    scorer = training.refit(marked, train.ModelSpec("logistic"))
    dev = split.development_set(marked)
    assert scorer.transform(dev).count() == dev.count()


def test_rounding_is_no_variation(spark):
    from checks import catalog

    def flag(*scores):
        df = spark.createDataFrame([(p,) for p in scores], "p double")
        return df.select(catalog.varies(df, "p")).first()[0]

    assert flag(0.9915062432179679, 0.991506243217968) == 0
    assert flag(0.99, 0.98) == 1
