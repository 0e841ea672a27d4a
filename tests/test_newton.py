"""Regressions solved together against single fits and their own equations."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from clickloom.operators import newton, train
from clickloom.operators.newton import LogisticFit
from clickloom.schemas import MODEL_FEATURES, TARGET


@pytest.fixture(scope="module")
def folds(spark):
    n = F.col("id")
    noise = [(F.abs(F.xxhash64(n, F.lit(i)) % 1000) / 1000.0) for i in range(len(MODEL_FEATURES))]
    rows = spark.range(3000).select(
        (n % 4).cast("int").alias("fold"),
        *[(v * (i + 1) ** 3 + i).alias(c) for i, (c, v) in enumerate(zip(MODEL_FEATURES, noise))],
    )
    chance = F.col(MODEL_FEATURES[0]) * 3 - F.col(MODEL_FEATURES[1]) / 8 + F.abs(F.hash(F.col(MODEL_FEATURES[2]))) % 100 / 50
    return rows.withColumn(TARGET, (chance > 3.2).cast("int")).repartition(5).checkpoint()


GRID = [
    LogisticFit(fold, c, weight, f"{c}-{weight}")
    for fold in (1, 2, 3)
    for c, weight in ((0.001, None), (1.0, 12), (100.0, 5), (10.0, "balanced"))
]


def test_equal_to_single_fits(folds):
    models = newton.fit_together(folds, GRID)
    for model in models:
        seen = folds.filter(F.col("fold") < model.fit.fold)
        weighted = train.add_class_weight(seen, model.fit.positive_weight)
        size = weighted.agg(F.sum(train.WEIGHT)).first()[0]
        raw = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="_raw").transform(weighted)
        scaled = StandardScaler(inputCol="_raw", outputCol="features", withMean=True).fit(raw).transform(raw)
        single = LogisticRegression(
            labelCol=TARGET, weightCol=train.WEIGHT, maxIter=1000, tol=1e-13,
            regParam=1.0 / (model.fit.C * size), standardization=False,
        ).fit(scaled)
        expected = [single.intercept, *single.coefficients]
        assert np.abs(np.array(model.scaled) - expected).max() < 1e-6
        assert model.rows == seen.count() and model.positives == seen.filter(f"{TARGET} = 1").count()


def test_score_equations_hold_and_only_there(folds):
    models = newton.fit_together(folds, GRID)
    left = newton.score_equations(folds, models).collect()
    assert len(left) == len(GRID) and max(r.left for r in left) < 1e-9
    models[0].scaled[1] += 0.01
    moved = {(r.name, r.fold): r.left for r in newton.score_equations(folds, models).collect()}
    assert moved[models[0].fit.name, 1] > 1e-5


def test_scans_do_not_grow_with_the_fits(spark, folds, monkeypatch):
    scans = []
    scan = newton._scan
    monkeypatch.setattr(newton, "_scan", lambda rows, d, asked: scans.append(len(asked)) or scan(rows, d, asked))
    models = newton.fit_together(folds, GRID)
    assert len(scans) == max(m.steps for m in models) < 20
    assert scans[0] == len(GRID) and scans[-1] <= scans[0]


def test_one_scan_a_step(folds):
    rows = newton.stored_rows(folds, MODEL_FEATURES, TARGET)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_search_equals_single_fits(folds):
    grid = {"C": [0.01, 1.0], "positive_weight": [1, 12]}
    found = train.randomised_search(folds, "logistic", grid, n_iter=4)
    for spec, value in found:
        scored = train.out_of_fold_scores(folds, spec)
        per_fold = train.evaluate_model(scored, group=["fold"], label=TARGET)
        assert value == pytest.approx(per_fold.agg(F.avg("pr_auc")).first()[0], abs=2e-3)


def test_edges(spark, folds):
    constant = folds.withColumn(MODEL_FEATURES[3], F.lit(4.0))
    model = newton.fit_together(constant, [LogisticFit()])[0]
    assert model.slopes[3] == 0 and model.rows == 3000
    positive = folds.withColumn(TARGET, F.lit(1))
    certain = newton.fit_together(positive, [LogisticFit()])[0]
    assert np.isfinite(certain.intercept) and certain.intercept > 15
    unlabelled = folds.withColumn(TARGET, F.when(F.col("fold") > 0, F.col(TARGET)))
    assert newton.fit_together(unlabelled, [LogisticFit()])[0].rows == 2250
    with pytest.raises(ValueError, match="no rows"):
        newton.fit_together(folds.filter("fold > 0"), [LogisticFit(1)])
    with pytest.raises(ValueError, match="null"):
        newton.fit_together(folds.withColumn(MODEL_FEATURES[0], F.lit(None)), [LogisticFit()])
    assert newton.fit_together(folds, []) == []
