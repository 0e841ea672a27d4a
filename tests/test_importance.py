"""The row bijection, and importances against shuffling by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.functions.bijection import permuted, sides
from clickloom.operators import train
from clickloom.schemas import MODEL_FEATURES, TARGET


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 64, 99, 1000, 4097])
def test_every_number_is_hit_once(spark, n):
    for seed in (0, 1, 42):
        got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, seed)).collect()]
        assert sorted(got) == list(range(n))


def test_sides_cover_the_numbers():
    for n in range(1, 3000):
        a, b = sides(n)
        assert n <= a * b < n + a


def test_seeds_differ_and_neighbours_part(spark):
    n = 5000
    a, b = (
        np.array([r[0] for r in spark.range(n).orderBy("id").select(permuted(F.col("id"), n, s)).collect()])
        for s in (1, 2)
    )
    assert (a == b).sum() < 20 and (a == np.arange(n)).sum() < 20
    assert abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.06
    assert (np.abs(np.diff(a)) < n / 100).mean() < 0.06


@pytest.fixture(scope="module")
def scored(spark):
    n = F.col("id")
    rows = spark.range(400).select(
        n.alias("visitorid"),
        (n % 7).cast("int").alias("snapshot_day"),
        *[(F.abs(F.xxhash64(n, F.lit(i))) % 40 / 10.0).alias(c) for i, c in enumerate(MODEL_FEATURES)],
    )
    likely = F.col(MODEL_FEATURES[0]) + F.abs(F.hash("visitorid")) % 20 / 10.0 > 3
    rows = rows.withColumn(TARGET, likely.cast("int")).checkpoint()
    return rows, train.fit_model(rows, train.ModelSpec("logistic"))


def average_precision(y, p):
    found = 0.0
    for at in sorted(set(p), reverse=True):
        above = p >= at
        found += y[p == at].sum() / y.sum() * y[above].mean()
    return found


def test_importances_equal_shuffling_by_hand(spark, scored):
    rows, model = scored
    base = rows.orderBy("visitorid", "snapshot_day").toPandas()
    n = len(base)
    weights, intercept = _raw_coefficients(model)

    def ap(x):
        margin = np.round(x @ weights + intercept, 12)
        return average_precision(base[TARGET].to_numpy(), margin)

    own = base[MODEL_FEATURES].to_numpy(dtype=float)
    drops = dict.fromkeys(MODEL_FEATURES, 0.0)
    for repeat in range(3):
        place = spark.range(n).orderBy("id").select(permuted(F.col("id"), n, train.SEED + repeat))
        moved = np.empty_like(own)
        moved[[r[0] for r in place.collect()]] = own
        for k, c in enumerate(MODEL_FEATURES):
            mixed = own.copy()
            mixed[:, k] = moved[:, k]
            drops[c] += (ap(own) - ap(mixed)) / 3
    found = {r.feature: r.importance for r in train.permutation_importance(model, rows, n_repeats=3).collect()}
    assert found == pytest.approx(drops, abs=1e-9)
    assert max(found, key=found.get) == MODEL_FEATURES[0]


def _raw_coefficients(model):
    scaler, logistic = model.stages[1], model.stages[2]
    weights = np.array(logistic.coefficients) / np.array(scaler.std)
    return weights, logistic.intercept - weights @ np.array(scaler.mean)


def test_shuffled_columns_keep_their_values(scored):
    rows, _ = scored
    numbered = train.numbered_rows(rows)
    both = train.shuffled_features(numbered, 400, 5).toPandas()
    assert len(both) == 400
    for c in MODEL_FEATURES:
        assert sorted(both[c]) == sorted(both[f"_s_{c}"]) and (both[c] != both[f"_s_{c}"]).any()


def test_one_ordering_for_all_repeats(scored, monkeypatch):
    rows, model = scored
    calls = []
    ordering = train.running_totals
    monkeypatch.setattr(train, "running_totals", lambda *a, **k: calls.append(1) or ordering(*a, **k))
    plan = train.permutation_importance(model, rows, n_repeats=4)
    assert len(calls) == 1 and plan.columns == ["feature", "importance"]
