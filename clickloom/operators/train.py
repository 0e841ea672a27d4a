"""Model training, search, out-of-fold scores, calibration and importance."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bijection import permuted
from ..functions.ordered import running_totals
from ..functions.probability import logit
from ..functions.storage import materialise
from ..schemas import MODEL_FEATURES, TARGET
from .evaluate import evaluate_model, union_all
from .newton import fit_together, score_folds, search_fits

WEIGHT = "_weight"
SEED = 42

# Baseline parameters and search grids. Parameters of the original
# solvers without a Spark counterpart are left out. A leaf limit becomes the depth of
# a full tree with so many leaves, the nearest parameter there is. A forest without a
# limit takes the deepest tree that Spark grows.
MAX_DEPTH = 30
# Trees are grown by one job a level, so a boosted fit has thousands of short jobs. Rows of
# one task: so many where that is up to FEW_TASKS, beyond that so many as MOST_ROWS.
LEAST_ROWS, FEW_TASKS, MOST_ROWS = 1 << 17, 4, 1 << 19
BASELINES: dict[str, tuple[str, dict[str, Any]]] = {
    "Baseline Logistic Regression": ("logistic", {"C": 1.0, "positive_weight": 12}),
    "Baseline Boosted Trees": (
        "boosted",
        {"maxIter": 350, "stepSize": 0.04, "maxDepth": 18, "maxLeaves": 127, "positive_weight": 12},
    ),
}
GRIDS: dict[str, tuple[str, int, dict[str, list[Any]]]] = {
    "Tuned Logistic Regression": (
        "logistic",
        15,
        {"C": [0.01, 0.1, 1, 10, 100], "positive_weight": [5, 10, 20, 50, 100, 125]},
    ),
    "Tuned Histogram Boosting": (
        "boosted",
        20,
        {
            "stepSize": [0.02, 0.04, 0.06, 0.1],
            "maxIter": [200, 350, 500],
            "maxLeaves": [15, 31, 63, 127],
            "maxDepth": [5, 10, 15, None],
            "minInstancesPerNode": [10, 20, 50, 100],
            "positive_weight": [20, 50, 100],
        },
    ),
    "Tuned Random Forest": (
        "forest",
        15,
        {
            "numTrees": [100, 200, 300],
            "maxDepth": [10, 20, MAX_DEPTH],
            "minInstancesPerNode": [1, 2, 5, 10],
            "featureSubsetStrategy": ["sqrt", "log2", "0.5"],
            "positive_weight": [None, "balanced", "balanced_subsample"],
        },
    ),
    "Tuned Gradient Boosting": (
        "boosted",
        15,
        {
            "maxIter": [100, 200, 300],
            "stepSize": [0.02, 0.05, 0.1],
            "maxDepth": [2, 3, 5, 8],
            "minInstancesPerNode": [1, 5, 10, 20],
            "featureSubsetStrategy": ["all", "sqrt", "log2"],
        },
    ),
    "Tuned Subsampled Boosting": (
        "boosted",
        15,
        {
            "maxIter": [100, 200, 300, 500],
            "stepSize": [0.02, 0.04, 0.06, 0.1],
            "maxDepth": [3, 5, 7, 9],
            "minInstancesPerNode": [1, 3, 5, 10],
            "subsamplingRate": [0.7, 0.8, 1.0],
        },
    ),
}


@dataclass(frozen=True)
class ModelSpec:
    """A model family with its parameters; fitting it twice gives the same model."""

    family: str
    params: Mapping[str, Any] = field(default_factory=dict)


def standardise(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Zero mean and unit population variance; constant columns are only centred.

    The frame is read twice, once for the moments, so give it a stored one.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
        )
    ).scalar()

    def scaled(c: str) -> Column:
        spread = F.col(f"_moments.{c}_s")
        centred = F.col(c) - F.col(f"_moments.{c}_m")
        return centred / F.when(spread > 0, spread).otherwise(1.0)

    return (
        df.withColumn("_moments", moments)
        .withColumns({c: scaled(c) for c in columns})
        .drop("_moments")
    )


def class_counts(df: DataFrame, label: str = TARGET) -> tuple[int, int]:
    """Negatives and positives."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def class_weights(
    df: DataFrame, positive_weight: float | str | None, label: str = TARGET
) -> tuple[float, float]:
    """Weight of a negative and of a positive row.

    ``"balanced"`` gives both classes half of the total weight. ``"balanced_subsample"``
    does the same: trees are weighted by the whole sample, not by their own draw.
    """
    if positive_weight is None:
        return 1.0, 1.0
    if positive_weight in ("balanced", "balanced_subsample"):
        neg, pos = class_counts(df, label)
        total = neg + pos
        return total / (2.0 * max(neg, 1)), total / (2.0 * max(pos, 1))
    return 1.0, float(positive_weight)


def add_class_weight(
    df: DataFrame, positive_weight: float | str | None, label: str = TARGET
) -> DataFrame:
    negative, positive = class_weights(df, positive_weight, label)
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, positive).otherwise(negative))


def tree_depth(params: Mapping[str, Any]) -> int | None:
    """Depth for ``maxDepth`` and ``maxLeaves``; an error if Spark cannot grow such trees."""
    depth, leaves = params.get("maxDepth"), params.get("maxLeaves")
    if leaves is not None:
        full = math.ceil(math.log2(leaves))
        depth = full if depth is None else min(depth, full)
    elif depth is None and "maxDepth" in params:
        raise ValueError(f"a tree without a limit needs a depth of at most {MAX_DEPTH}")
    if depth is not None and depth > MAX_DEPTH:
        raise ValueError(f"depth {depth} is more than {MAX_DEPTH}")
    return depth


def _estimator(spec: ModelSpec, label: str, weight_sum: float) -> Pipeline:
    own = ("positive_weight", "C", "maxDepth", "maxLeaves")
    params = {k: v for k, v in spec.params.items() if k not in own}
    depth = tree_depth(spec.params)
    if depth is not None:
        params["maxDepth"] = depth
    common = {"labelCol": label, "weightCol": WEIGHT}
    if spec.family == "logistic":
        return Pipeline(
            stages=[
                VectorAssembler(inputCols=MODEL_FEATURES, outputCol="_raw"),
                StandardScaler(inputCol="_raw", outputCol="features", withMean=True),
                LogisticRegression(
                    maxIter=1000,
                    regParam=1.0 / (float(spec.params.get("C", 1.0)) * weight_sum),
                    elasticNetParam=0.0,
                    standardization=False,
                    **common,
                    **params,
                ),
            ]
        )
    kinds = {"forest": RandomForestClassifier, "boosted": GBTClassifier}
    if spec.family not in kinds:
        raise ValueError(f"unknown model family {spec.family!r}")
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features"),
            kinds[spec.family](seed=SEED, **common, **params),
        ]
    )


def tree_tasks(n: int) -> int:
    """Tasks of a job that grows trees on ``n`` rows.

    Each job returns some kilobytes a task to the driver and costs some milliseconds a task,
    whatever the rows, so the number follows the rows and not the files they lie in.
    """
    return max(1, min(FEW_TASKS, -(-n // LEAST_ROWS)), -(-n // MOST_ROWS))


def fit_model(train: DataFrame, spec: ModelSpec, label: str = TARGET) -> PipelineModel:
    """Fit one model on all rows given."""
    positive_weight = spec.params.get("positive_weight")
    weighted = add_class_weight(train, positive_weight, label).withColumn(
        label, F.col(label).cast("double")
    )
    weight_sum = 1.0
    if spec.family == "logistic":
        weight_sum = weighted.agg(F.sum(WEIGHT)).first()[0]
    else:
        n = train.count()
        if n > LEAST_ROWS:  # fewer rows stay as they lie
            weighted = weighted.coalesce(tree_tasks(n))
    return _estimator(spec, label, weight_sum).fit(weighted)


def fit_models(
    train: DataFrame, specs: Mapping[str, ModelSpec], parallelism: int = 4, label: str = TARGET
) -> dict[str, PipelineModel]:
    """Fit independent models, ``parallelism`` at a time; the rows are read once into a table."""
    rows = materialise(train)
    with ThreadPool(max(1, min(parallelism, len(specs)))) as pool:
        fitted = pool.map(lambda spec: fit_model(rows, spec, label), list(specs.values()))
    return dict(zip(specs, fitted))


def score_rows(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Add the probability of the positive class; all input columns stay."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))


def sample_params(
    grid: Mapping[str, Sequence[Any]], n_iter: int, seed: int = SEED
) -> list[dict[str, Any]]:
    """Different combinations drawn from a grid."""
    names = sorted(grid)
    every = list(product(*[grid[n] for n in names]))
    drawn = random.Random(seed).sample(every, min(n_iter, len(every)))
    return [dict(zip(names, values)) for values in drawn]


def _scored_folds(folds: DataFrame, models: Sequence[PipelineModel]) -> DataFrame:
    """Every fold above zero with the scores of its own model."""
    return union_all(
        [
            score_rows(model, folds.filter(F.col("fold") == fold))
            for fold, model in enumerate(models, 1)
        ]
    )


def out_of_fold_scores(
    folds: DataFrame, spec: ModelSpec, n_splits: int = 3, label: str = TARGET
) -> DataFrame:
    """Score every fold with a model fitted on the folds before it."""
    before = [folds.filter(F.col("fold") < fold) for fold in range(1, n_splits + 1)]
    return _scored_folds(folds, [fit_model(rows, spec, label) for rows in before])


def fit_with_folds(
    folds: DataFrame,
    spec: ModelSpec,
    n_splits: int = 3,
    parallelism: int = 4,
    label: str = TARGET,
) -> tuple[PipelineModel, DataFrame]:
    """The model of all rows, and ``out_of_fold_scores``.

    The fits are independent and run ``parallelism`` at a time, the largest first; give a
    stored frame, as each reads it.
    """
    sets = [folds.filter(F.col("fold") < fold) for fold in range(n_splits, 0, -1)]
    sets = [folds.drop("fold"), *sets]
    with ThreadPool(max(1, min(parallelism, len(sets)))) as pool:
        fitted = pool.map(lambda rows: fit_model(rows, spec, label), sets, chunksize=1)
    return fitted[0], _scored_folds(folds, fitted[:0:-1])


def randomised_search(
    folds: DataFrame,
    family: str,
    grid: Mapping[str, Sequence[Any]],
    n_iter: int = 15,
    n_splits: int = 3,
    label: str = TARGET,
    seed: int = SEED,
    parallelism: int = 4,
) -> list[tuple[ModelSpec, float]]:
    """Mean average precision over the expanding folds, best first.

    Logistic regressions of all draws and folds are solved together (``newton``). Trees are
    fitted ``parallelism`` draws at a time. The scores of all draws are ranked in one pass,
    grouped by draw and fold.
    """
    rows = materialise(folds)
    drawn = sample_params(grid, n_iter, seed)
    specs = [ModelSpec(family, params) for params in drawn]

    def scores(draw: int) -> DataFrame:
        scored = out_of_fold_scores(rows, specs[draw], n_splits, label)
        return scored.select(F.lit(draw).alias("draw"), "fold", F.col(label).alias("y"), "p")

    if family == "logistic":
        models = fit_together(rows, search_fits(drawn, n_splits), label=label)
        scored = score_folds(rows, models, label=label)
        every = scored.withColumn("draw", F.col("name").cast("int"))
    else:
        with ThreadPool(max(1, min(parallelism, len(specs)))) as pool:
            every = union_all(pool.map(scores, range(len(specs))))
    per_fold = evaluate_model(every, group=["draw", "fold"])
    means = {
        r["draw"]: r["mean"]  # one row per draw
        for r in per_fold.groupBy("draw").agg(F.avg("pr_auc").alias("mean")).collect()
    }
    results = [(spec, float(means.get(k) or 0.0)) for k, spec in enumerate(specs)]
    return sorted(results, key=lambda r: -r[1])


def search_report(folds: DataFrame, results: Sequence[tuple[ModelSpec, float]]) -> DataFrame:
    """Search results as a frame."""
    rows = [
        (i, s.family, str(sorted(s.params.items(), key=str)), score)
        for i, (s, score) in enumerate(results, 1)
    ]
    return folds.sparkSession.createDataFrame(
        rows, "place int, family string, params string, mean_pr_auc double"
    )


def compare_models(
    models: Mapping[str, PipelineModel], df: DataFrame, label: str = TARGET
) -> DataFrame:
    """Metrics of every model on the same rows, best average precision first."""
    scored = [
        score_rows(m, df).select(F.lit(name).alias("model"), F.col(label).alias("y"), "p")
        for name, m in models.items()
    ]
    return evaluate_model(union_all(scored), group=["model"]).orderBy(
        F.desc("pr_auc"), "model"
    )


def fit_calibrator(
    scored: DataFrame, label: str = TARGET, score: str = "p"
) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on the log-odds of a score."""
    rows = VectorAssembler(inputCols=["_logit"], outputCol="features").transform(
        scored.select(F.col(label).cast("double").alias("y"), logit(F.col(score)).alias("_logit"))
    )
    rows = materialise(rows)
    model = LogisticRegression(
        labelCol="y", maxIter=1000, regParam=1.0 / rows.count(), standardization=False
    ).fit(rows)
    return float(model.coefficients[0]), float(model.intercept)


def numbered_rows(
    df: DataFrame, keys: Sequence[str] = ("visitorid", "snapshot_day"), label: str = TARGET
) -> DataFrame:
    """Keys, label and features with ``_n``, 1 to the number of rows in the order of the keys.

    The only ordering that permutation importance needs, stored for all its repeats.
    """
    rows = df.select(*keys, label, *MODEL_FEATURES)
    return materialise(running_totals(rows, order=[F.asc(k) for k in keys], sums={}, rank="_n"))


def shuffled_features(numbered: DataFrame, n: int, seed: int) -> DataFrame:
    """The rows with a second set of features, ``_s_<name>``, taken from another row each.

    A row's features go to the number that a seeded bijection gives, so each is used once.
    """
    goes_to = (permuted(F.col("_n") - 1, n, seed) + 1).alias("_n")
    moved = numbered.select(goes_to, *[F.col(c).alias(f"_s_{c}") for c in MODEL_FEATURES])
    return numbered.join(moved, "_n")


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    keys: Sequence[str] = ("visitorid", "snapshot_day"),
    label: str = TARGET,
    n_repeats: int = 5,
    seed: int = SEED,
) -> DataFrame:
    """Mean drop in average precision when one feature is shuffled.

    All features of a repeat share one random order, a bijection of the row numbers; their
    variants are scored and ranked together, grouped by repeat and feature. Rows are ordered
    once, whatever the repeats.
    """
    base = numbered_rows(df, keys, label)
    n = base.count()
    parts = []
    for repeat in range(n_repeats):
        both = shuffled_features(base, n, seed + repeat)
        variants = [
            F.struct(
                F.lit(shuffled).alias("feature"),
                *[
                    F.col(f"_s_{c}" if c == shuffled else c).cast("double").alias(c)
                    for c in MODEL_FEATURES
                ],
            )
            for shuffled in MODEL_FEATURES
        ]
        parts.append(
            both.select(
                F.col(label).alias("y"), F.lit(repeat).alias("repeat"), F.inline(F.array(*variants))
            )
        )
    shuffled = evaluate_model(
        score_rows(model, union_all(parts)), group=["repeat", "feature"]
    )
    own = evaluate_model(score_rows(model, base).withColumnRenamed(label, "y"))
    intact = own.select("pr_auc").scalar()
    return (
        shuffled.groupBy("feature")
        .agg((F.max(intact) - F.avg("pr_auc")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
