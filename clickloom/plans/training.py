"""From candidate models to the calibrated scorer of the best one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import materialise
from ..operators.score import PurchaseScorer
from ..operators.split import development_set, expanding_folds
from ..operators.train import (
    ModelSpec,
    compare_models,
    fit_calibrator,
    fit_models,
    fit_with_folds,
)


def refit(
    rows: DataFrame, spec: ModelSpec, n_splits: int = 3, parallelism: int = 4
) -> PurchaseScorer:
    """Fit on train and validation rows, with a calibrator from out-of-fold scores."""
    development = development_set(rows).drop("split")
    folds = materialise(expanding_folds(development, n_splits))
    model, scored = fit_with_folds(folds, spec, n_splits, parallelism)
    slope, intercept = fit_calibrator(scored)
    return PurchaseScorer(model, slope, intercept)


def select_model(
    rows: DataFrame, candidates: Mapping[str, ModelSpec], parallelism: int = 4
) -> tuple[str, DataFrame]:
    """The candidate with the best average precision on the validation rows, and the metrics
    of all, stored. Every candidate is fitted on the train rows only."""
    models = fit_models(rows.filter(F.col("split") == "train"), candidates, parallelism)
    report = compare_models(models, rows.filter(F.col("split") == "validation"))
    stored = materialise(report)
    first = stored.orderBy(F.desc("pr_auc"), "model").select("model").first()
    return first[0], stored


def select_and_refit(
    rows: DataFrame, candidates: Mapping[str, ModelSpec], n_splits: int = 3, parallelism: int = 4
) -> tuple[str, PurchaseScorer]:
    """The best candidate (``select_model``) and its scorer; ``rows`` carry ``split``."""
    winner, _ = select_model(rows, candidates, parallelism)
    return winner, refit(rows, candidates[winner], n_splits, parallelism)
