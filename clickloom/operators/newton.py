"""Many weighted logistic regressions solved together.

A search over draws and expanding folds asks for the same sums over the same rows, only with
other coefficients. One scan of the stored rows gives the gradients and second derivatives of
all fits that are still open; each then takes its own Newton step, halved where its objective
rose. The scans are as many as the slowest fit has steps, however many fits there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import materialise
from ..schemas import MODEL_FEATURES, TARGET

MAX_STEPS = 100
TOLERANCE = 1e-10  # of the gradient, relative to the sum of the weights


@dataclass(frozen=True)
class LogisticFit:
    """One regression: the rows of folds below ``fold``, or all, with an L2 penalty of 1 / C.

    ``positive_weight`` is that of a positive row, ``"balanced"``, or None.
    """

    fold: int | None = None
    C: float = 1.0
    positive_weight: float | str | None = None
    name: Any = None


@dataclass
class LogisticModel:
    fit: LogisticFit
    intercept: float
    slopes: list[float]  # of the features as given
    scaled: list[float]  # intercept and slopes of the standardised features
    steps: int
    rows: int
    positives: int
    weights: tuple[float, float]  # of a negative and of a positive row
    folds: list[int]  # whose rows it saw
    means: list[float] = field(repr=False, default_factory=list)
    inverse: list[float] = field(repr=False, default_factory=list)  # 1 / sample deviation, or 0


@dataclass
class _Moments:
    n: int
    positives: int
    mean: np.ndarray
    squares: np.ndarray  # sums of squared deviations

    def join(self, other: _Moments) -> _Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        return _Moments(
            n,
            self.positives + other.positives,
            self.mean + apart * (other.n / n),
            self.squares + other.squares + apart**2 * (self.n * other.n / n),
        )


def stored_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``fold, y`` and the features as doubles, in a table; rows without a label have no part."""
    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(0)
    return materialise(
        df.filter(F.col(label).isNotNull()).select(
            fold.alias("fold"),
            F.col(label).cast("double").alias("y"),
            *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
        )
    )


def _moments(rows: DataFrame, d: int) -> dict[int, _Moments]:
    """By fold; a feature without a value is refused."""
    names = [f"x{i}" for i in range(d)]
    found = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("y") == 1).alias("positives"),
        *[F.count(c).alias(f"{c}_n") for c in names],
        *[F.avg(c).alias(f"{c}_m") for c in names],
        *[F.var_pop(c).alias(f"{c}_v") for c in names],
    )
    out = {}
    for r in found.collect():  # one row a fold
        if any(r[f"{c}_n"] < r["n"] for c in names):
            raise ValueError("a feature is null")
        squares = np.array([r[f"{c}_v"] for c in names]) * r["n"]
        out[r["fold"]] = _Moments(r["n"], r["positives"], np.array([r[f"{c}_m"] for c in names]), squares)
    return out


def _class_weights(fit: LogisticFit, m: _Moments) -> tuple[float, float]:
    if fit.positive_weight is None:
        return 1.0, 1.0
    if fit.positive_weight in ("balanced", "balanced_subsample"):
        return m.n / (2.0 * max(m.n - m.positives, 1)), m.n / (2.0 * max(m.positives, 1))
    return 1.0, float(fit.positive_weight)


def _scan(rows: DataFrame, d: int, asked: list[tuple]) -> dict[int, np.ndarray]:
    """Sums of every asked fit: d + 1 of the gradient, the upper triangle of the second
    derivatives, and the loss. ``asked``: number, fold, means, inverse deviations, class
    weights and coefficients."""
    k = d + 1
    upper = np.triu_indices(k)
    groups: dict[Any, list] = {}
    for own in asked:
        groups.setdefault(own[1], []).append(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {own[0]: np.zeros(k + len(upper[0]) + 1) for own in asked}
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            y_all = batch.column(1).to_numpy(zero_copy_only=False)
            x_all = np.column_stack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(d)])
            for limit, fits in groups.items():
                chosen = slice(None) if limit is None else fold < limit
                y = y_all[chosen]
                if not len(y):
                    continue
                # All fits of a fold have one standardisation.
                x = np.column_stack([np.ones(len(y)), (x_all[chosen] - fits[0][2]) * fits[0][3]])
                pairs = x[:, upper[0]] * x[:, upper[1]]
                w = np.where(y[:, None] == 1, [f[4][1] for f in fits], [f[4][0] for f in fits])
                m = x @ np.array([f[5] for f in fits]).T
                p = 0.5 * (1.0 + np.tanh(0.5 * m))
                # log(1 + exp(m)) - y m without overflow
                loss = w * (np.maximum(m, 0) + np.log1p(np.exp(-np.abs(m))) - y[:, None] * m)
                gradient = x.T @ (w * (p - y[:, None]))
                second = pairs.T @ (w * p * (1 - p))
                sums = np.vstack([gradient, second, loss.sum(axis=0)])
                for at, own in enumerate(fits):
                    total[own[0]] += sums[:, at]
        size = k + len(upper[0]) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(list(total), size).astype(np.int32)),
                pa.array(np.tile(np.arange(size, dtype=np.int32), len(total))),
                pa.array(np.concatenate(list(total.values()))),
            ],
            names=["number", "term", "value"],
        )

    parts = rows.mapInArrow(run, "number int, term int, value double")
    summed = parts.groupBy("number", "term").agg(F.sum("value").alias("value"))
    out = {own[0]: np.zeros(k + len(upper[0]) + 1) for own in asked}
    for number, term, value in summed.collect():  # fits x 45 for seven features
        out[number][term] = value
    return out


def fit_together(
    df: DataFrame,
    fits: Sequence[LogisticFit],
    features: Sequence[str] = MODEL_FEATURES,
    label: str = TARGET,
) -> list[LogisticModel]:
    """Solve every fit on the rows of ``df``; with folds, ``df`` carries ``fold``.

    Features are centred and divided by their sample deviation over the rows of the fit, the
    intercept has no penalty, and the sum of weighted losses plus squares / 2 C is minimal.
    A constant feature has slope 0. A fit without rows is refused. Where one class is missing
    there is no minimum; the intercept then grows until the gradient is below the tolerance.
    """
    d, k = len(features), len(features) + 1
    rows = stored_rows(df, features, label)
    by_fold = _moments(rows, d)
    upper = np.triu_indices(k)
    nothing = _Moments(0, 0, np.zeros(d), np.zeros(d))
    models: list[LogisticModel] = []
    for fit in fits:
        m = nothing
        seen = [f for f in sorted(by_fold) if fit.fold is None or f < fit.fold]
        for fold in seen:
            m = m.join(by_fold[fold])
        if not m.n:
            raise ValueError(f"no rows below fold {fit.fold}")
        deviation = np.sqrt(m.squares / max(m.n - 1, 1))
        inverse = np.where(deviation > 0, 1.0 / np.where(deviation > 0, deviation, 1.0), 0.0)
        models.append(
            LogisticModel(
                fit, 0.0, [], [0.0] * k, 0, m.n, m.positives, _class_weights(fit, m),
                seen, m.mean.tolist(), inverse.tolist(),
            )
        )
    trial = {i: np.zeros(k) for i in range(len(models))}
    best: dict[int, tuple[float, np.ndarray]] = {}
    step: dict[int, tuple[np.ndarray, float]] = {}
    for _ in range(MAX_STEPS):
        if not trial:
            break
        asked = [
            (i, models[i].fit.fold, np.array(models[i].means), np.array(models[i].inverse), models[i].weights, b)
            for i, b in trial.items()
        ]
        sums = _scan(rows, d, asked)
        following = {}
        for i, beta in trial.items():
            own, penalty = models[i], np.r_[0.0, np.full(d, 1.0 / models[i].fit.C)]
            objective = sums[i][-1] + 0.5 * float(penalty @ beta**2)
            own.steps += 1
            if i in best and objective > best[i][0] * (1 + 1e-13):
                direction, share = step[i][0], step[i][1] / 2
                if share < 1e-9:  # no better point in floating numbers
                    continue
                step[i] = (direction, share)
                following[i] = best[i][1] + share * direction
                continue
            best[i] = (objective, beta)
            gradient = sums[i][:k] + penalty * beta
            size = own.weights[0] * (own.rows - own.positives) + own.weights[1] * own.positives
            if np.abs(gradient).max() <= TOLERANCE * size:
                continue
            second = np.zeros((k, k))
            second[upper] = sums[i][k:-1]
            second = second + np.triu(second, 1).T + np.diag(penalty)
            try:
                direction = -np.linalg.solve(second, gradient)
            except np.linalg.LinAlgError:
                direction = -np.linalg.lstsq(second, gradient, rcond=None)[0]
            step[i] = (direction, 1.0)
            following[i] = beta + direction
        trial = following
    for i, own in enumerate(models):
        scaled = best[i][1]
        slopes = scaled[1:] * np.array(own.inverse)
        own.scaled = scaled.tolist()
        own.slopes = slopes.tolist()
        own.intercept = float(scaled[0] - slopes @ np.array(own.means))
    return models


def score_folds(
    df: DataFrame,
    models: Sequence[LogisticModel],
    features: Sequence[str] = MODEL_FEATURES,
    label: str = TARGET,
) -> DataFrame:
    """``name, fold, y, p``: every row scored by the models that saw only smaller folds.

    The models are a table of one row each, so their number does not change the plan.
    """
    table = df.sparkSession.createDataFrame(
        [(str(m.fit.name), m.fit.fold, [m.intercept, *m.slopes]) for m in models],
        "name string, fold int, b array<double>",
    )
    margin = F.get("b", F.lit(0))
    for i, c in enumerate(features):
        margin = margin + F.get("b", F.lit(i + 1)) * F.col(c)
    rows = df.select(F.col("fold").cast("int").alias("fold"), F.col(label).alias("y"), *features)
    return rows.join(F.broadcast(table), "fold").select(
        "name", "fold", "y", (1.0 / (1.0 + F.exp(-margin))).alias("p")
    )


def score_equations(
    df: DataFrame,
    models: Sequence[LogisticModel],
    features: Sequence[str] = MODEL_FEATURES,
    label: str = TARGET,
) -> DataFrame:
    """``name, fold, rows, positives, left``: what each fit leaves of its equations.

    ``left`` is the largest term of the gradient, relative to the sum of the weights, computed
    in columns from the rows and the coefficients alone. It is 0 at the optimum, and nowhere
    else.
    """
    names = [f"g{i}" for i in range(len(features) + 1)]
    # A row meets the fits that saw its fold, by equal folds; the table is bounded by them.
    table = df.sparkSession.createDataFrame(
        [
            (
                number, str(m.fit.name), m.fit.fold, fold, m.weights[0], m.weights[1],
                m.scaled, m.means, m.inverse, 1.0 / m.fit.C,
            )
            for number, m in enumerate(models)
            for fold in m.folds
        ],
        "number int, name string, until int, fold int, negative double, positive double, "
        "b array<double>, mean array<double>, inverse array<double>, penalty double",
    )
    fold = F.col("fold") if "fold" in df.columns else F.lit(0)
    rows = df.filter(F.col(label).isNotNull()).select(
        fold.alias("fold"), F.col(label).alias("y"), *[F.col(c).cast("double") for c in features]
    )
    x = [F.lit(1.0)] + [
        (F.col(c) - F.get("mean", F.lit(i))) * F.get("inverse", F.lit(i)) for i, c in enumerate(features)
    ]
    margin = sum((F.get("b", F.lit(i)) * v for i, v in enumerate(x)), F.lit(0.0))
    weight = F.when(F.col("y") == 1, F.col("positive")).otherwise(F.col("negative"))
    wrong = weight * (1.0 / (1.0 + F.exp(-margin)) - F.col("y"))
    totals = (
        rows.join(F.broadcast(table), "fold")
        .groupBy("number", "name", "until", "b", "penalty")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("y") == 1).alias("positives"),
            F.sum(weight).alias("size"),
            *[F.sum(wrong * v).alias(g) for g, v in zip(names, x)],
        )
    )
    terms = [F.abs(F.col("g0"))] + [
        F.abs(F.col(g) + F.col("penalty") * F.get("b", F.lit(i))) for i, g in enumerate(names) if i
    ]
    return totals.select(
        "name",
        F.col("until").alias("fold"),
        "rows",
        "positives",
        (F.greatest(*terms) / F.col("size")).alias("left"),
    )


def search_fits(draws: Sequence[Mapping[str, Any]], n_splits: int) -> list[LogisticFit]:
    """One fit for each draw of parameters and fold."""
    return [
        LogisticFit(fold, float(p.get("C", 1.0)), p.get("positive_weight"), number)
        for number, p in enumerate(draws)
        for fold in range(1, n_splits + 1)
    ]
