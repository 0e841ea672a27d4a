"""Classification metrics, curves and reports from (label, score) rows.

Scores are first collapsed to one row per distinct score with its positives and
negatives; running totals over those give every rank metric. ``group`` computes
several models or variants at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import quantile_label, running_totals
from ..functions.radix import exact_quantiles
from ..functions.storage import materialise

# Reported thresholds and shares.
THRESHOLDS = [0.01, 0.05, 0.10, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90]
TOP_SHARES = [0.001, 0.005, 0.01, 0.02, 0.05, 0.10]


def judged(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Rows with a label and a score that is a number; no metric counts the others."""
    known = F.col(label).isNotNull() & F.col(score).isNotNull()
    return scored.filter(known & ~F.isnan(F.col(score).cast("double")))


def score_counts(
    scored: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score."""
    y = F.col(label).cast("long")
    rows = judged(scored, label, score)
    return rows.groupBy(*group, F.col(score).cast("double").alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )


def score_curve(
    scored: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = ()
) -> DataFrame:
    """True and false positives when every score at or above a row's is predicted
    positive; with the totals of the group."""
    return running_totals(
        score_counts(scored, label, score, group),
        order=[F.desc("score")],
        sums={"tp": F.col("pos"), "fp": F.col("neg")},
        group=group,
        totals=True,
    )


def evaluate_model(
    scored: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = ()
) -> DataFrame:
    """ROC AUC, average precision and Brier score, one row per group.

    A metric that needs both classes is null when one is missing.
    """
    curve = score_curve(scored, label, score, group)
    pos, neg, p = F.col("pos"), F.col("neg"), F.col("score")
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    # Trapezoids between neighbouring scores, and precision at every recall step.
    area = F.sum(neg * (tp - pos / 2.0))
    steps = F.sum(pos * tp / (tp + fp))
    squares = F.sum(pos * (p - 1) * (p - 1) + neg * p * p)
    positives, negatives = F.sum(pos), F.sum(neg)
    return curve.groupBy(*group).agg(
        F.try_divide(area, positives.cast("double") * negatives).alias("roc_auc"),
        F.try_divide(steps, positives.cast("double")).alias("pr_auc"),
        F.try_divide(squares, (positives + negatives).cast("double")).alias("brier_score"),
    )


def threshold_analysis(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    label: str = "y",
    score: str = "p",
) -> DataFrame:
    """Precision, recall and share predicted positive per threshold, in one pass."""
    y, p = F.col(label).cast("long"), F.col(score)

    def zero_if_undefined(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    rows = []
    for t in thresholds:
        chosen = p >= F.lit(float(t))
        hits = F.coalesce(F.sum(F.when(chosen, y)), F.lit(0))
        predicted = F.count_if(chosen)
        rows.append(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                zero_if_undefined(hits, predicted).alias("precision"),
                zero_if_undefined(hits, F.sum(y)).alias("recall"),
                zero_if_undefined(predicted, F.count(F.lit(1))).alias("predicted_positive_rate"),
            )
        )
    return judged(scored, label, score).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def ranking_analysis(
    scored: DataFrame,
    shares: Sequence[float] = TOP_SHARES,
    id_col: str = "id",
    label: str = "y",
    score: str = "p",
) -> DataFrame:
    """Precision, recall and lift among the best-scored share of rows.

    Equal scores are ordered by id. Lift is null when there is no positive. The cuts
    are found on distinct scores; only rows whose score lies on a cut are put in
    order.
    """
    curve = score_curve(scored, label, score).withColumn("rank_total", F.col("tp_total") + F.col("fp_total"))
    size = {k: F.greatest(F.ceil(F.col("rank_total") * F.lit(float(k))), F.lit(1)) for k in shares}
    cuts = F.array(
        *[F.struct(F.lit(float(k)).alias("top_k"), n.alias("n_users")) for k, n in size.items()]
    )
    upto = F.col("tp") + F.col("fp")
    before = upto - F.col("pos") - F.col("neg")
    at_score = materialise(  # one row per share
        curve.select("*", F.inline(cuts))
        .filter((before < F.col("n_users")) & (F.col("n_users") <= upto))
        .select(
            "top_k", "n_users", "score", "rank_total", F.col("tp_total").alias("hits_total"),
            (F.col("tp") - F.col("pos")).alias("hits_before"),
            (F.col("n_users") - before).alias("rank"),
        )
    )
    rows = judged(scored, label, score).select(
        id_col, F.col(label).cast("long").alias("_y"), F.col(score).cast("double").alias("score")
    )
    # The hint is safe: there are at most as many scores as shares.
    tied = rows.join(F.broadcast(at_score.select("score").distinct()), "score", "left_semi")
    ranked = running_totals(
        tied, order=[F.asc(id_col)], sums={"hits": F.col("_y")}, group=["score"], rank="rank"
    ).select("score", "rank", F.col("hits").alias("hits_within"))
    at_cut = at_score.join(ranked, ["score", "rank"]).withColumn(
        "hits", F.col("hits_before") + F.col("hits_within")
    )
    precision = F.col("hits") / F.col("n_users")
    report = at_cut.select(
        "top_k",
        "n_users",
        precision.alias("precision_at_k"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("hits_total")), F.lit(0.0)).alias(
            "recall_at_k"
        ),
        F.try_divide(precision, F.col("hits_total") / F.col("rank_total")).alias("lift_at_k"),
    )
    # One row per share. A global sort would first sample its input and so run the
    # pass over all rows a second time.
    return report.repartition(1).sortWithinPartitions("top_k")


def roc_points(
    scored: DataFrame,
    label: str = "y",
    score: str = "p",
    group: Sequence[str] = (),
    drop_intermediate: bool = True,
) -> DataFrame:
    """False and true positive rate at the distinct scores, and the origin.

    The origin has no threshold. With ``drop_intermediate`` a point is left out whose step is
    that of the next one, as it lies on a straight line; the first and the last point stay,
    and so does the area.
    """
    curve = running_totals(
        score_counts(scored, label, score, group),
        order=[F.desc("score")],
        sums={"tp": F.col("pos"), "fp": F.col("neg")},
        group=group,
        totals=True,
        following=("pos", "neg"),
        order_key=-F.col("score"),
    )
    points = curve
    if drop_intermediate:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        same = (F.col("following.pos") == F.col("pos")) & (F.col("following.neg") == F.col("neg"))
        points = curve.filter(first | F.col("following").isNull() | ~same)
    points = points.select(
        *group,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("fp_total")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("tp_total")).alias("tpr"),
    )
    return points.unionByName(_end_point(curve, group, {"fpr": 0.0, "tpr": 0.0}))


def precision_recall_points(
    scored: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall at every distinct score, the closing point (0, 1), and
    the share of positives as baseline."""
    curve = score_curve(scored, label, score, group)
    share = F.col("tp_total") / (F.col("tp_total") + F.col("fp_total"))
    points = curve.select(
        *group,
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp_total")).alias("recall"),
        share.alias("baseline"),
    )
    end = _end_point(curve.withColumn("baseline", share), [*group, "baseline"],
                     {"precision": 1.0, "recall": 0.0})
    return points.unionByName(end)


def _end_point(curve: DataFrame, keys: Sequence[str], values: dict[str, float]) -> DataFrame:
    """One constant point per group."""
    one = curve.select(*keys).distinct() if keys else curve.agg(F.count(F.lit(1)).alias("_n"))
    return one.select(
        *keys,
        F.lit(None).cast("double").alias("threshold"),
        *[F.lit(v).alias(n) for n, v in values.items()],
    )


def calibration_points(
    scored: DataFrame, n_bins: int = 10, label: str = "y", score: str = "p"
) -> DataFrame:
    """Mean score and observed rate per quantile bin of the score.

    A score equal to an inner edge belongs to the bin below it.
    """
    inner = [i / n_bins for i in range(1, n_bins)]
    edges = exact_quantiles(scored.select(F.col(score).alias("_p")), ["_p"], inner)
    one = edges.select(F.struct(*[quantile_label(q) for q in inner])).scalar()
    below = [(one[quantile_label(q)] < F.col(score)).cast("int") for q in inner]
    binned = reduce(lambda a, b: a + b, below, F.lit(0))
    return (
        scored.withColumn("bin", binned)
        .groupBy("bin")
        .agg(
            F.avg(score).alias("mean_predicted"),
            F.avg(F.col(label).cast("double")).alias("observed_rate"),
            F.count(F.lit(1)).alias("rows"),
        )
        .orderBy("bin")
    )


def compare_scores(scored: DataFrame, scores: dict[str, str], label: str = "y") -> DataFrame:
    """The three metrics for several score columns of the same rows."""
    variants = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(column).alias("p"))
            for name, column in scores.items()
        ]
    )
    long = scored.select(F.col(label).alias("y"), F.inline(variants))
    return evaluate_model(long, group=["model"])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
