"""Training-set preparation: filters, chronological split, folds, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running_totals
from ..schemas import INTERACTION_FEATURES, MIN_INTERACTIONS, MODEL_FEATURES, TARGET

# Shares of the distinct dates at which validation and test start.
TRAIN_SHARE = 0.60
VALIDATION_SHARE = 0.80


def enough_interactions(minimum: int = MIN_INTERACTIONS) -> Column:
    total = F.col(INTERACTION_FEATURES[0])
    for name in INTERACTION_FEATURES[1:]:
        total = total + F.col(name)
    return total >= minimum


def interaction_filter(df: DataFrame, minimum: int = MIN_INTERACTIONS) -> DataFrame:
    """Keep rows with enough recent views, cart additions and transactions."""
    return df.filter(enough_interactions(minimum))


def temporal_boundaries(df: DataFrame, feature_days: int = 30, target_days: int = 6) -> DataFrame:
    """Drop the first days, which lack history, and the last, which lack outcome.

    The bounds follow the rows given, so filter interactions first. The frame is
    read twice, so give it a stored one.
    """
    span = df.agg(
        F.struct(F.min("snapshot_day").alias("lo"), F.max("snapshot_day").alias("hi"))
    ).scalar()
    day = F.col("snapshot_day")
    return df.filter((day >= span["lo"] + feature_days) & (day <= span["hi"] - target_days))


def chronological_split(
    df: DataFrame, train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE
) -> DataFrame:
    """Label rows train, validation or test by position of their day.

    The cut days are picked from the sorted distinct days, at most one value per
    calendar day.
    """
    days = df.agg(F.sort_array(F.collect_set("snapshot_day")).alias("days"))
    at = lambda share: F.element_at(
        "days", F.floor(F.size("days") * F.lit(share)).cast("int") + 1
    )
    cuts = days.select(F.struct(at(train).alias("c1"), at(validation).alias("c2"))).scalar()
    day = F.col("snapshot_day")
    return df.withColumn(
        "split",
        F.when(day < cuts["c1"], "train").when(day < cuts["c2"], "validation").otherwise("test"),
    )


def split_report(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Period, size, positive rate and class counts per split."""
    positive = F.col(label).cast("long")
    return df.groupBy("split").agg(
        F.min("snapshot_day").alias("first_day"),
        F.max("snapshot_day").alias("last_day"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(positive).alias("positives"),
        F.sum(1 - positive).alias("negatives"),
        F.avg(positive).alias("positive_rate"),
        F.avg(1 - positive).alias("negative_rate"),
    )


def development_set(df: DataFrame) -> DataFrame:
    """Train and validation rows, by date."""
    return df.filter(F.col("split").isin("train", "validation")).orderBy(
        "snapshot_day", "visitorid"
    )


def features_and_label(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Keys, the seven features and the label."""
    keep = [c for c in ("visitorid", "snapshot_day", "split") if c in df.columns]
    return df.select(*keep, *MODEL_FEATURES, F.col(label).cast("int").alias(label))


def expanding_folds(df: DataFrame, n_splits: int = 3) -> DataFrame:
    """Number rows 0 to n_splits in date order.

    Rows of fold f > 0 are validated by a model fitted on all smaller folds. Every
    fold above zero has n // (n_splits + 1) rows; the rest is fold 0. With fewer than
    n_splits + 1 rows there is no such division, and the query fails.
    """
    ranked = running_totals(
        df,
        order=[F.asc("snapshot_day"), F.asc("visitorid")],
        sums={},
        rank="_rank",
        totals=True,
    )
    enough = F.col("_rank_total") > n_splits
    too_few = F.raise_error(F.lit(f"{n_splits} folds need at least {n_splits + 1} rows"))
    size = F.when(enough, F.floor(F.col("_rank_total") / (n_splits + 1))).otherwise(
        too_few.cast("long")
    )
    from_end = F.floor((F.col("_rank_total") - F.col("_rank")) / size)
    fold = F.greatest(F.lit(n_splits) - from_end, F.lit(0)).cast("int")
    return ranked.withColumn("fold", fold).drop("_rank", "_rank_total")
