"""Batch scoring: the calibrated scorer, its persistence, and predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.probability import calibrate_probability
from ..schemas import COUNT_FEATURES, MODEL_FEATURES, RATE_FEATURES
from .split import interaction_filter
from .train import score_rows

PROBABILITY = "purchase_probability"
# Tolerances of the reload check.
RELATIVE_TOLERANCE = 1e-10
ABSOLUTE_TOLERANCE = 1e-12


@dataclass(frozen=True)
class PurchaseScorer:
    """Base model followed by Platt calibration."""

    model: PipelineModel
    slope: float
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the raw and the calibrated probability."""
        scored = score_rows(self.model, df, "raw_probability")
        return scored.withColumn(
            PROBABILITY,
            calibrate_probability(F.col("raw_probability"), self.slope, self.intercept),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame(
            [(self.slope, self.intercept)], "slope double, intercept double"
        ).write.mode("overwrite").parquet(f"{path}/calibrator")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PurchaseScorer:
        row = spark.read.parquet(f"{path}/calibrator").first()
        return PurchaseScorer(
            PipelineModel.load(f"{path}/model"), row["slope"], row["intercept"]
        )


def prediction_difference(
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    column: str = PROBABILITY,
    rtol: float = RELATIVE_TOLERANCE,
    atol: float = ABSOLUTE_TOLERANCE,
) -> DataFrame:
    """Largest absolute difference of two scored frames, and whether all are close.

    A row missing on one side counts as not close.
    """
    keys = list(keys)
    a = first.select(*keys, F.col(column).alias("_a"))
    b = second.select(*keys, F.col(column).alias("_b"))
    difference = F.abs(F.col("_a") - F.col("_b"))
    close = F.coalesce(
        difference <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("_b")), F.lit(False)
    )
    return a.join(b, keys, "full").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(difference).alias("max_difference"),
        F.coalesce(F.bool_and(close), F.lit(True)).alias("all_close"),
    )


def rank_predictions(
    scored: DataFrame, keys: Sequence[str] = ("visitorid", "snapshot_day")
) -> DataFrame:
    """Keys and probability, highest first."""
    return scored.select(*keys, PROBABILITY).orderBy(F.desc(PROBABILITY), *keys)


def prepare_inference_data(gold: DataFrame) -> DataFrame:
    """Visitors of the latest snapshot with enough interactions, and their features."""
    latest = gold.agg(F.max("snapshot_day")).scalar()
    return interaction_filter(gold.filter(F.col("snapshot_day") == latest)).select(
        "visitorid", *MODEL_FEATURES
    )


def fix_types(df: DataFrame) -> DataFrame:
    """Model input types: counts as int, rates as double."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("int") for c in COUNT_FEATURES},
            **{c: F.col(c).cast("double") for c in RATE_FEATURES},
        }
    )


def predict(
    scorer: PurchaseScorer | Callable[[DataFrame], DataFrame], inference: DataFrame
) -> DataFrame:
    """Purchase probability per visitor; the id travels with the features."""
    apply = scorer.transform if isinstance(scorer, PurchaseScorer) else scorer
    return apply(fix_types(inference)).select("visitorid", PROBABILITY)
