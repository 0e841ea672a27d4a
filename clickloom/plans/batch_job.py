"""The batch job, stage by stage over explicit paths or as one chain in memory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import count_copies, silver_rows
from ..operators.score import PurchaseScorer, predict, prepare_inference_data
from ..operators.snapshots import add_snapshot_day
from ..functions.storage import materialise
from ..schemas import LONG_WINDOW_DAYS
from ..sources.events import (
    cast_to_bronze,
    filter_feature_window,
    get_reference_date,
    read_raw_events,
)
from ..sources.layers import (
    read_bronze,
    read_gold,
    read_silver,
    write_bronze,
    write_gold,
    write_predictions,
    write_silver,
)
from .gold import build_gold

Scorer = PurchaseScorer | Callable[[DataFrame], DataFrame]


def ingest(raw: DataFrame, history_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """Raw events of the feature window in the bronze layout."""
    window = filter_feature_window(raw, get_reference_date(raw), history_days)
    return cast_to_bronze(window)


def run_ingestion(
    spark: SparkSession, raw_path: str, bronze_path: str, history_days: int = LONG_WINDOW_DAYS
) -> int:
    return write_bronze(ingest(read_raw_events(spark, raw_path), history_days), bronze_path)


def run_validation(
    spark: SparkSession, bronze_path: str, silver_path: str, quarantine_path: str
) -> dict[str, int]:
    return write_silver(read_bronze(spark, bronze_path), silver_path, quarantine_path)


def run_features(spark: SparkSession, silver_path: str, gold_path: str, **options) -> int:
    silver = add_snapshot_day(read_silver(spark, silver_path))
    return write_gold(build_gold(silver, **options), gold_path, by_day=True)


def run_scoring(
    spark: SparkSession, gold_path: str, predictions_path: str, scorer: Scorer
) -> int:
    inference = prepare_inference_data(read_gold(spark, gold_path))
    return write_predictions(predict(scorer, inference), predictions_path)


def run_all(
    spark: SparkSession,
    raw_path: str,
    out_dir: str,
    scorer: Scorer,
    history_days: int = LONG_WINDOW_DAYS,
) -> dict[str, int]:
    """All four stages through Parquet; returns the row count of every layer."""
    rows = {"bronze": run_ingestion(spark, raw_path, f"{out_dir}/bronze", history_days)}
    counts = run_validation(
        spark, f"{out_dir}/bronze", f"{out_dir}/silver", f"{out_dir}/quarantine"
    )
    rows["silver"], rows["quarantine"] = counts["valid_rows"], counts["quarantined_rows"]
    rows["gold"] = run_features(spark, f"{out_dir}/silver", f"{out_dir}/gold")
    rows["predictions"] = run_scoring(
        spark, f"{out_dir}/gold", f"{out_dir}/predictions", scorer
    )
    return rows


def score_raw_events(
    raw: DataFrame, scorer: Scorer, history_days: int = LONG_WINDOW_DAYS, **options
) -> DataFrame:
    """Raw events to predictions without writing the layers.

    Silver feeds many branches of the feature plan, so it is computed once.
    """
    silver = materialise(
        add_snapshot_day(silver_rows(count_copies(ingest(raw, history_days))))
    )
    gold = build_gold(silver, **options)
    return predict(scorer, prepare_inference_data(gold))
