"""Parquet layers: bronze, silver, quarantine, gold, training and predictions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.storage import materialise
from ..schemas import BRONZE, BRONZE_COLUMNS, GOLD, SILVER
from ..operators.quality import count_copies, quarantine_rows, silver_rows


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan one layer.

    The files say what they hold; ``schema`` stands in for a layer written by event or day
    without any row, which has no file.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(schema).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, BRONZE)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver in bronze column order, with or without event folders."""
    return read_layer(spark, path, SILVER).select(*BRONZE_COLUMNS)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold, with or without day folders."""
    return read_layer(spark, path, GOLD)


def write_layer(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Overwrite one Parquet dataset and return its row count.

    The plan runs once; the count is taken from the file footers afterwards.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_bronze(df: DataFrame, path: str) -> int:
    return write_layer(df, path)


def write_gold(df: DataFrame, path: str, by_day: bool = False) -> int:
    """Overwrite gold; with ``by_day`` scoring reads one day's folder only.

    Ranges of (day, visitor) split a large day over as many tasks as its rows need.
    """
    if by_day:
        df = df.repartitionByRange("snapshot_day", "visitorid")
    return write_layer(df, path, "snapshot_day" if by_day else None)


def write_predictions(df: DataFrame, path: str) -> int:
    return write_layer(df, path)


def write_silver(
    bronze: DataFrame, silver_path: str, quarantine_path: str, by_event: bool = True
) -> dict[str, int]:
    """Classify bronze once and write both sinks; returns the row counts.

    With ``by_event`` silver has one folder per event type. The popularity
    features read carts and transactions only and then skip the views, which
    are nearly all of the data.
    """
    counted = materialise(count_copies(bronze))
    valid = write_layer(silver_rows(counted), silver_path, "event" if by_event else None)
    bad = write_layer(quarantine_rows(counted), quarantine_path)
    return {"total_rows": valid + bad, "valid_rows": valid, "quarantined_rows": bad}
