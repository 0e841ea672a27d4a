"""Raw click events and the bronze projection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LONG_WINDOW_DAYS, RAW_EVENTS_CSV


def read_raw_events(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Scan one or more directories of Parquet event files as one table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_raw_events_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan the original CSV log; the time is given in epoch milliseconds."""
    raw = spark.read.schema(RAW_EVENTS_CSV).option("header", True).csv(path)
    return raw.withColumn("timestamp", F.timestamp_millis("timestamp"))


def get_reference_date(df: DataFrame, ts_col: str = "timestamp") -> dt.date:
    """Latest event date. One row comes back to the driver, so that the window
    filter below is a literal which the Parquet scan can use to skip row groups.
    """
    latest = df.agg(F.max(ts_col).alias("latest")).select(F.to_date("latest")).first()[0]
    if latest is None:
        raise ValueError("raw events are empty: no reference date")
    return latest


def filter_feature_window(
    df: DataFrame,
    reference_date: dt.date,
    history_days: int = LONG_WINDOW_DAYS,
    ts_col: str = "timestamp",
) -> DataFrame:
    """Keep ``history_days`` before the reference date, and that date itself.

    With the default, popularity on the oldest cart days is summed over a
    shortened history; ``history_days=36`` makes every such window complete.
    """
    start = reference_date - dt.timedelta(days=history_days)
    return df.filter(F.to_date(ts_col).between(F.lit(start), F.lit(reference_date)))


def cast_to_bronze(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Normalise raw columns into the bronze layout."""
    return df.select(
        F.col(ts_col).alias("event_time"),
        F.col("visitorid").cast("long").alias("visitorid"),
        F.col("event"),
        F.col("itemid").cast("long").alias("itemid"),
        F.col("transactionid").cast("long").alias("transactionid"),
    )


def write_monthly_events(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """One Parquet folder per month, each file sorted by time.

    Range partitioning by time gives a large month several files and keeps
    their time ranges apart.
    """
    (
        df.withColumn("year_month", F.date_format(ts_col, "yyyy-MM"))
        .repartitionByRange("year_month", ts_col)
        .sortWithinPartitions("year_month", ts_col)
        .write.mode("overwrite")
        .partitionBy("year_month")
        .parquet(path)
    )


def convert_events(spark: SparkSession, csv_path: str | list[str], out_path: str) -> None:
    """CSV log to monthly Parquet."""
    write_monthly_events(read_raw_events_csv(spark, csv_path), out_path)


def monthly_volume(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Rows per month before and after exact de-duplication."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.groupBy(F.date_format(ts_col, "yyyy-MM").alias("year_month")).agg(
        F.sum("_copies").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )
