"""Item property log and category tree files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CATEGORY_TREE_CSV, ITEM_PROPERTIES_CSV


def read_item_properties_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All parts of the property log as one table, time in epoch milliseconds."""
    raw = spark.read.schema(ITEM_PROPERTIES_CSV).option("header", True).csv(paths)
    return raw.withColumn("timestamp", F.timestamp_millis("timestamp"))


def write_item_properties(df: DataFrame, path: str) -> None:
    """Parquet in item and time order, split by range so that one item with a
    very long history is spread over several files."""
    (
        df.repartitionByRange("itemid", "timestamp")
        .sortWithinPartitions("itemid", "timestamp")
        .write.mode("overwrite")
        .parquet(path)
    )


def convert_item_properties(spark: SparkSession, csv_paths: list[str], out_path: str) -> None:
    write_item_properties(read_item_properties_csv(spark, csv_paths), out_path)


def convert_category_tree(spark: SparkSession, csv_path: str, out_path: str) -> None:
    (
        spark.read.schema(CATEGORY_TREE_CSV)
        .option("header", True)
        .csv(csv_path)
        .write.mode("overwrite")
        .parquet(out_path)
    )


def convert_all(
    spark: SparkSession,
    events_csv: str | list[str],
    property_csvs: list[str],
    tree_csv: str,
    out_dir: str,
) -> None:
    """The three conversions in sequence, below one output folder."""
    from .events import convert_events

    convert_events(spark, events_csv, f"{out_dir}/events")
    convert_item_properties(spark, property_csvs, f"{out_dir}/item_properties")
    convert_category_tree(spark, tree_csv, f"{out_dir}/category_tree")
