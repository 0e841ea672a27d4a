"""Click events, a catalogue and scored labels, derived from the test tables.

Every table is read whole; the derivations are plain projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_TYPES
from .events import cast_to_bronze

# How event names of the test table map to the event vocabulary.
EVENT_NAMES = {"view": "view", "click": "addtocart", "purchase": "transaction"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_name() -> Column:
    name = F.col("event_type")
    chain = None
    for source, target in EVENT_NAMES.items():
        chain = (F if chain is None else chain).when(name == source, target)
    return chain.otherwise(name)


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("visitorid"),
        _event_name().alias("event"),
        F.get_json_object("props", "$.k").cast("long").alias("itemid"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("transactionid"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five event types of the test table in the raw layout."""
    return _mapped(spark, sf_dir).drop("event_id")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three accepted event types in the bronze layout."""
    return cast_to_bronze(raw_events(spark, sf_dir).filter(F.col("event").isin(*EVENT_TYPES)))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with faults put in by event number, some of them repeated."""
    key = F.col("event_id")

    def every(step: int) -> Column:
        return key % step == 0

    faulty = _mapped(spark, sf_dir).select(
        "event_id",
        F.when(~every(101), F.col("timestamp")).alias("timestamp"),
        F.when(~every(89), F.col("visitorid")).alias("visitorid"),
        F.when(~every(103), F.col("event")).alias("event"),
        F.when(~every(97), F.col("itemid")).alias("itemid"),
        F.when(every(79), key).when(~every(83), F.col("transactionid")).alias("transactionid"),
    )
    repeated = faulty.unionAll(faulty.filter(every(71)))
    return cast_to_bronze(repeated)


def item_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three properties per part; the category property holds two ids."""
    brand_no = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    rows = F.array(
        F.struct(
            F.lit("categoryid").alias("property"),
            F.concat_ws(" ", F.col("p_size").cast("string"), (brand_no + 50).cast("string")).alias(
                "value"
            ),
        ),
        F.struct(F.lit("brand").alias("property"), F.col("p_brand").alias("value")),
        F.struct(F.lit("type").alias("property"), F.col("p_type").alias("value")),
    )
    return table(spark, sf_dir, "part").select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 30).cast("int"))
        .cast("timestamp_ntz")
        .alias("timestamp"),
        F.col("p_partkey").alias("itemid"),
        F.inline(rows),
    )


def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent pointers for all categories named by the properties.

    Sizes are leaves below the brand groups, brand groups are below five roots,
    roots have no parent.
    """
    ids = table(spark, sf_dir, "part").select(
        F.explode(
            F.array(
                F.col("p_size").cast("int"),
                F.lit(51) + F.col("p_size").cast("int") % 25,
                F.lit(76) + F.col("p_size").cast("int") % 5,
            )
        ).alias("categoryid")
    )
    node = F.col("categoryid")
    return ids.distinct().select(
        "categoryid",
        F.when(node <= 50, F.lit(51) + node % 25)
        .when(node <= 75, F.lit(76) + node % 5)
        .alias("parentid"),
    )


def scored_labels(spark: SparkSession, sf_dir: str, ties: bool = False) -> DataFrame:
    """Labels with a score computed from the id, with or without many ties."""
    key = F.col("doc_id") * 7919
    score = (key % 20) / F.lit(20.0) if ties else (key % 1000 + 0.5) / F.lit(1000.0)
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y"), score.alias("p")
    )
