"""Item properties, category tree and category-level behaviour."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import materialise
from ..schemas import CATEGORY_PROPERTY, ROOT_PARENT, TRANSACTION, VIEW
from .profile import describe_numbers


def property_frequency(properties: DataFrame) -> DataFrame:
    """Records per property, most frequent first."""
    return (
        properties.groupBy("property")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "property")
    )


def property_history(properties: DataFrame) -> DataFrame:
    """Property records per item."""
    return properties.groupBy("itemid").agg(F.count(F.lit(1)).alias("records"))


def describe_property_history(properties: DataFrame) -> DataFrame:
    return describe_numbers(property_history(properties), ["records"])


def property_as_of(properties: DataFrame, before: Any, ts_col: str = "timestamp") -> DataFrame:
    """Value of every item property known strictly before a point in time.

    Equal times are decided by the larger value. The latest record is a plain
    maximum, combined before the shuffle.
    """
    known = properties.filter(F.col(ts_col) < before)
    latest = F.max(F.struct(F.col(ts_col), F.col("value"))).alias("_latest")
    return (
        known.groupBy("itemid", "property")
        .agg(latest)
        .select("itemid", "property", f"_latest.{ts_col}", "_latest.value")
    )


def root_and_child_counts(tree: DataFrame) -> DataFrame:
    """Number of roots and of children in a normalised tree."""
    root = F.col("parentid") == ROOT_PARENT
    return tree.agg(
        F.count_if(root).alias("root_categories"), F.count_if(~root).alias("child_categories")
    )


def children_per_parent(tree: DataFrame, n: int = 20) -> DataFrame:
    """The parents with most children, the root marker included."""
    return (
        tree.groupBy("parentid")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "parentid")
        .limit(n)
    )


def build_category_depth(tree: DataFrame) -> DataFrame:
    """Hops from each category to a node without a known parent; null on a cycle.

    Every round doubles the distance a pointer spans, so a tree of depth d needs
    about log2(d) rounds. A walk without a cycle is shorter than the number of
    categories, so pointers still open after log2 of that number are on a cycle.
    Finished categories leave the walk: only open pointers are joined. A category
    listed twice is an error.
    """
    nodes = tree.groupBy("categoryid").agg(
        F.coalesce(F.max("parentid"), F.lit(ROOT_PARENT)).alias("parentid"),
        F.count(F.lit(1)).alias("rows"),
    )
    has_parent = F.col("parentid") != ROOT_PARENT
    # ``up``: the ancestor reached so far, null when the walk has ended.
    walk = materialise(
        nodes.select(
            "categoryid",
            F.when(has_parent, F.col("parentid")).alias("up"),
            has_parent.cast("long").alias("depth"),
            "rows",
        )
    )
    categories, most = walk.agg(F.count(F.lit(1)), F.max("rows")).first()
    if (most or 0) > 1:
        raise ValueError("a category is listed more than once in the tree")
    walk = walk.drop("rows")
    done, still_open = walk.filter("up IS NULL"), walk.filter("up IS NOT NULL")
    for _ in range(categories.bit_length() + 1):
        every = done.unionByName(still_open)
        if _nothing_ends(still_open):
            break
        step = every.select(
            F.col("categoryid").alias("up"),
            F.col("up").alias("_next"),
            F.col("depth").alias("_more"),
        )
        moved = materialise(
            still_open.join(step, "up", "left").select(
                "categoryid",
                F.col("_next").alias("up"),
                (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
            )
        )
        done = done.unionByName(moved.filter("up IS NULL"))
        still_open = moved.filter("up IS NOT NULL")
    return done.unionByName(still_open).select(
        "categoryid", F.when(F.col("up").isNull(), F.col("depth")).cast("int").alias("depth")
    )


def _nothing_ends(still_open: DataFrame) -> bool:
    """Whether no open pointer leads to a finished or unknown node."""
    ahead = still_open.select(F.col("categoryid").alias("up"))
    return still_open.join(ahead, "up", "left_anti").isEmpty()


def depth_distribution(depths: DataFrame) -> DataFrame:
    """Categories per depth; those on a cycle are left out."""
    return (
        depths.filter(F.col("depth").isNotNull())
        .groupBy("depth")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("depth")
    )


def item_categories(properties: DataFrame, dedup: bool = False) -> DataFrame:
    """Item and category id, one row per category named in a property record.

    Repeated records repeat their pairs unless ``dedup`` is set.
    """
    pairs = (
        properties.filter(F.col("property") == CATEGORY_PROPERTY)
        .filter(F.col("value").isNotNull())
        .select("itemid", F.explode(F.split(F.trim("value"), r"\s+")).alias("categoryid"))
        .filter(F.col("categoryid") != "")
    )
    return pairs.distinct() if dedup else pairs


def category_events(
    events: DataFrame, categories: DataFrame, ts_col: str = "event_time"
) -> DataFrame:
    """Events once for every category pair of their item."""
    return events.select(ts_col, "visitorid", "event", "itemid").join(
        categories, "itemid", "inner"
    )


def items_per_category(categories: DataFrame) -> DataFrame:
    """Distinct items per category, largest first."""
    return (
        categories.distinct()
        .groupBy("categoryid")
        .agg(F.count(F.lit(1)).alias("items"))
        .orderBy(F.desc("items"), "categoryid")
    )


def _conversion(part: str = "transactions", whole: str = "views") -> Column:
    return F.try_divide(F.col(part) * 100.0, F.col(whole)).alias("conversion_rate")


def category_purchases(events: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct items, views, transactions and conversion per category.

    The same as aggregating ``category_events``, but events are counted per item
    and pairs per item and category before the join, so a hot item travels as
    one row.
    """
    per_item = events.groupBy("itemid").agg(
        F.count_if(F.col("event") == VIEW).alias("_views"),
        F.count_if(F.col("event") == TRANSACTION).alias("_transactions"),
    )
    pairs = categories.groupBy("itemid", "categoryid").agg(F.count(F.lit(1)).alias("_pairs"))
    return (
        pairs.join(per_item, "itemid", "inner")
        .groupBy("categoryid")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.sum(F.col("_pairs") * F.col("_views")).alias("views"),
            F.sum(F.col("_pairs") * F.col("_transactions")).alias("transactions"),
        )
        .select("categoryid", "items", "views", "transactions", _conversion())
    )


def best_converting(purchases: DataFrame, min_views: int = 100, n: int = 20) -> DataFrame:
    """Top categories by conversion among those with enough views."""
    return (
        purchases.filter(F.col("views") >= min_views)
        .orderBy(F.desc("conversion_rate"), "categoryid")
        .limit(n)
    )


def clean_category_id(column: Column) -> Column:
    """Strip the list brackets of a category id written as a one-element list."""
    # The bracket patterns.
    return F.regexp_replace(F.regexp_replace(column.cast("string"), r"^\['", ""), r"'\]$", "")


def with_parent(purchases: DataFrame, tree: DataFrame) -> DataFrame:
    """Add the parent of each category; fails if a category has two parent rows."""
    rows = F.count(F.lit(1))
    unique = F.when(
        rows > 1, F.raise_error(F.lit("category tree: categoryid is not unique"))
    ).otherwise(F.max("parentid").cast("string"))
    lookup = tree.groupBy(F.col("categoryid").cast("string").alias("categoryid")).agg(
        unique.alias("parentid")
    )
    return purchases.withColumn("categoryid", clean_category_id(F.col("categoryid"))).join(
        lookup, "categoryid", "left"
    )


def parent_purchases(purchases_with_parent: DataFrame) -> DataFrame:
    """Categories, items, views, transactions and conversion per parent."""
    return (
        purchases_with_parent.filter(F.col("parentid").isNotNull())
        .groupBy("parentid")
        .agg(
            F.count_distinct("categoryid").alias("categories"),
            F.sum("items").alias("items"),
            F.sum("views").alias("views"),
            F.sum("transactions").alias("transactions"),
        )
        .select("parentid", "categories", "items", "views", "transactions", _conversion())
    )

