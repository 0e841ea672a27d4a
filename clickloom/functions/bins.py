"""Binning expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def right_closed_bin(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge, next edge] holding the value.

    The first interval also takes its left edge. Values outside all intervals,
    nulls and NaN give null.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    inside = (value >= F.lit(float(edges[0]))) & ~F.isnan(value.cast("double"))
    chain = None
    for upper, label in zip(edges[1:], labels):
        test = inside if math.isinf(upper) else inside & (value <= F.lit(float(upper)))
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def bin_order(label: Column, labels: Sequence[str]) -> Column:
    """Position of a label, for sorting a report."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from the smallest to the largest value.

    Bins are left-closed and the last one is closed on both sides. When all
    values are equal the range is widened by one half to each side. Empty bins
    are not listed.
    """
    span = df.agg(
        F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")
    ).select(
        F.struct(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ).alias("span")
    )
    one = span.scalar()
    lo, width = one["lo"], (one["hi"] - one["lo"]) / F.lit(float(bins))
    index = F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (lo + F.col("bin") * width).alias("bin_start"),
            (lo + (F.col("bin") + 1) * width).alias("bin_end"),
            "n",
        )
    )
