"""Profiling reports: missing values, descriptions, coverage, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import quantile_label
from ..functions.radix import exact_quantiles
from ..functions.timeline import epoch_micros
from ..schemas import ROOT_PARENT

QUARTILES = (0.25, 0.50, 0.75)
# Fixed value: text made of whitespace only, of any Unicode kind.
BLANK = r"(?U)^\s*$"


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def missing_summary(df: DataFrame) -> DataFrame:
    """Nulls and blank strings per column, for columns that have any."""
    text = set(_text_columns(df))
    per_column = []
    for c in df.columns:
        blank = F.count_if(F.col(c).rlike(BLANK)) if c in text else F.lit(0).cast("long")
        per_column.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(F.col(c).isNull()).alias("null"),
                blank.alias("empty_string"),
                F.count(F.lit(1)).alias("_rows"),
            )
        )
    total = F.col("null") + F.col("empty_string")
    return (
        df.agg(F.array(*per_column).alias("stats"))
        .select(F.inline("stats"))
        .select(
            "column",
            "null",
            "empty_string",
            total.alias("total_missing"),
            F.try_divide(total * 100.0, F.col("_rows")).alias("percent"),
        )
        .filter(F.col("total_missing") > 0)
        .orderBy(F.desc("total_missing"), "column")
    )


def missing_by_category(
    df: DataFrame,
    missing_column: str,
    categorical_columns: Sequence[str] | None = None,
    min_missing: float = 0.0,
) -> DataFrame:
    """Missing share of one column per value of each categorical column.

    One frame for all categorical columns; the null category is kept.
    """
    chosen = list(categorical_columns) if categorical_columns else _text_columns(df)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
            for c in chosen
        ]
    )
    missing = F.col(missing_column).isNull().alias("_missing")
    return (
        df.select(missing, F.inline(pairs))
        .groupBy("column", "category")
        .agg(
            F.count(F.lit(1)).alias("total_rows"), F.count_if("_missing").alias("missing_rows")
        )
        .withColumn(
            "missing_percent",
            F.bround(F.col("missing_rows") / F.col("total_rows") * 100, 2),
        )
        .filter(F.col("missing_percent") >= min_missing)
    )


def _as_number(df: DataFrame, column: str) -> Column:
    """Timestamps are described in epoch seconds, numbers as they are."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(column) / F.lit(1e6)
    return F.col(column).cast("double")


def describe_numbers(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """Count, mean, sample deviation, range and exact quantiles, one row per column."""
    numbers = df.select(*[_as_number(df, c).alias(c) for c in columns])
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            )
            for c in columns
        ]
    )
    moments = numbers.agg(stats.alias("stats")).select(F.inline("stats"))
    quantiles = exact_quantiles(numbers, columns, probs)
    return moments.join(quantiles, "column", "left").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        *[quantile_label(p) for p in probs],
        "max",
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (smallest on ties) and its count."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    counts = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The smallest of (-n, value) is the most frequent value. It is a plain
    # minimum, so it is combined before the shuffle.
    return (
        counts.groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("m"),
        )
        .select(
            "column", "count", "unique", F.col("m.value").alias("top"), (-F.col("m.neg")).alias("freq")
        )
    )


def describe(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str], probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """Numeric and text description as one frame."""
    return describe_numbers(df, numeric, probs).unionByName(
        describe_text(df, text), allowMissingColumns=True
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, one row per column.

    Values are made distinct with a hash aggregate in long form, which keeps
    all columns in a single pass.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )


def id_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric description of id columns with their distinct counts."""
    return describe_numbers(df, columns).join(distinct_counts(df, columns), "column", "left")


def time_range(df: DataFrame, ts_col: str) -> DataFrame:
    return df.agg(F.min(ts_col).alias("first_time"), F.max(ts_col).alias("last_time"))


def rows_per_date(df: DataFrame, ts_col: str) -> DataFrame:
    """Rows per calendar date, in date order."""
    return (
        df.filter(F.col(ts_col).isNotNull())
        .groupBy(F.to_date(ts_col).alias("date"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("date")
    )


def value_distribution(df: DataFrame, column: str, keep_nulls: bool = True) -> DataFrame:
    """Count and percent share per value, most frequent first."""
    rows = df if keep_nulls else df.filter(F.col(column).isNotNull())
    total = rows.agg(F.count(F.lit(1))).scalar()
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("percent", F.col("count") / total * 100)
        .orderBy(F.desc("count"), column)
    )


def all_whole_numbers(df: DataFrame, column: str) -> DataFrame:
    """Whether every non-null value is a whole number."""
    value = F.col(column).cast("double")
    return df.agg(F.coalesce(F.bool_and(value % 1 == 0), F.lit(True)).alias("all_whole"))


def normalise_tree(tree: DataFrame) -> DataFrame:
    """Parentless categories get the root marker; ids become short integers."""
    return tree.select(
        F.col("categoryid").cast("short").alias("categoryid"),
        F.coalesce(F.col("parentid"), F.lit(ROOT_PARENT)).cast("short").alias("parentid"),
    )


def root_rows(tree: DataFrame) -> DataFrame:
    return tree.filter(F.col("parentid").isNull())
