"""Data-quality classification, quarantine and duplicates.

Copies of a row are identical in all bronze columns, so they are counted with a
hash aggregate that combines before the shuffle. A row copied a billion times
travels as one row per input task instead of filling one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.copies import expand_copies
from ..schemas import BRONZE_COLUMNS, EVENT_TYPES, TRANSACTION

ERROR = "_dq_error"
DUPLICATE = "duplicated_row"
_COPIES = "_copies"


def row_error() -> Column:
    """First rule that a single row breaks, or null."""
    event, purchase_id = F.col("event"), F.col("transactionid")
    # Error codes, in the order in which they are tried.
    rules = [
        ("null_event", event.isNull()),
        ("not_accepted_event", ~event.isin(*EVENT_TYPES)),
        ("null_visitor_id", F.col("visitorid").isNull()),
        ("null_item_id", F.col("itemid").isNull()),
        ("transaction_without_id", (event == TRANSACTION) & purchase_id.isNull()),
        ("id_without_transaction_event", (event != TRANSACTION) & purchase_id.isNotNull()),
        ("null_timestamp", F.col("event_time").isNull()),
    ]
    return F.coalesce(*[F.when(broken, F.lit(code)) for code, broken in rules])


def count_copies(bronze: DataFrame) -> DataFrame:
    """One row per distinct bronze row, with its number of copies and its error."""
    counted = bronze.groupBy(*BRONZE_COLUMNS).agg(F.count(F.lit(1)).alias(_COPIES))
    return counted.withColumn(ERROR, row_error())


def silver_rows(counted: DataFrame) -> DataFrame:
    """The first copy of every faultless row."""
    return counted.filter(F.col(ERROR).isNull()).select(*BRONZE_COLUMNS)


def classified_copies(counted: DataFrame) -> DataFrame:
    """Number of copies per distinct row and code.

    A faultless row gives one copy without a code, the others are duplicates. All
    copies of a faulty row have the code of its rule.
    """
    valid, copies = F.col(ERROR).isNull(), F.col(_COPIES)
    parts = F.array(
        F.struct(F.col(ERROR), F.when(valid, F.lit(1)).otherwise(copies).alias(_COPIES)),
        F.struct(F.lit(DUPLICATE).alias(ERROR), F.when(valid, copies - 1).alias(_COPIES)),
    )
    return counted.select(*BRONZE_COLUMNS, F.inline(parts)).filter(F.col(_COPIES) > 0)


def quarantine_rows(counted: DataFrame) -> DataFrame:
    """All copies of faulty rows, and all but the first copy of the others."""
    flagged = classified_copies(counted).filter(F.col(ERROR).isNotNull())
    return expand_copies(flagged, _COPIES)


def validate(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the code of the first broken rule, null when valid."""
    return expand_copies(classified_copies(count_copies(bronze)), _COPIES)


def split_validated(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver and quarantine."""
    valid = F.col(ERROR).isNull()
    return validated.filter(valid).drop(ERROR), validated.filter(~valid)


def calculate_quality_metrics(validated: DataFrame) -> DataFrame:
    """Total, valid and quarantined row counts, as one row."""
    valid = F.col(ERROR).isNull()
    return validated.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("quarantined_rows"),
    )


def quality_metrics_from_counts(counted: DataFrame) -> DataFrame:
    """The same three counts, without writing the copies out first."""
    valid = F.col(ERROR).isNull().cast("long")
    return counted.agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(valid), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum(F.col(_COPIES) - valid), F.lit(0)).alias("quarantined_rows"),
    )


def error_counts(counted: DataFrame) -> DataFrame:
    """Rows per error code; the null code counts the valid rows."""
    return classified_copies(counted).groupBy(ERROR).agg(F.sum(_COPIES).alias("rows"))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def list_duplicates(
    df: DataFrame, order: Sequence[str] = ("event_time", "timestamp", "visitorid", "itemid")
) -> DataFrame:
    """Every copy of each row that occurs more than once, sorted by ``order`` and then by the
    other columns."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    first = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in first]
    return expand_copies(counted.filter(F.col(_COPIES) > 1), _COPIES).orderBy(*first, *rest)


def duplicates_by(df: DataFrame, column: str = "event") -> DataFrame:
    """Number of duplicated rows, all copies counted, per value of a column."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    return (
        counted.filter(F.col(_COPIES) > 1)
        .groupBy(column)
        .agg(F.sum(_COPIES).alias("count"))
    )
