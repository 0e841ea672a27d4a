"""As-of join: the last record known before each question.

Records and questions of a key are put into one order and range-partitioned, so a key with
very many rows is cut into several tasks. Inside a partition the last record is carried
forward; the last record of every key that goes on in a later partition is handed over to
it, as the offsets of running totals are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import materialise

# Handed-over records are broadcast up to this many rows, else joined.
BROADCAST_ROWS = 100_000


def _named(prefix: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def as_of(
    asks: DataFrame,
    records: DataFrame,
    keys: Sequence[str],
    ask_at: str,
    record_at: str,
    values: Sequence[str],
    inclusive: bool = False,
) -> DataFrame:
    """Every row of ``asks`` with ``values`` and ``record_at`` of the last record of its key.

    A record counts if its time is before that of the question, or equal to it with
    ``inclusive``. Of records at one time the largest values count. Questions without such a
    record, with a null key or time, have nulls; records with a null key, a null time or only
    null values are passed over. Repeated rows stay. Both times have one type. Columns of
    ``asks`` named like ``values`` or ``record_at`` are refused.
    """
    clash = set(asks.columns) & {*values, record_at}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    known = records.filter(
        F.col(record_at).isNotNull()
        & F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull()
    ).filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    # Of records at one time one is enough; the maximum is combined before the shuffle.
    found = (
        known.groupBy(*keys, record_at)
        .agg(F.max(F.struct(*values)).alias("_v"))
        .select(
            *_named("k", keys),
            F.col(record_at).alias("at"),
            F.lit(0 if inclusive else 1).alias("kind"),
            F.struct(F.col(record_at), *[F.col(f"_v.{v}").alias(v) for v in values]).alias("record"),
        )
    )
    ask = F.struct(*[F.col(c) for c in asks.columns])
    both = asks.select(
        *_named("k", keys), F.col(ask_at).alias("at"), F.lit(1 if inclusive else 0).alias("kind"),
        ask.alias("ask"),
    ).unionByName(found, allowMissingColumns=True)
    own = [f"k{i}" for i in range(len(keys))]
    order = [F.col("at"), F.col("kind")]
    # Equal questions are spread by their hash; their order among each other means nothing.
    spread = F.xxhash64("ask")
    placed = materialise(
        both.withColumn("tie", spread)
        .repartitionByRange(*own, *order, "tie")
        .withColumn("part", F.spark_partition_id())
    )
    local = (
        Window.partitionBy(*own, "part")
        .orderBy(*order, "tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = placed.withColumn("record", F.last("record", ignorenulls=True).over(local))
    handed = _handed_over(placed, own)
    few = handed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = carried.filter("ask IS NOT NULL").join(
        F.broadcast(handed) if few else handed, [*own, "part"], "left"
    )
    last = F.coalesce("record", "before")
    known_key = F.lit(True)
    for name in [*own, "at"]:
        known_key = known_key & F.col(name).isNotNull()
    last = F.when(known_key, last)
    return joined.select(
        "ask.*", last[record_at].alias(record_at), *[last[v].alias(v) for v in values]
    )


def _handed_over(placed: DataFrame, own: Sequence[str]) -> DataFrame:
    """``own, part, before``: the last record of a key in the partitions before ``part``.

    Only keys that are in two partitions or more: at most one begins in each partition.
    """
    key = F.struct(*own)
    ends = placed.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    edges = ends.select(F.explode(F.array("low", "high")).alias("key")).distinct()
    same = [placed[c].eqNullSafe(F.col(f"key.{c}")) for c in own]
    split = placed.join(F.broadcast(edges), same, "left_semi")  # two keys a partition at most
    moment = F.struct("at", "kind")
    lasts = split.groupBy(*own, "part").agg(
        F.max_by("record", F.when(F.col("record").isNotNull(), moment)).alias("last")
    )
    before = Window.partitionBy(*own).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return lasts.withColumn("before", F.last("last", ignorenulls=True).over(before)).filter(
        "before IS NOT NULL"
    ).select(*own, "part", "before")


def item_days(silver: DataFrame) -> DataFrame:
    """Every item and snapshot day with an event, with the start of the day."""
    return (
        silver.filter(F.col("itemid").isNotNull())
        .select("itemid", "snapshot_day")
        .distinct()
        .withColumn("day_start", F.date_from_unix_date("snapshot_day").cast("timestamp_ntz"))
    )


def property_as_of_snapshots(
    silver: DataFrame, properties: DataFrame, names: Sequence[str]
) -> DataFrame:
    """``itemid, snapshot_day, property, timestamp, value``: what was known of each item's
    property before each of its snapshot days."""
    asked = item_days(silver).withColumn("property", F.explode(F.lit(list(names))))
    wanted = properties.filter(F.col("property").isin(list(names)))
    found = as_of(asked, wanted, ["itemid", "property"], "day_start", "timestamp", ["value"])
    return found.drop("day_start")
