"""Running totals and ranks over a globally ordered frame.

A window without ``partitionBy`` would move every row into one task. Here the
frame is range-partitioned by its order, each partition is summed on its own,
and the totals of the partitions before it are added as an offset.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

_PART = "_range_part"
# Offsets are broadcast up to this many rows (partitions plus groups), else joined.
BROADCAST_ROWS = 100_000


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, Column],
    group: Sequence[str] = (),
    rank: str | None = None,
    totals: bool = False,
    following: Sequence[str] = (),
    order_key: Column | None = None,
) -> DataFrame:
    """Add inclusive running sums over ``order``, per ``group``.

    ``order`` has to name a unique order inside a group; group columns must not
    be null. With ``rank`` a 1-based row number is added; with ``totals`` the
    sum over the whole group is added as ``<name>_total``. With ``following`` a struct of
    those columns in the next row of the group is added under that name, null in the last;
    the first row of a partition is handed to the one before. ``order_key`` is then a single
    ascending key of the same order.
    """
    sums = dict(sums)
    if rank:
        sums[rank] = F.lit(1).cast("long")
    columns = df.columns
    inputs = {name: f"_in_{name}" for name in sums}
    offsets = {name: f"_off_{name}" for name in sums}
    group = list(group)

    # The partition number is stored with the rows: totals and rows then agree
    # on it even if a task is run again.
    placed = materialise(
        df.withColumns({inputs[n]: expr for n, expr in sums.items()})
        .repartitionByRange(*[F.col(g).asc() for g in group], *order)
        .withColumn(_PART, F.spark_partition_id())
    )

    per_part = placed.groupBy(*group, _PART).agg(
        *[F.sum(inputs[n]).alias(offsets[n]) for n in sums],
        *([F.min_by(F.struct(*following), order_key).alias("_first")] if following else []),
    )
    # At most one row per range partition and group.
    in_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = in_group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    added = {}
    for n in sums:
        added[offsets[n]] = F.coalesce(F.sum(offsets[n]).over(before), F.lit(0))
        if totals:
            added[f"{n}_total"] = F.sum(offsets[n]).over(in_group)
    if following:
        added["_handed"] = F.lead("_first").over(in_group.orderBy(_PART))
    parts = per_part.select(*group, _PART, *[expr.alias(n) for n, expr in added.items()])

    in_order = Window.partitionBy(*group, _PART).orderBy(*order)
    local = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One task per range partition. Hashing the partition number instead would put
    # several of them into one task and leave others idle.
    pairs, last_part = per_part.agg(F.count(F.lit(1)), F.max(_PART)).first()
    spread = placed.repartitionById((last_part or 0) + 1, F.col(_PART))
    if pairs <= BROADCAST_ROWS:
        parts = F.broadcast(parts)
    with_local = spread.withColumns({inputs[n]: F.sum(inputs[n]).over(local) for n in sums})
    beyond = []
    if following:
        with_local = with_local.withColumn("_lead", F.lead(F.struct(*following)).over(in_order))
        beyond = [F.coalesce("_lead", "_handed").alias("following")]
    return with_local.join(parts, on=[*group, _PART], how="left").select(
        *columns,
        *[(F.col(inputs[n]) + F.col(offsets[n])).alias(n) for n in sums],
        *([F.col(f"{n}_total") for n in sums] if totals else []),
        *beyond,
    )


def quantile_label(prob: float) -> str:
    return "p" + f"{prob * 100:.6f}".rstrip("0").rstrip(".").replace(".", "_")
