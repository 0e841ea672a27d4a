"""Mixing sources to target weights over a tree of domain, language and source.

A token budget flows from the root to the leaves in proportion to the weights. A node can
take at most what its leaves hold in ``max_epochs`` epochs; what it cannot take goes to its
siblings first, and only a shortage of all of them reaches the level above. Each leaf then
takes whole epochs and a token prefix of one more, whose order depends on the seed and the
number of the epoch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.ordered import running_totals
from clickloom.functions.storage import materialise

#: Levels of the tree, from the root down.
LEVELS = ("domain", "lang", "source")
SEED = 17


def estimated_tokens(text: Column) -> Column:
    """Four bytes to a token, rounded up; null texts have none."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


def weight_of(weights: Mapping[str, float], node: Column, default: float) -> Column:
    if not weights:
        return F.lit(float(default))
    pairs = [F.lit(x) for name, w in weights.items() for x in (name, float(w))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), node), F.lit(float(default)))


def share_out(nodes: DataFrame, parents: Sequence[str], node: str) -> DataFrame:
    """Divide ``budget`` (of the parent) by ``weight`` among siblings, none above ``capacity``.

    Siblings are ordered by capacity per weight: from the front, all are filled up whose
    even share of what is left is more than they hold; the others take that share. Without
    weight a node gets nothing. The result is ``budget`` of each node.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    fullness = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    ordered = siblings.orderBy(F.asc_nulls_last("_fullness"), node)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    counted = nodes.withColumn("_fullness", fullness).withColumns(
        {
            "_at": F.row_number().over(ordered),
            "_held": F.coalesce(F.sum("capacity").over(before), F.lit(0)),
            "_weights": F.sum("weight").over(
                ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
            ),
        }
    )
    level = F.when(F.col("_weights") > 0, (F.col("budget") - F.col("_held")) / F.col("_weights"))
    counted = counted.withColumn("_level", level)
    counted = counted.withColumn("_full", F.coalesce(F.col("_level") >= F.col("_fullness"), F.lit(False)))
    first = F.min(F.when(~F.col("_full"), F.struct("_at", "_level"))).over(siblings)
    even = F.coalesce(F.greatest(first["_level"], F.lit(0.0)), F.lit(0.0))
    return counted.withColumn(
        "budget",
        F.when(F.col("_full"), F.col("capacity").cast("double")).otherwise(F.col("weight") * even),
    ).drop("_fullness", "_at", "_held", "_weights", "_level", "_full")


def budgets(
    leaves: DataFrame, total: int, weights: Mapping[str, Mapping[str, float]], default: float
) -> DataFrame:
    """``budget`` of each leaf (columns LEVELS, ``capacity``), from the root down."""
    above: DataFrame | None = None
    for depth, name in enumerate(LEVELS):
        path, parents = LEVELS[: depth + 1], LEVELS[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight_of(weights.get(name, {}), F.col(name), default))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(float(total)))
        else:
            nodes = nodes.join(above, list(parents))
        above = share_out(nodes, parents, name).select(*path, "budget")
    return above


def plan(
    docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]],
    budget_share: float = 0.75, max_epochs: int = 2, seed: int = SEED,
    tokens: Column | None = None, default_weight: float = 0.1,
) -> DataFrame:
    """How often each document is used: one row per distinct ``doc_id`` and text.

    Columns: ``doc_id``, ``text_hash``, LEVELS, ``n_tokens``, ``budget`` and ``leaf_tokens``
    of the leaf, ``epochs`` (0 included). Null ``lang``, ``source`` or domain count as the
    empty name. Documents without tokens are never used; equal rows are used together, with
    the tokens of all. Nodes that ``weights`` (by level, then name) does not name have
    ``default_weight``. An empty table gives no rows.
    """
    if max_epochs < 1 or budget_share < 0:
        raise ValueError("max_epochs must be at least 1 and budget_share not negative")
    named = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in LEVELS[1:]}
    size = estimated_tokens(F.col("text")) if tokens is None else tokens
    units = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("text_hash"),
            F.coalesce(domain, F.lit("")).alias("domain"),
            *[c.alias(n) for n, c in named.items()],
            size.alias("n_tokens"),
        )
        .groupBy("doc_id", "text_hash", *LEVELS)
        .agg(F.sum("n_tokens").alias("n_tokens"))
    )
    leaves = materialise(units.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("leaf_tokens")))
    leaves = leaves.withColumn("capacity", F.col("leaf_tokens") * max_epochs)
    held = leaves.agg(F.sum("leaf_tokens")).first()[0] or 0
    shared = budgets(leaves, int(budget_share * held), weights, default_weight)
    # Rounded first, so that an exact share does not lose a token to the last bit.
    whole = F.floor(F.round(F.col("budget"), 6)).cast("long")
    leaf = materialise(
        leaves.join(shared, list(LEVELS))
        .withColumn("budget", whole)
        .withColumn("full", F.coalesce(F.try_divide("budget", "leaf_tokens"), F.lit(0)).cast("int"))
        .drop("capacity")
    )
    # One row per leaf on one side: the other side may have a leaf with a third of all rows,
    # which adaptive execution splits.
    joined = units.join(leaf, list(LEVELS)).withColumn(
        "_order",
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.col("doc_id").cast("string"))),
    )
    summed = running_totals(
        joined,
        order=[F.col("_order"), F.col("doc_id"), F.col("text_hash")],
        sums={"_upto": F.col("n_tokens")},
        group=list(LEVELS),
    )
    rest = F.col("budget") - F.col("full") * F.col("leaf_tokens")
    once_more = (F.col("_upto") <= rest).cast("int")
    return summed.select(
        "doc_id", "text_hash", *LEVELS, "n_tokens", "budget", "leaf_tokens",
        F.when(F.col("n_tokens") > 0, F.col("full") + once_more).otherwise(0).alias("epochs"),
    )


def take(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows of ``docs``, each as often as planned."""
    used = planned.filter("epochs > 0").select("doc_id", "text_hash", "epochs")
    # The row travels as one column, so that none of its names can clash.
    rows = docs.select(
        F.col("doc_id").alias("owner"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row")
    )
    same = F.col("owner").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    often = rows.join(used, same).select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
    return often.select("row.*")
