"""Filter interaction audit by difference arrays over Lehmer ranks.

A document is known by the mask of the filters it fails. In an order of the filters the first
one that it fails removes it. All orders that begin with the same filters are neighbours in
lexicographic order, so a mask and a step cover a few intervals of ranks: one for each
beginning whose last filter alone is in the mask. Documents are counted by part and mask; the
counts go in at the start of an interval, out at its end, and running sums over the ranks
give what each order removes at each step.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
WEIGHTS = ("docs", "good", "toxic")


# ---- orders of filters


def lehmer_rank(order: str, filters: str = FILTERS) -> int:
    """Lexicographic rank of the first order that begins with ``order``."""
    left, rank = list(filters), 0
    for letter in order:
        at = left.index(letter)
        rank += at * factorial(len(left) - 1)
        left.pop(at)
    return rank


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """``(mask, step, start, end)``: orders ``start`` to ``end - 1`` remove the mask at the step."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    found = []
    for step in range(1, len(filters) + 1):
        for begin in permutations(filters, step):
            start = lehmer_rank("".join(begin), filters)
            end = start + factorial(len(filters) - step)
            passed, fails = sum(bit[f] for f in begin[:-1]), bit[begin[-1]]
            masks = range(1 << len(filters))
            found += [(m, step, start, end) for m in masks if m & fails and not m & passed]
    return found


def steps(filters: str = FILTERS) -> list[tuple[int, int, str, str]]:
    """``(rank, step, filter, order)`` of every order and step."""
    rows = []
    for order in map("".join, permutations(filters)):
        rank = lehmer_rank(order, filters)
        rows += [(rank, k, f, order) for k, f in enumerate(order, 1)]
    return rows


# ---- which filters a document fails


def conditions() -> dict[str, Column]:
    """A to D over the columns of ``measures``."""
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 2 * F.col("n_chars"),
        "D": F.col("has_sign"),
    }


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, part``, what the conditions need, and a digest of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, BLANK), "").alias("words"),
    )
    return kept.select(
        "doc_id",
        "part",
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("n_upper"),
        F.length("text").alias("n_chars"),
        F.col("text").rlike("[#$%&*|]").alias("has_sign"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )


def mark_repeats(rows: DataFrame) -> DataFrame:
    """Adds ``repeat``: a row with a smaller ``doc_id`` has the same text.

    The smallest id of each text is a hash aggregate. It is joined by text and id together,
    so the copies of a frequent text are spread by their ids. Rows without an id stand behind
    those with one and do not repeat each other.
    """
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    first = first.withColumn("_is_first", F.lit(True)).alias("first")
    same = (F.col("rows.digest") == F.col("first.digest")) & F.col("rows.doc_id").eqNullSafe(
        F.col("first.first_id")
    )
    return rows.alias("rows").join(first, same, "left").select(
        "rows.*", F.col("_is_first").isNull().alias("repeat")
    )


def label_flags(labels: DataFrame) -> DataFrame:
    """``doc_id, good, toxic`` as 0 or 1; of several labels of a document any counts."""

    def flag(name: str) -> Column:
        return F.coalesce(F.max((F.col(name) == 1).cast("int")), F.lit(0))

    return (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    )


def count_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, docs, good, toxic``: at most 32 rows a part."""
    measured = measures(docs)
    own = sum(F.when(c, 1 << FILTERS.index(f)).otherwise(0) for f, c in conditions().items())
    rows = measured.select("doc_id", "part", "digest", own.alias("mask"))
    marked = mark_repeats(rows)
    mask = F.col("mask") + F.when(F.col("repeat"), 1 << FILTERS.index("E")).otherwise(0)
    labelled = marked.select("doc_id", "part", mask.alias("mask")).join(
        label_flags(labels), "doc_id", "left"
    )
    return labelled.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"),
        F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
    )


# ---- what every order removes


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, filter_order, step, filter`` and counts, from ``part, mask, docs, good, toxic``.

    One row for each part, order and step, zeros included; an empty table has no parts.
    """
    spark = masks.sparkSession
    names: Mapping[str, str] = {w: f"d_{w}" for w in WEIGHTS}
    # Both tables are made of the filters alone: 840 and 600 rows for five of them.
    ranges = spark.createDataFrame(intervals(filters), "mask int, step int, start int, end int")
    covered = masks.join(F.broadcast(ranges), "mask")
    ends = F.array(
        F.struct(F.col("start").alias("rank"), *[F.col(w).alias(d) for w, d in names.items()]),
        F.struct(F.col("end").alias("rank"), *[(-F.col(w)).alias(d) for w, d in names.items()]),
    )
    entries = covered.select("part", "step", F.inline(ends))
    order_rows = spark.createDataFrame(
        steps(filters), "rank int, step int, filter string, filter_order string"
    )
    zero = F.lit(0).cast("long")
    parts = masks.select("part").distinct()
    grid = parts.select(
        "part",
        F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"),
    ).select(
        "part", "step",
        F.explode(F.sequence(F.lit(0), F.lit(factorial(len(filters)) - 1))).alias("rank"),
        *[zero.alias(d) for d in names.values()],
    )
    at_rank = (
        entries.select(*grid.columns)
        .unionAll(grid)
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(d).alias(d) for d in names.values()])
    )
    by_rank = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = at_rank.select(
        "part", "step", "rank", *[F.sum(d).over(by_rank).alias(w) for w, d in names.items()]
    ).filter(F.col("rank") < factorial(len(filters)))
    per_filter = masks.select(
        "part",
        "docs",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("filter"),
                        F.col("mask").bitwiseAND(1 << i).alias("fails"),
                        (F.col("mask") == 1 << i).alias("alone"),
                    )
                    for i, f in enumerate(filters)
                ]
            )
        ),
    )
    totals = per_filter.groupBy("part", "filter").agg(
        F.sum("docs").alias("all_docs"),
        F.sum(F.when(F.col("fails") > 0, F.col("docs")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("alone"), F.col("docs")).otherwise(0)).alias("unique_fails"),
    )
    upto = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        removed.join(F.broadcast(order_rows), ["rank", "step"])
        .join(totals, ["part", "filter"])
        .select(
            "part",
            "filter_order",
            "step",
            "filter",
            (F.col("all_docs") - F.sum("docs").over(upto)).alias("kept"),
            F.col("docs").alias("removed"),
            (F.col("failing") - F.col("docs")).alias("redundant"),
            "unique_fails",
            F.col("good").alias("good_lost"),
            F.col("toxic").alias("toxic_lost"),
            F.sum("docs").over(Window.partitionBy("part", "filter")).alias("shapley"),
        )
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters over ``docs`` (doc_id, text, source), one part a source.

    Null texts are empty, null sources the part with the empty name. Repeated rows count each;
    rows that repeat one id do not repeat each other's text. Other columns are ignored.
    """
    return audit(count_masks(docs.select("doc_id", "text", "source"), labels))
