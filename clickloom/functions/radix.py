"""Exact quantiles by radix selection: no sort and no exchange of values.

A double becomes a 64-bit key of the same order. Each pass counts one more digit of 16 bits,
and only where a wanted rank falls, so a value is found after four passes at most; a digit
whose values are all equal ends it sooner. Tasks send counts of the digits they saw; the
values themselves stay where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import quantile_label
from .storage import materialise

DIGIT, DIGITS = 16, 4
COMPACT = 1 << 18  # counted digits of a task before equal ones are added up

_SIGN = np.int64(0x7FFFFFFFFFFFFFFF)


def keys_of(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit keys in the order of the values; -0 is 0 and every NaN is the largest."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return bits ^ ((bits >> np.int64(63)) & _SIGN)


def value_of(key: int) -> float:
    bits = np.int64(key)
    return float((bits ^ ((bits >> np.int64(63)) & _SIGN)).view(np.float64))


class _Wanted(NamedTuple):
    """A rank (from 0) of a column, counted from the first value with the prefix."""

    column: int
    rank: int
    prefix: int
    left: int


def _digits(stored: DataFrame, columns: int, level: int, prefixes: dict[int, list[int]]) -> DataFrame:
    """``column, prefix, digit, n, low, high``: how many values have each digit after each of
    the prefixes, and the smallest and largest of their keys."""
    size, digits, compact, sign = DIGIT, DIGITS, COMPACT, _SIGN

    def merge(parts: list[np.ndarray]) -> list[np.ndarray]:
        """Rows of (prefix, digit, n, low, high), added up by prefix and digit."""
        every = np.concatenate(parts, axis=1)
        every = every[:, np.lexsort((every[1], every[0]))]
        new = np.r_[True, (np.diff(every[0]) != 0) | (np.diff(every[1]) != 0)]
        at = np.flatnonzero(new)
        return [
            np.stack(
                [
                    every[0][at], every[1][at], np.add.reduceat(every[2], at),
                    np.minimum.reduceat(every[3], at), np.maximum.reduceat(every[4], at),
                ]
            )
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[list[np.ndarray]] = [[] for _ in range(columns)]
        for batch in batches:
            for c in range(columns):
                if c not in prefixes:
                    continue
                values = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                if not len(values):
                    continue
                bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
                keys = np.sort(bits ^ ((bits >> np.int64(63)) & sign))
                # Digits of the unsigned key, so that negative ones come first.
                code = keys.view(np.uint64) ^ np.uint64(1 << 63)
                before = code >> np.uint64(size * (digits - level)) if level else np.zeros(len(code), np.uint64)
                if level:
                    own = np.isin(before, np.array(prefixes[c], np.uint64))
                    keys, code, before = keys[own], code[own], before[own]
                    if not len(keys):
                        continue
                digit = (code >> np.uint64(size * (digits - level - 1))) & np.uint64((1 << size) - 1)
                upto = (before << np.uint64(size)) | digit
                at = np.flatnonzero(np.r_[True, upto[1:] != upto[:-1]])
                n = np.diff(np.r_[at, len(keys)])
                last = np.r_[at[1:], len(keys)] - 1
                seen[c].append(
                    np.stack([before[at].astype(np.int64), digit[at].astype(np.int64), n, keys[at], keys[last]])
                )
                if sum(p.shape[1] for p in seen[c]) > compact:
                    seen[c] = merge(seen[c])
        for c, parts in enumerate(seen):
            if parts:
                out = merge(parts)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(out.shape[1], c, np.int32)), *[pa.array(row) for row in out]],
                    names=["column", "prefix", "digit", "n", "low", "high"],
                )

    parts = stored.mapInArrow(
        run, "column int, prefix long, digit long, n long, low long, high long"
    )
    return parts.groupBy("column", "prefix", "digit").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _step(counted: DataFrame, wanted: list[_Wanted]) -> tuple[list[_Wanted], dict[tuple, float]]:
    """Which digit each wanted rank has: what is still open, and the values found."""
    spark = counted.sparkSession
    asked = spark.createDataFrame(
        [tuple(w) for w in wanted], "column int, rank long, prefix long, left long"
    )
    # A group has at most 2^16 digits, whatever the number of values.
    order = Window.partitionBy("column", "prefix").orderBy("digit")
    upto = counted.withColumn("upto", F.sum("n").over(order))
    hit = (
        upto.join(F.broadcast(asked), ["column", "prefix"])
        .filter((F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n")))
        .select("column", "rank", "prefix", "digit", (F.col("left") - F.col("upto") + F.col("n")).alias("left"), "low", "high")
    )
    open_, found = [], {}
    for r in hit.collect():  # one row a wanted rank
        if r["low"] == r["high"]:
            found[r["column"], r["rank"]] = value_of(r["low"])
        else:
            open_.append(_Wanted(r["column"], r["rank"], r["prefix"] << DIGIT | r["digit"], r["left"]))
    return open_, found


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per column with a value.

    Nulls are left out; NaN is the largest value. The columns are stored once as doubles.
    """
    stored = materialise(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    labels = [quantile_label(p) for p in probs]
    schema = ", ".join(["column string", *[f"{name} double" for name in labels]])
    first = materialise(_digits(stored, len(columns), 0, {c: [0] for c in range(len(columns))}))
    totals = {r["column"]: r["n"] for r in first.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    places = {
        (c, p): (math.floor(p * (n - 1)), math.ceil(p * (n - 1))) for c, n in totals.items() for p in probs
    }
    wanted = [
        _Wanted(c, rank, 0, rank) for c, rank in sorted({(c, k) for (c, _), ends in places.items() for k in ends})
    ]
    found: dict[tuple, float] = {}
    for level in range(DIGITS):
        if not wanted:
            break
        prefixes: dict[int, list[int]] = {}
        for w in wanted:
            prefixes.setdefault(w.column, []).append(w.prefix)
        counted = first if level == 0 else _digits(stored, len(columns), level, prefixes)
        wanted, more = _step(counted, wanted)
        found |= more
    rows = []
    for c, n in sorted(totals.items()):
        own = [columns[c]]
        for p in probs:
            low, high = (found[c, k] for k in places[c, p])
            part = p * (n - 1) - places[c, p][0]
            own.append(low + (high - low) * part if low != high else low)
        rows.append(tuple(own))
    return df.sparkSession.createDataFrame(rows, schema)
