"""A seeded permutation of the numbers 0 to n - 1, computed row by row.

Numbers are cells of an a x b table, hardly larger than n, whose coordinates are added to
hashes of each other in turn (a Feistel network). Every round can be undone, so no two
numbers meet. A number that leaves 0 to n - 1 goes on until it is back, which also keeps
numbers apart. There is no sort and no state, so any row can be computed again alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 4
# Walks beyond the first: a number leaves with a chance of about 1 / sqrt(n) each time.
WALKS = 64


def sides(n: int) -> tuple[int, int]:
    """The table: a x b cells, a * b - n < a."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(-(-n // a), 1)


def _mixed(number: Column, a: int, b: int, seed: int) -> Column:
    def round_(s: Column, k: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], k, F.lit(seed)), F.lit(a)), F.lit(a))
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(left, k, F.lit(~seed)), F.lit(b)), F.lit(b))
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(
        F.pmod(number, F.lit(a)).cast("long").alias("l"), F.floor(number / a).cast("long").alias("r")
    )
    return F.aggregate(
        F.lit(list(range(ROUNDS))), start, round_, lambda s: s["r"] * F.lit(a) + s["l"]
    )


def permuted(number: Column, n: int, seed: int) -> Column:
    """The number that takes the place of ``number`` (0 to n - 1), as long."""
    a, b = sides(n)
    outside = a * b - n
    first = _mixed(number.cast("long"), a, b, seed)
    if not outside:
        return first
    # A walk passes every cell outside at most once.
    walks = F.sequence(F.lit(1), F.lit(min(outside, WALKS)))
    end = F.aggregate(
        walks, first, lambda x, _: F.when(x < n, x).otherwise(_mixed(x, a, b, seed))
    )
    lost = F.raise_error(F.lit(f"no number below {n} after {WALKS} walks")).cast("long")
    return F.when(end < n, end).otherwise(lost)
