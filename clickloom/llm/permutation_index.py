"""Nearest neighbours by inner product with a permutation index.

A vector is represented by its nearest pivots in order of nearness. Pivots have inverted
files: who has the pivot, and at which place. A query walks the files of its own pivots,
which gives the footrule distance between the two orders; the nearest share by footrule
is ranked again by the inner product itself.

Every vector is indexed. Vectors lie in blocks of bounded size, each with its own inverted
files, and queries visit them in batches of bounded size; what a task holds does not grow
with the tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.storage import materialise

PIVOTS = 128
PREFIX = 64  # pivots in a permutation
SHARE = 0.2  # of a block, ranked again by inner product
LEAST = 256  # vectors of a block that are ranked again at least
BLOCK = 8192
BATCH = 1024


def usable(vectors: DataFrame) -> DataFrame:
    """One row per id with a finite vector other than zero, of the most frequent dimension.

    Rows with a null id or vector, or null, infinite or NaN components take no part. Of
    several different vectors with one id, the first in their own order is used.
    """
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    fine = plain.filter(
        F.col("vec_id").isNotNull()
        & F.forall(
            "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
        )
        & F.exists("embedding", lambda x: x != 0)
    )
    single = materialise(fine.groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    size = (
        single.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    ).first()
    return single.filter(F.size("embedding") == (size["n"] if size else 0))


def permutations(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Places in order of nearness to the pivots; equally near ones by number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :PREFIX].astype(np.uint8)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component that makes all vectors equally long, so the largest inner product
    with a query (whose own is 0) belongs to the nearest vector."""
    rest = np.maximum(longest**2 - (x**2).sum(axis=1), 0.0)
    return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)


def search_block(
    ids: np.ndarray, x: np.ndarray, orders: np.ndarray,
    query_ids: np.ndarray, q: np.ndarray, query_orders: np.ndarray,
    k: int, share: float = SHARE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of one block for each query: query ids, vector ids, inner products."""
    n, length = orders.shape
    place = np.tile(np.arange(length, dtype=np.int16), n)
    by_pivot = np.argsort(orders.ravel(), kind="stable")
    cuts = np.searchsorted(orders.ravel()[by_pivot], np.arange(257))
    owner, place = by_pivot // length, place[by_pivot]
    again = min(n, max(LEAST, k + 1, math.ceil(share * n)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for own, vector, order in zip(query_ids, q, query_orders):
        # Without a common pivot the footrule is largest; a common one at places a and b
        # shortens it by twice (length - max(a, b)).
        nearer = np.zeros(n, np.int32)
        for a, pivot in enumerate(order):
            file = slice(cuts[pivot], cuts[pivot + 1])
            nearer[owner[file]] += length - np.maximum(place[file], a)
        chosen = np.argpartition(-nearer, again - 1)[:again] if again < n else np.arange(n)
        chosen = chosen[ids[chosen] != own]
        score = (x[chosen] * vector).sum(axis=1)  # the same order of additions for every row
        best = np.lexsort((ids[chosen], -score))[:k]
        out.append((np.full(len(best), own), ids[chosen][best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def search(vectors: DataFrame, is_query, k: int = 20, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest others of each query.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller ``vec_id``. With few
    candidates all of them are returned; without usable vectors nothing is.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    good = usable(vectors)
    spark = good.sparkSession
    # Bounded: PIVOTS rows.
    drawn = good.select("embedding").distinct().orderBy(F.xxhash64("embedding"), "embedding")
    found = drawn.limit(PIVOTS).collect()
    if not found:
        return spark.createDataFrame([], schema)
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)
    n, n_queries, longest = good.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.sqrt(F.max(squares))
    ).first()
    if not n_queries:
        return spark.createDataFrame([], schema)
    pivots = _lifted(np.array([r[0] for r in found]), longest)
    blocks, batches = -(-n // BLOCK), -(-n_queries // BATCH)

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("embedding").flatten()).reshape(batch.num_rows, -1)
            asked = batch.column("is_query").to_numpy(zero_copy_only=False)
            orders = permutations(_lifted(x, longest), pivots)
            flat = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
            seen = permutations(flat, pivots)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("is_query"),
                    pa.array([v.tobytes() for v in x], pa.binary()),
                    pa.array([o.tobytes() for o in orders], pa.binary()),
                    pa.array([o.tobytes() if a else None for o, a in zip(seen, asked)], pa.binary()),
                ],
                names=["vec_id", "is_query", "vector", "pivots", "query_pivots"],
            )

    kinds = "vec_id long, is_query boolean, vector binary, pivots binary, query_pivots binary"
    coded = materialise(
        good.select("vec_id", is_query.alias("is_query"), "embedding").mapInArrow(encode, kinds)
    )
    numbered = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    rows = coded.select(
        "vec_id", "vector", "pivots", numbered,
        F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch"),
    )
    queries = coded.filter("is_query").select(
        "vec_id", "vector", "query_pivots",
        F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(batches)).cast("int").alias("batch"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
    )

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        def side(t: pa.Table, orders: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            t = t.sort_by("vec_id")

            def stacked(name: str, kind: str) -> np.ndarray:
                values = t.column(name).to_pylist()
                return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)

            return t.column("vec_id").to_numpy(), stacked("vector", "<f8"), stacked(orders, "u1")

        if left.num_rows and right.num_rows:
            q, v, s = search_block(
                *side(left, "pivots"), *side(right, "query_pivots"), k=k, share=share
            )
        else:
            q = v = np.zeros(0, np.int64)
            s = np.zeros(0)
        return pa.table(
            {"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": s}
        )

    near = (
        rows.groupBy("block", "batch")
        .cogroup(queries.groupBy("block", "batch"))
        .applyInArrow(visit, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
