"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.storage import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which a side counted beforehand is broadcast instead of shuffled.
BROADCAST_ROWS = 1_000_000


#: Bytes of one Arrow batch between Spark and a Python worker. Spark's own limits, 10,000 rows
#: and 64 MB, let each of its copies of a batch of whole texts take tens of megabytes.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application.

    Spark serves the archive from the driver, as ``--py-files`` does. Batches to the workers
    get the limit ``BATCH_BYTES`` in a session that names none.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="clickloom-"), "clickloom-modules.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Only A-Z change; ``lower`` would touch other scripts too."""
    return F.translate(text, UPPER, LOWER)


def crc_remainder(key: Column, modulus: int) -> Column:
    """Null keys count as the empty string."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str, parts: int, accuracy: int = 100_000) -> list[int]:
    """Inner bounds that cut the non-null keys into about ``parts`` ranges of equal count."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(F.col(key), shares, accuracy)).first()[0]
    return sorted(set(found or []))


def range_bucket(key: Column, bounds: Sequence[int]) -> Column:
    """Number of bounds that are at most the key, by binary search; null keys are in bucket 0."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    listed = F.lit(list(bounds))
    found = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: at
        + F.when(
            (at + step <= len(bounds)) & (key >= F.get(listed, at + step - F.lit(1))), step
        ).otherwise(0),
    )
    return F.when(key.isNull(), 0).otherwise(found)


def keep_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key is listed in ``ids`` (stored, distinct keys).

    A list of up to BROADCAST_ROWS keys travels to the rows; a longer one is joined
    by a shuffle.
    """
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Smallest node reachable over undirected edges ``a``-``b``, as ``(node, component)``.

    Every round each node takes the smallest label next to it, then the label of its
    label. Labels are stored after each round; rounds grow with the logarithm of the
    longest path in ordinary graphs, and the loop runs until nothing changes.
    """
    both = materialise(
        edges.select("a", "b")
        .union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct()
    )
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("seen"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "seen").alias("to")
        )
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("over"))
        after = materialise(
            lower.join(jump, "to").select(
                "node", F.least("to", "over").alias("component"), "before"
            )
        )
        if after.filter("component < before").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int):
    """Row ranges of at most ``size`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
