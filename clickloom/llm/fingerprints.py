"""Document fingerprints: every shingle hash below a fixed share of the hash range.

Because the threshold is the same for all documents, a fingerprint grows with its text:
the union of two fingerprints is the fingerprint of both texts together, and the share of
one found in another estimates containment even when one text is far longer.

Shingles are runs of SHINGLE code points. A fingerprint is written
``scale.text hash.hashes``: the hash of the whole text tells equal texts apart from texts
whose hashes merely agree, and the hashes are sorted, in base 64.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, range_bounds, range_bucket, shuffle_partitions

SHINGLE = 16  # a power of two
SCALE = 8  # one hash in so many is kept
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
ROWS_OUT = 500


@dataclass
class Fingerprint:
    text_hash: int
    hashes: np.ndarray  # sorted distinct unsigned 32-bit
    scale: int = SCALE

    @classmethod
    def of(cls, text: str, scale: int = SCALE) -> Fingerprint:
        """A text shorter than a shingle is one shingle; an empty text has none."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        whole = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
        if len(points) >= SHINGLE:
            h, step = mix64(points + np.uint64(1)), 1
            for multiplier in _MULTIPLIERS:
                h = h[:-step] * np.uint64(multiplier) + h[step:]
                step *= 2
            h = mix64(h)
        else:
            h = mix64(np.array([whole] if text else [], np.uint64))
        kept = h[h < np.uint64(2**64 // scale)]
        # The top bits are all small, so the distinguishing ones start below them.
        low = (kept >> np.uint64(64 - 32 - (scale.bit_length() - 1))) & np.uint64(2**32 - 1)
        return cls(whole, np.unique(low.astype(np.uint32)), scale)

    def __str__(self) -> str:
        coded = base64.b64encode(self.hashes.astype("<u4").tobytes()).decode()
        return f"{self.scale}.{self.text_hash:016x}.{coded}"

    @classmethod
    def parse(cls, written: str) -> Fingerprint:
        scale, whole, coded = written.split(".")
        return cls(int(whole, 16), np.frombuffer(base64.b64decode(coded), "<u4"), int(scale))

    def merge(self, other: Fingerprint) -> Fingerprint:
        """Of both texts taken together."""
        if self.scale != other.scale:
            raise ValueError("fingerprints of different scales")
        hashes = np.union1d(self.hashes, other.hashes)
        whole = self.text_hash
        if whole != other.text_hash:
            # The merged sketch stands for both texts; without one the two hashes do.
            both = np.array(sorted((whole, other.text_hash)), "<u8")
            named = hashes.astype("<u4") if len(hashes) else both
            whole = xxhash.xxh3_64_intdigest(named.tobytes())
        return Fingerprint(whole, hashes, self.scale)

    def shared(self, other: Fingerprint) -> int:
        return len(np.intersect1d(self.hashes, other.hashes, assume_unique=True))

    def likeness(self, other: Fingerprint) -> float:
        """Estimated Jaccard similarity; 1 for equal texts, 0 if neither has a hash."""
        if self.text_hash == other.text_hash:
            return 1.0
        both = self.shared(other)
        return both / max(1, len(self.hashes) + len(other.hashes) - both)

    def contained_in(self, other: Fingerprint) -> float:
        """Estimated share of this text's shingles that the other has."""
        if self.text_hash == other.text_hash:
            return 1.0
        return self.shared(other) / max(1, len(self.hashes))


def edited(text: str, following: str) -> str:
    """The last third replaced by the first as many code points of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt so that each partition holds runs in descending ``doc_id`` and what follows.

    Adds ``_run`` (a run of the order) and ``_edge``: true for a row that only follows the
    last one of its run; the same row also stands in its own run. After the smallest id
    comes the largest. Equal ids are ordered by text; null ids come last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = range_bounds(rows, "doc_id", parts or shuffle_partitions(docs.sparkSession))
    last = len(bounds) + 1
    run = F.when(F.col("doc_id").isNull(), last).otherwise(
        F.lit(len(bounds)) - range_bucket(F.col("doc_id"), bounds)
    )
    rows = rows.withColumn("_run", run.cast("int"))
    # At most one row per run; its first id also follows the run before.
    heads = rows.groupBy("_run").agg(F.max("doc_id").alias("head")).orderBy("_run").collect()
    head: list[int | None] = [None] * (last + 1)
    before = list(range(last + 1))
    for k, r in enumerate(heads):
        head[r["_run"]] = r["head"]
        before[r["_run"]] = heads[k - 1]["_run"]
    if not heads:
        return rows.withColumn("_edge", F.lit(False))
    is_head = F.col("doc_id").eqNullSafe(F.get(F.lit(head), F.col("_run")))
    own = F.struct(F.col("_run").alias("_run"), F.lit(False).alias("_edge"))
    other = F.struct(
        F.get(F.lit(before), F.col("_run")).cast("int").alias("_run"), F.lit(True).alias("_edge")
    )
    places = F.when(is_head, F.array(own, other)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", F.explode(places).alias("_place")).select(
        "doc_id", "text", "_place.*"
    )
    return dealt.repartitionById(last + 1, F.col("_run")).sortWithinPartitions(
        "_run", "_edge", F.desc_nulls_last("doc_id"), "text"
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, "
    "contained_in_edited double, contained_in_next double"
)


def compare_with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint of each text, of its edited text, and how near these and the next text are.

    A null text is empty; repeated rows each give a row; other columns are ignored. A
    single document is its own next one. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*out)
            kinds = [pa.int64(), pa.int64()] + [pa.string()] * 3 + [pa.float64()] * 4
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )
            out.clear()
            return made

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                columns = [part.column(k).to_pylist() for k in ("doc_id", "text", "_run", "_edge")]
                for doc_id, text, run_id, edge in zip(*columns):
                    text = text or ""
                    mark = None
                    if held and held[2] == run_id:
                        mark = Fingerprint.of(text)
                        out.append(_row(*held[:2], held[3], text, mark))
                        held = None
                    if not edge:
                        held = (doc_id, text, run_id, mark or Fingerprint.of(text))
                if out:
                    yield flush()

    return with_next(docs, parts).mapInArrow(run, SCHEMA)


def _row(doc_id, text: str, own: Fingerprint, following: str, next_: Fingerprint) -> tuple:
    changed = edited(text, following)
    other = Fingerprint.of(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        str(own),
        str(other),
        own.likeness(other),
        own.likeness(next_),
        own.contained_in(other),
        own.contained_in(next_),
    )
