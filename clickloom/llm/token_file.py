"""Token ids in directly addressable files.

An id is split into chunks from its low bits up. Level 0 holds the first chunk of every
id, level 1 the second chunk of those ids that have more, and so on. A bitmap beside each
level marks the ids that go on; a rank directory holds the number of set bits before
every block of 512, so the place of an id's next chunk is one look-up and a count within a
block. Any id can be read by itself, without decoding its neighbours.

Chunk widths are chosen for each file: the widths below 16 bits with the smallest total
size for its ids, by dynamic programming over the bits already stored.

A file covers a run of whole documents in ascending ``doc_id`` order: magic, counts, level
widths, level lengths, document ids, document starts, then for each level its packed
chunks, bitmap and directory, all little-endian. The head tells where everything is, so a
reader fetches only the bytes that it needs.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.storage import materialise, shared_path

from .common import shuffle_partitions, slices, string_buffers
from .tokens import tokenizer

MAGIC = b"DAC1"
WIDEST = 15  # bits of a chunk
RANK_BITS = 512
#: A file is closed when it holds this many ids.
FILE_IDS = 1 << 22
TEXT_AT_ONCE = 2 << 20
#: Ids fetched and decoded together when a file is read through.
READ_IDS = 1 << 18
_SLAB = 1 << 16  # chunks packed together; a multiple of 8, so that slabs end on bytes


def chunk_widths(ids: np.ndarray) -> list[int]:
    """Widths of the levels, low bits first, that need the fewest bits in all."""
    sizes = np.bincount(np.frexp(ids.astype(np.float64))[1], minlength=33)  # bits of each id
    beyond = len(ids) - np.cumsum(sizes)  # ids with more than k bits
    at_level = [len(ids), *beyond[1:].tolist(), *[0] * WIDEST]
    extra = 1 + 64 / RANK_BITS  # continuation bit and directory
    cost, pick = [0.0] * len(at_level), [0] * len(at_level)
    for k in range(32, -1, -1):
        if at_level[k]:
            cost[k], pick[k] = min(
                (at_level[k] * (w + extra) + cost[k + w], w) for w in range(1, WIDEST + 1)
            )
    widths, k = [], 0
    while pick[k]:
        widths.append(pick[k])
        k += pick[k]
    return widths


def _packed(chunks: np.ndarray, width: int) -> bytes:
    """``width`` bits of each chunk, one after the other."""
    out = []
    for first in range(0, len(chunks), _SLAB):
        pairs = chunks[first : first + _SLAB].astype("<u2").view(np.uint8).reshape(-1, 2)
        bits = np.unpackbits(pairs, axis=1, bitorder="little")[:, :width]
        out.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(out)


def _unpacked(data: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """``count`` chunks that start ``skip`` bits into ``data``."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    wide = np.zeros((count, 16), np.uint8)
    wide[:, :width] = bits[skip : skip + count * width].reshape(count, width)
    return np.packbits(wide.reshape(-1), bitorder="little").view("<u2")


def encode(ids: np.ndarray, starts: np.ndarray, doc_ids: np.ndarray, present: np.ndarray) -> bytes:
    """One file. ``starts`` has one entry more than ``doc_ids``; ``present``: id is not null."""
    rest = ids.astype(np.uint32)
    widths, counts, levels = chunk_widths(rest), [], []
    for width in widths:
        counts.append(len(rest))
        more = rest >> np.uint32(width)
        goes_on = more > 0
        padded = np.zeros(-(-len(rest) // RANK_BITS) * RANK_BITS, bool)
        padded[: len(rest)] = goes_on
        per_block = padded.reshape(-1, RANK_BITS).sum(axis=1)
        directory = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u8")
        levels += [
            _packed(rest & np.uint32((1 << width) - 1), width),
            np.packbits(padded, bitorder="little").tobytes(),
            directory.tobytes(),
        ]
        rest = more[goes_on]
    head = [
        MAGIC,
        struct.pack("<QQI", len(ids), len(doc_ids), len(widths)),
        struct.pack(f"<{len(widths)}I", *widths),
        struct.pack(f"<{len(widths)}Q", *counts),
        doc_ids.astype("<i8").tobytes(),
        present.astype("<u1").tobytes(),
        starts.astype("<u8").tobytes(),
    ]
    return b"".join(head + levels)


@dataclass(frozen=True)
class _Level:
    width: int
    count: int
    chunks: int  # where they begin in the file
    bitmap: int
    directory: int


class TokenFile:
    """Reader of one file by ranges: bytes, or an open file with ``read_at(size, place)``."""

    def __init__(self, source: bytes | pa.NativeFile) -> None:
        self._source = pa.BufferReader(source) if isinstance(source, bytes) else source
        head = self._fetch(0, 24)
        if head[:4] != MAGIC:
            raise ValueError("not a token file")
        self.n_ids, self.n_docs, n_levels = struct.unpack_from("<QQI", head, 4)
        numbers = self._fetch(24, 12 * n_levels)
        widths = struct.unpack_from(f"<{n_levels}I", numbers)
        counts = struct.unpack_from(f"<{n_levels}Q", numbers, 4 * n_levels)
        self._docs = at = 24 + 12 * n_levels
        at += 9 * self.n_docs + 8 * (self.n_docs + 1)
        self.levels: list[_Level] = []
        for width, count in zip(widths, counts):
            blocks = -(-count // RANK_BITS)
            bitmap = at + -(-count * width // 8)
            directory = bitmap + blocks * RANK_BITS // 8
            self.levels.append(_Level(width, count, at, bitmap, directory))
            at = directory + 8 * blocks

    def _fetch(self, place: int, size: int) -> bytes:
        return self._source.read_at(size, place) if size else b""

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the documents, which of them are not null, and their starts with the end."""
        n = self.n_docs
        data = self._fetch(self._docs, 9 * n + 8 * (n + 1))
        return (
            np.frombuffer(data, "<i8", n),
            np.frombuffer(data, "<u1", n, 8 * n).astype(bool),
            np.frombuffer(data, "<u8", n + 1, 9 * n).astype(np.int64),
        )

    def _rank(self, level: _Level, position: int) -> int:
        """Ids before ``position`` that go on: a directory entry and a count within a block."""
        block, inside = divmod(position, RANK_BITS)
        if not inside and (not position or position == level.count):
            block, inside = (block - 1, RANK_BITS) if position else (0, 0)
        (before,) = struct.unpack("<Q", self._fetch(level.directory + 8 * block, 8))
        bits = self._fetch(level.bitmap + block * RANK_BITS // 8, -(-inside // 8))
        return before + (int.from_bytes(bits, "little") & ((1 << inside) - 1)).bit_count()

    def get(self, position: int) -> int:
        """The id at one position, without decoding any other."""
        if not 0 <= position < self.n_ids:
            raise IndexError(position)
        value = shift = 0
        for level in self.levels:
            place, skip = divmod(position * level.width, 8)
            data = self._fetch(level.chunks + place, -(-(skip + level.width) // 8))
            chunk = int.from_bytes(data, "little") >> skip & ((1 << level.width) - 1)
            value |= chunk << shift
            if not self._fetch(level.bitmap + (position >> 3), 1)[0] >> (position & 7) & 1:
                break
            position = self._rank(level, position)
            shift += level.width
        return value

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids from ``first`` up to ``last``; on each level they lie side by side."""
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        for level in self.levels:
            if first == last:
                break
            place, skip = divmod(first * level.width, 8)
            end = -(-last * level.width // 8)
            data = self._fetch(level.chunks + place, end - place)
            chunks = _unpacked(data, skip, last - first, level.width)
            marks = self._fetch(level.bitmap + first // 8, -(-last // 8) - first // 8)
            bits = np.unpackbits(np.frombuffer(marks, np.uint8), bitorder="little")
            flags = bits[first % 8 : first % 8 + last - first].astype(bool)
            found.append((level.width, chunks, flags))
            first = self._rank(level, first)
            last = first + int(np.count_nonzero(flags))
        rest = np.zeros(0, np.uint32)
        for width, chunks, flags in reversed(found):
            value = chunks.astype(np.uint32)
            value[flags] |= rest << np.uint32(width)
            rest = value
        return rest

    def all(self) -> np.ndarray:
        return self.ids(0, self.n_ids)


def _put(path: str, data: bytes) -> None:
    """A file appears under its name only when whole; a repeated task writes the same."""
    store, place = fs.FileSystem.from_uri(path)
    own = f"{place}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, place)


def _open(path: str) -> pa.NativeFile:
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def _checksums(file: TokenFile, starts: np.ndarray) -> list[int]:
    """Of each document's ids, fetched in runs of ``READ_IDS``."""
    crcs, crc, doc = [], 0, 0
    for first in range(0, int(starts[-1]), READ_IDS):
        last = min(first + READ_IDS, int(starts[-1]))
        raw = file.ids(first, last).astype("<u4").tobytes()
        at = first
        while at < last:
            end = min(last, int(starts[doc + 1]))
            crc = zlib.crc32(raw[4 * (at - first) : 4 * (end - first)], crc)
            at = end
            if end == starts[doc + 1]:
                crcs.append(crc)
                crc, doc = 0, doc + 1
    return crcs


MANIFEST = "part int, file int, path string, n_docs long, n_ids long"


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, parts: int | None = None,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every text into files below ``folder``; returns the stored list of files.

    Documents are ordered by ``doc_id`` over all files: null ids first, equal ids by
    their text. A null text is empty and has only the end id. Columns other than
    ``doc_id`` and ``text`` are ignored. An empty table has no files.
    """
    from pyspark import TaskContext

    # The folder is made here, so a task only adds files to it.
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(parts or shuffle_partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        encoder, end = tokenizer(tokenizer_path, False), np.array([end_id], "<u4").tobytes()
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal number, held
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            data = encode(
                np.frombuffer(b"".join(ids), "<u4"),
                np.concatenate([[0], np.cumsum(lengths)]),
                np.array([x or 0 for x in names], np.int64),
                np.array([x is not None for x in names], bool),
            )
            path = f"{folder}/part-{part:06d}-{number:06d}.dac"
            _put(path, data)
            row = [[part], [number], [path], [len(ids)], [int(lengths.sum())]]
            number, held = number + 1, 0
            ids.clear()
            names.clear()
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(row, kinds)],
                names=["part", "file", "path", "n_docs", "n_ids"],
            )

        for batch in batches:
            _, offsets = string_buffers(batch.column("text"))
            for first, last in slices(offsets, TEXT_AT_ONCE):
                rows = batch.slice(first, last - first)
                found = encoder.batch(rows.column("text").to_pylist())
                for name, own in zip(rows.column("doc_id").to_pylist(), found):
                    ids.append(own + end)
                    names.append(name)
                    held += len(own) // 4 + 1
                    if held >= file_ids:
                        yield close()
        if ids:
            yield close()

    return materialise(ordered.mapInArrow(run, MANIFEST))


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it, over all files.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("_ids"))  # one row per task
    parts = totals.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_part"))
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.join(parts, "part").select(
        "path", (F.col("_part") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*(batch.column(k).to_pylist() for k in ("path", "first"))):
                with _open(path) as source:
                    file = TokenFile(source)
                    doc_ids, present, starts = file.documents()
                    crcs = _checksums(file, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64(), mask=~present),
                        pa.array(first + starts[:-1], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = placed.repartition(shuffle_partitions(spark), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write files to a new folder below the shared one and read them back."""
    spark = docs.sparkSession
    manifest = write(docs, shared_path(spark, "token-files"), tokenizer_path, end_id)
    return read(spark, manifest)
