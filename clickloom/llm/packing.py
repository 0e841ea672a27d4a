"""Packing documents into as few fixed-length sequences as possible.

Only the histogram of piece lengths decides: a linear program over configurations (which
lengths share a sequence) is solved by multiplicative weights, the next configuration
being the best-priced knapsack by dynamic programming; the fractional counts are rounded
down and what is left is filled in, largest first. The histogram has at most one row per
length, so this part is of the same size for any input. Pieces then take the places of
their length by rank, in Spark.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.ordered import running_totals
from clickloom.functions.storage import materialise

from .common import slices, string_buffers
from .tokens import tokenizer

TILT = 0.05  # that a whole sequence adds to the price of room: large pieces go first
WASTE = 0.001  # of a sequence that a priced configuration may leave free
GAP = 0.001  # above the proven bound; the coarse program is kept if it stays within
PRICED = 256  # least covered lengths priced first; twice as many while these leave waste
PROGRAMS = 3  # times the program is solved again over what rounding left
TEXT_AT_ONCE = 2 << 20


@dataclass(frozen=True)
class Pace:
    """How fast the weights of a program move."""

    step: float  # most of the scarcest length that one configuration covers per round
    rounds: int  # as small a step that the lengths take about so many
    fall: float  # of a weight's logarithm with a step
    premium: float | None  # most that a weight adds to the price of room; None: it is the price


#: Full sequences have lengths as dual prices, so a small premium is enough.
COARSE = Pace(1.0, 1, 2.0, 0.02)
#: Dual prices from the weights alone, where lengths do not fill sequences up.
FINE = Pace(0.25, 512, 0.5, None)


def best_configuration(
    lengths: np.ndarray, prices: np.ndarray, counts: np.ndarray, capacity: int
) -> np.ndarray:
    """Multiplicities, none above its count, of the knapsack with the highest total price."""
    copies: list[tuple[int, int]] = []
    for k, most in enumerate(np.minimum(counts, capacity // lengths).tolist()):
        pieces = 1
        while most > 0:  # any number up to ``most`` is a sum of these
            copies.append((k, min(pieces, most)))
            most, pieces = most - pieces, 2 * pieces
    copies.reverse()  # of equal prices the longer lengths stay
    best, worth = np.zeros(capacity + 1), np.zeros(capacity + 1)
    taken = np.zeros((len(copies), capacity + 1), bool)
    long, price = lengths.tolist(), prices.tolist()
    for row, (k, pieces) in zip(taken, copies):
        size = pieces * long[k]
        with_it, without = worth[size:], best[size:]
        np.add(best[:-size], pieces * price[k], with_it)
        np.greater(with_it, without, row[size:])
        np.maximum(with_it, without, without)
    out, room = np.zeros(len(lengths), np.int64), capacity
    for row, (k, pieces) in zip(taken[::-1], copies[::-1]):
        if row[room]:
            out[k] += pieces
            room -= pieces * int(lengths[k])
    return out


def fractional(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, pace: Pace, full: bool = False
) -> tuple[list[tuple[float, np.ndarray]], float]:
    """Configurations with fractional counts that cover every length, and a lower bound.

    A length's weight falls with its coverage; the best-priced knapsack is raised until
    it covers a share of its scarcest length. Prices of all open lengths over the worth
    of that knapsack are a feasible dual solution, hence the bound. ``full`` ends the
    program where no priced configuration is full any more.
    """
    covered, step = np.zeros(len(lengths)), min(pace.step, len(lengths) / pace.rounds)
    mixed = np.random.default_rng(0).permutation(len(lengths))  # ties spread over the sizes
    found: dict[bytes, tuple[float, np.ndarray]] = {}
    bound, enough = float(lengths @ counts) / capacity, PRICED
    while (open_ := mixed[covered[mixed] < 1 - 1e-9]).size:
        least = open_[np.argsort(covered[open_], kind="stable")]
        some, enough = 0, max(PRICED, enough // 2)
        while some < len(least):
            some = min(max(enough, 2 * some), len(least))
            priced = np.sort(least[:some])
            weight = np.exp(-pace.fall / step * (covered[priced] - covered[priced].min()))
            large = TILT * lengths[priced] / capacity
            prices = lengths[priced] * (
                weight + large if pace.premium is None else 1 + pace.premium * weight + large
            )
            taken = best_configuration(lengths[priced], prices, counts[priced], capacity)
            if int(taken @ lengths[priced]) >= (1 - WASTE) * capacity:
                enough = some
                break
        else:
            if full:
                break
        if some == len(least):
            bound = max(bound, float(counts[priced] @ prices) / float(taken @ prices))
        used = np.flatnonzero(taken)
        times = float((step * counts[priced[used]] / taken[used]).min())
        whole = np.zeros(len(lengths), np.int64)
        whole[priced] = taken
        covered[priced] += taken * times / counts[priced]
        key = whole.tobytes()
        found[key] = (found[key][0] + times if key in found else times, whole)
    return list(found.values()), bound


def solve(
    histogram: dict[int, int], capacity: int, pace: Pace, full: bool
) -> tuple[list[tuple[int, dict[int, int]]], float]:
    """Whole configurations of the rounded program, and its lower bound on sequences."""
    out: list[tuple[int, dict[int, int]]] = []
    left, bound = dict(histogram), 0.0

    def apply(times: int, taken: dict[int, int]) -> None:
        out.append((times, taken))
        for length, pieces in taken.items():
            left[length] -= times * pieces
            if not left[length]:
                del left[length]

    # Full sequences first, as often as rounding leaves some; then whatever fits best.
    for number in range(PROGRAMS + (not full)):
        if not left:
            break
        lengths = np.array(sorted(left))
        counts = np.array([left[k] for k in lengths.tolist()])
        found, proven = fractional(
            lengths, counts, capacity, pace, full=full or number < PROGRAMS
        )
        bound = bound if number else proven
        for times, taken in sorted(found, key=lambda x: -x[0]):
            pieces = {int(lengths[k]): int(taken[k]) for k in np.flatnonzero(taken)}
            whole = min([int(times + 1e-6), *(left.get(k, 0) // v for k, v in pieces.items())])
            if whole:
                apply(whole, pieces)
    fill(left, capacity, apply)
    return out, bound


def fill(left: dict[int, int], capacity: int, apply: Callable[[int, dict[int, int]], None]) -> None:
    """Pieces left by rounding, largest first."""
    while left:
        lengths = np.array(sorted(left))
        room, taken = capacity, {}
        while True:
            # The largest piece that fits, or two that fill the room to the end.
            k = int(np.searchsorted(lengths, room, side="right")) - 1
            while k >= 0 and taken.get(int(lengths[k]), 0) >= left[int(lengths[k])]:
                k -= 1
            if k < 0:
                break
            length = int(lengths[k])
            if taken and length < room:
                for first in lengths[: k + 1][::-1].tolist():
                    second = room - first
                    if second > first:
                        break
                    need = 1 + (first == second)
                    if (
                        left.get(second, 0) > taken.get(second, 0)
                        and left[first] - taken.get(first, 0) >= need
                    ):
                        length = first
                        break
            taken[length] = taken.get(length, 0) + 1
            room -= length
        apply(min(left[k] // v for k, v in taken.items()), taken)


def configurations(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """How many sequences of which lengths: ``(sequences, {length: pieces in each})``.

    A program's sequences are kept when they come within ``GAP`` of a proven lower bound,
    else the next one's are compared: full sequences alone with the rest filled in, then
    a program that also covers what fills no sequence, then finer weights.
    """
    wanted = {k: v for k, v in histogram.items() if v}
    best, bound = [], 0.0
    for pace, full in ((COARSE, True), (COARSE, False), (FINE, False)):
        found, proven = solve(wanted, capacity, pace, full)
        bound = max(bound, proven)
        if not best or sum(n for n, _ in found) < sum(n for n, _ in best):
            best = found
        if sum(n for n, _ in best) <= math.ceil(bound - 1e-6) * (1 + GAP):
            break
    return best


@dataclass
class Places:
    """For each length, runs of ranks that share a configuration."""

    first: dict[int, np.ndarray]
    runs: dict[int, np.ndarray]  # rows: first sequence, pieces in each, offset of the first

    @classmethod
    def of(cls, found: list[tuple[int, dict[int, int]]]) -> Places:
        rows: dict[int, list[tuple[int, int, int]]] = {}
        starts: dict[int, list[int]] = {}
        used: dict[int, int] = {}
        sequence = 0
        for times, taken in found:
            offset = 0
            for length in sorted(taken, reverse=True):
                starts.setdefault(length, []).append(used.get(length, 0))
                rows.setdefault(length, []).append((sequence, taken[length], offset))
                used[length] = used.get(length, 0) + times * taken[length]
                offset += length * taken[length]
            sequence += times
        return cls(
            {k: np.array(v) for k, v in starts.items()}, {k: np.array(v) for k, v in rows.items()}
        )

    def of_ranks(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of one length, by rank from 0."""
        k = np.searchsorted(self.first[length], ranks, side="right") - 1
        sequence, pieces, offset = self.runs[length][k].T
        within = ranks - self.first[length][k]
        return sequence + within // pieces, offset + within % pieces * length


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Token runs of at most ``capacity``; of a longer document only the first is shorter."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokenizer(tokenizer_path, True), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            _, offsets = string_buffers(batch.column("text"))
            for first, last in slices(offsets, TEXT_AT_ONCE):
                rows = batch.slice(first, last - first)
                out: list[list] = [[], [], [], [], []]
                found = encoder.batch(rows.column("text").to_pylist())
                for name, own in zip(rows.column("doc_id").to_pylist(), found):
                    own += end
                    n = len(own) // 4
                    start = 0
                    cuts = range(n % capacity or capacity, n + 1, capacity)
                    for number, cut in enumerate(cuts):
                        crc = zlib.crc32(own[4 * start : 4 * cut])
                        for column, x in zip(out, (name, number, start, cut - start, crc)):
                            column.append(x)
                        start = cut
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(out, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``.

    A null or empty text is its end id alone. Repeated rows are packed as often as they
    occur; other columns are ignored; an empty table gives no rows.
    """
    cut = materialise(pieces(docs, tokenizer_path, end_id, capacity))
    counted = cut.groupBy("length").count().collect()  # at most ``capacity`` rows
    places = Places.of(configurations({r["length"]: r["count"] for r in counted}, capacity))
    ranked = running_totals(
        cut,
        order=[F.col("doc_id"), F.col("piece"), F.col("ids_crc32")],
        sums={},
        group=["length"],
        rank="_rank",
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("_rank").to_numpy() - 1
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                sequence[rows], offset[rows] = places.of_ranks(int(lengths[rows[0]]), ranks[rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, schema)
