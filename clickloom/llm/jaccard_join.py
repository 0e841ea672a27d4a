"""Exact Jaccard self-join of word shingles, size-aware: light sets by subsets, heavy by lists.

Shingles of a set are ordered rare first. Two sets that reach the threshold share at least k
shingles among the first ``size - overlap + k`` of each. Light (small) sets file every pair
out of their prefix (k = 2), so few others meet them; heavy (large) sets would have too many
pairs and file single shingles (k = 1), whose lists are scanned. Light sets that a heavy one
could match file both. The boundary is the size at which the estimated cost of all rows and
meetings is least.

The join is asked for connected sets, not for all links, so groups of near copies are not
expanded. Equal sets are one node. In each list the most ordinary set is the pivot; every
other is verified against it. Of the others, only sets of different components are then
compared with each other, if the list has one near in size, past three exact filters (sizes,
places of the key, and the parity of hashed shingles), and verified. A key's place bounds what
two sets share if it is their first in common (its reach: the key and all behind it); linked
sets pass that at their first common key, so it may be asked of every list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.storage import materialise

from .common import components, keep_ids, mix64, slices, string_buffers

WORDS = 3
THRESHOLD = (90, 100)
#: Counters of the frequency sketch; it only decides the order of shingles.
COUNTERS, BLOCK = 1 << 18, 1 << 12
#: One shingle in so many is counted exactly, to know how long lists are.
SAMPLED = 4096
PARITY_BITS = 512
#: Sets of more shingles than this also carry so many bits, as one array.
LARGE, LARGE_BITS = 1024, 4096
#: Bits per shingle of the wide parity, which is compared before texts are fetched.
WIDE = 2
TEXT_AT_ONCE = 1 << 20
#: Size classes told apart in a list, those of two sizes just near enough, classes counted in
#: one number, and bits for the sets of one.
CLASSES, NEAR_CLASSES, IN_ONE, COUNT_BITS = 40, 4, 10, 6
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_BYTE[[32, 9, 10, 11, 12, 13]] = 0
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of all texts, and where each text's words begin."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    letter = (raw != 32) & ~((raw >= 9) & (raw <= 13))
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    first[inner] = letter[inner]  # a text begins a word of its own
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    ends = np.append(starts[1:], len(raw))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, ends - starts)
    powers = np.full(int(place.max()) + 1, _STEP)
    powers[0] = 1
    powers = np.cumprod(powers)
    values = _BYTE[raw[starts[0] :]] * powers[place]
    return mix64(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, offsets)


def shingle_sets(
    raw: np.ndarray, offsets: np.ndarray, width: int = WORDS
) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words."""
    words, bounds = word_hashes(raw, offsets)
    inner = words * np.uint64(0xC2B2AE3D27D4EB4F)
    joined = words.copy()
    for k in range(1, width):
        joined = mix64(joined[:-1] + inner[k:])
    for start, end in zip(bounds, bounds[1:]):
        if end - start >= width:
            yield np.unique(joined[start : end - width + 1])
        elif end > start:
            # A short text is one shingle; its length keeps it apart from longer ones.
            whole = xxhash.xxh3_64_intdigest(words[start:end].tobytes(), int(end - start))
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def sets_of(
    batches: Iterator[pa.RecordBatch], width: int = WORDS
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        raw, offsets = string_buffers(batch.column("text"))
        for first, last in slices(offsets, TEXT_AT_ONCE):
            part = offsets[first : last + 1]
            own = shingle_sets(raw[part[0] : part[-1]], part - part[0], width)
            yield batch.slice(first, last - first), list(own)


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) if len(shingles) else 0


def overlap_at_least(n: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Shingles that a set of ``n`` shares with any set it is linked to."""
    return -(-threshold[0] * n // threshold[1])


def can_differ(n: int, threshold: tuple[int, int] = THRESHOLD) -> bool:
    """Whether a set of ``n`` can be linked to one that is larger."""
    return n > 0 and threshold[1] * n >= threshold[0] * (n + 1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())


def _first_pass(docs: DataFrame, width: int) -> DataFrame:
    """Rows of three kinds: 0 a document and its set, 1 a block of the sketch, 2 a sampled
    shingle with the number of its documents in this task."""
    from pyspark import TaskContext

    schema = "kind int, doc_id long, set_id long, n long, counts binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint32)
        sampled: dict[int, int] = {}
        limit = np.uint64(2**64 // SAMPLED)
        for batch, sets in sets_of(batches, width):
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            low = (every & np.uint64(COUNTERS - 1)).astype(np.int64)
            counters += np.bincount(low, minlength=COUNTERS).astype(np.uint32)
            for h in mix64(every)[mix64(every) < limit].tolist():
                sampled[h] = sampled.get(h, 0) + 1
            rows = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(rows, np.int32)),
                    batch.column("doc_id"),
                    _signed(np.array([set_id(s) for s in sets], np.uint64)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(rows, pa.binary()),
                ],
                names=names,
            )
        task = TaskContext.get().partitionId()
        blocks = counters.reshape(-1, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(blocks), 1, np.int32)),
                pa.array(np.arange(len(blocks)), pa.int64()),
                pa.array(np.full(len(blocks), task // 256), pa.int64()),
                pa.nulls(len(blocks), pa.int64()),
                pa.array([b.astype("<u4").tobytes() for b in blocks], pa.binary()),
            ],
            names=names,
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(sampled), 2, np.int32)),
                pa.nulls(len(sampled), pa.int64()),
                _signed(np.fromiter(sampled, np.uint64, len(sampled))),
                pa.array(list(sampled.values()), pa.int64()),
                pa.nulls(len(sampled), pa.binary()),
            ],
            names=names,
        )

    return docs.mapInArrow(run, schema)


def _levels(passed: DataFrame) -> np.ndarray:
    """Half binary logarithms of the sketch's counters; added up in two steps, so that no
    group is larger than 256 tasks or the number of such groups."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.uint64)
        for x in table.column("counts").to_pylist():
            total += np.frombuffer(x, "<u8" if len(x) == 8 * BLOCK else "<u4")
        return pa.table(
            {"block": table.column("block")[:1], "counts": pa.array([total.astype("<u8").tobytes()])}
        )

    blocks = passed.filter("kind = 1").select(
        F.col("doc_id").alias("block"), F.col("set_id").alias("tasks"), "counts"
    )
    schema = "block long, counts binary"
    some = blocks.groupBy("block", "tasks").applyInArrow(add, schema)
    found = some.groupBy("block").applyInArrow(add, schema).collect()  # COUNTERS in all
    counters = np.zeros(COUNTERS)
    for r in found:
        counters[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<u8")
    return np.floor(2 * np.log2(counters + 1)).astype(np.uint8)


def boundary(passed: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Least size of heavy sets: where rows filed plus meetings cost least."""
    lists = passed.filter("kind = 2").groupBy("set_id").agg(F.sum("n").alias("n"))
    total, distinct = lists.agg(F.sum("n"), F.count(F.lit(1))).first()
    meetings = (total or 0) / max(1, distinct)  # sets on an average list
    # Sizes in steps of an eighth of their binary logarithm: a few hundred at most.
    step = F.floor(8 * F.log2(F.col("n").cast("double")))
    sizes = passed.filter("kind = 0 AND n > 0").groupBy(step.alias("step")).count().collect()
    known = sorted((max(1, int(2 ** ((r["step"] + 0.5) / 8))), r["count"]) for r in sizes)

    def costs(n: int) -> tuple[float, float]:
        prefix = n - overlap_at_least(n, threshold) + 1
        return prefix * (prefix + 1) / 2, prefix * meetings

    best, chosen = None, 1
    for edge in [1] + [n + 1 for n, _ in known]:
        cost = 0.0
        for n, count in known:
            light, heavy = costs(n)
            cost += count * (light if n < edge else heavy)
            if n < edge and threshold[1] * n >= threshold[0] * edge:
                cost += count * heavy
        if best is None or cost < best:
            best, chosen = cost, edge
    return chosen


PARITY = [f"p{k}" for k in range(PARITY_BITS // 64)]
#: The same bits folded to half as many, which is what rows of a list carry.
FOLDED = [f"q{k}" for k in range(len(PARITY) // 2)]


def fold(odd: np.ndarray, size: int) -> np.ndarray:
    """Parities over fewer bits; both sizes are powers of two."""
    return np.bitwise_xor.reduce(odd.reshape(-1, size), axis=0)


def _narrowed(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those of ``pairs`` (a, b) that the wide parity does not rule out.

    It has WIDE bits per shingle, so hardly any pair far below the threshold passes,
    however large the sets are, and no pair at the threshold is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        num, den = threshold
        for batch in batches:
            keep = []
            names = ("left", "right", "left_n", "right_n")
            for x, y, n, m in zip(*(batch.column(k).to_pylist() for k in names)):
                x, y = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (x, y))
                size = min(len(x), len(y))
                apart = int(np.count_nonzero(fold(x, size) != fold(y, size)))
                keep.append(apart * (den + num) <= (den - num) * (n + m))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"]
            )

    left = sets.select(F.col("set_id").alias("a"), F.col("wide").alias("left"), F.col("n").alias("left_n"))
    right = sets.select(F.col("set_id").alias("b"), F.col("wide").alias("right"), F.col("n").alias("right_n"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.mapInArrow(run, "a long, b long")


def _second_pass(
    docs: DataFrame, levels: np.ndarray, edge: int, threshold: tuple[int, int], width: int
) -> DataFrame:
    """One row per distinct set that can have a partner: its keys and its filters."""
    schema = (
        "set_id long, n long, ordinary int, keys array<long>, reach array<long>, wide binary, "
        "full array<long>, " + ", ".join(f"{p} long" for p in PARITY)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in sets_of(batches, width):
            ids, sizes, ordinary, keys, reach, parity, wide, full = [], [], [], [], [], [], [], []
            for own in sets:
                n = len(own)
                name = set_id(own)
                smaller = can_differ(n - 1, threshold)
                if not (can_differ(n, threshold) or smaller) or name in seen:
                    continue
                if len(seen) > 200_000:  # only spares rows
                    seen.clear()
                seen.add(name)
                level = levels[(own & np.uint64(COUNTERS - 1)).astype(np.int64)]
                prefix = n - overlap_at_least(n, threshold) + 1
                front = own[np.lexsort((own, level))[: prefix + 1]]
                filed, behind = [], []
                if n < edge:
                    a, b = np.array(list(combinations(range(len(front)), 2))).T.reshape(2, -1)
                    filed.append(mix64(front[a] * _STEP + front[b]))
                    behind.append(n + 1 - b)
                if n >= edge or threshold[1] * n >= threshold[0] * edge:
                    filed.append(front[:prefix])
                    behind.append(n - np.arange(prefix))
                size = max(PARITY_BITS, 1 << (WIDE * n - 1).bit_length())
                spot = (own >> np.uint64(20)) & np.uint64(size - 1)
                odd = (np.bincount(spot.astype(np.int64), minlength=size) & 1).astype(np.uint8)
                wide.append(np.packbits(odd).tobytes())
                large = n > LARGE
                full.append(np.packbits(fold(odd, LARGE_BITS)).view("<i8").tolist() if large else None)
                bits = fold(odd, PARITY_BITS)
                ids.append(name)
                sizes.append(n)
                ordinary.append(int(1000 * level.mean()))
                keys.append(np.concatenate(filed).view(np.int64))
                reach.append(np.concatenate(behind))
                parity.append(np.packbits(bits).view("<i8"))
            counts = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            left = np.concatenate(reach) if reach else np.zeros(0, np.int64)
            table = np.array(parity, np.int64).reshape(-1, len(PARITY))
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(np.array(ids, np.uint64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(ordinary, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(counts), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(counts), pa.array(left, pa.int64())),
                    pa.array(wide, pa.binary()),
                    pa.array(full, pa.list_(pa.int64())),
                ]
                + [pa.array(table[:, k]) for k in range(len(PARITY))],
                names=["set_id", "n", "ordinary", "keys", "reach", "wide", "full", *PARITY],
            )

    return docs.select("text").mapInArrow(run, schema).dropDuplicates(["set_id"])


def _sizes_near(n: Column, other: Column, threshold: tuple[int, int]) -> Column:
    num, den = threshold
    return den * F.least(n, other) >= num * F.greatest(n, other)


def _reach_enough(
    n: Column, reach: Column, other: Column, other_reach: Column, threshold: tuple[int, int]
) -> Column:
    """Whether sets that share no more than either reach may be linked."""
    num, den = threshold
    return (num + den) * F.least(reach, other_reach) >= num * (n + other)


def _size_class(n: Column, threshold: tuple[int, int]) -> Column:
    width = max(math.log(threshold[1] / threshold[0]), 1e-9) / NEAR_CLASSES
    return F.floor(F.ln(n) / width)


def _is_early(n: Column, reach: Column, threshold: tuple[int, int]) -> Column:
    """Whether a key stands early enough in a set of ``n`` for a link to one as large or larger.

    Of two linked sets one is early at their first common key.
    """
    return _reach_enough(n, reach, n, reach, threshold)


def _place(size_class: Column, early: Column) -> Column:
    """Where sets are counted; classes go round, so that the last is followed by the first."""
    return F.pmod(size_class, F.lit(CLASSES)) + F.when(early, 0).otherwise(CLASSES)


def _has_company(
    n: Column, reach: Column, profile: Column, pivot: Column, threshold: tuple[int, int]
) -> Column:
    """Whether a list may hold a set to link with, besides the pivot.

    ``profile`` counts the sets by place, ``pivot`` is the pivot's place.
    """
    num, den = threshold
    own, early = _size_class(n, threshold), _is_early(n, reach, threshold)
    least = _size_class(n * num / F.lit(den), threshold)
    most = _size_class((reach * (num + den) - n * num) / F.lit(num), threshold)

    def count(c: Column, kind: Column) -> Column:
        place = _place(c, kind)
        number = F.get(profile, F.floor(place / IN_ONE).cast("int"))
        shift = (COUNT_BITS * (place % IN_ONE)).cast("int")
        found = F.call_function("shiftright", number, shift)
        found = found.bitwiseAND(F.lit((1 << COUNT_BITS) - 1).cast("long"))
        return found - (place == pivot).cast("int")

    def company(c: Column) -> Column:
        self = (early & (F.pmod(c - own, F.lit(CLASSES)) == 0)).cast("int")
        # Of sets whose key stands late only larger ones are left, and only for an early one.
        return (count(c, F.lit(True)) > self) | (early & (c >= own) & (count(c, F.lit(False)) > 0))

    return F.exists(F.sequence(least, F.greatest(least, most)), company)


def listed(sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The sets on each list but its pivot:
    ``key, set_id, n, ordinary, reach, pivot, pivot_n, others``.

    ``others`` is false if no set but the pivot may be linked to this one by size and place; if
    the pivot's size is not near either, the set is left out. A list's sets are counted by class
    in a few numbers; those of lists too long for their bits all have ``others``. Without
    ``reach``, sets may share all their shingles from any key on.

    One exchange by key: the pivots are found in it and joined back to it. For that both need
    the same columns and rows, so the comparison with the pivot is one that asks for no filter.
    """
    rank = F.col("ordinary").cast("long") * (1 << 40) + F.col("set_id").bitwiseAND((1 << 40) - 1)
    places = F.col("reach") if "reach" in sets.columns else F.transform("keys", lambda _: F.col("n"))
    both = F.arrays_zip(F.col("keys").alias("key"), places.alias("reach"))
    filed = sets.select("set_id", "n", "ordinary", F.explode(both).alias("at"))
    filed = filed.select("set_id", "n", "ordinary", "at.key", "at.reach").repartition("key")

    def place(n: str, reach: str) -> Column:
        n, reach = F.col(n), F.col(reach)
        return _place(_size_class(n, threshold), _is_early(n, reach, threshold))

    def counted(number: int) -> Column:
        at = place("n", "reach")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (COUNT_BITS * (at % IN_ONE)).cast("int"))
        return F.try_sum(F.when(F.floor(at / IN_ONE) == number, one).otherwise(0))

    pivots = (
        filed.groupBy("key")
        .agg(
            F.max_by("set_id", rank).alias("pivot"),
            F.max_by("n", rank).alias("pivot_n"),
            F.max_by("reach", rank).alias("pivot_reach"),
            F.count(F.lit(1)).alias("sets"),
            *[counted(k).alias(f"count{k}") for k in range(2 * CLASSES // IN_ONE)],
        )
        .filter("sets > 1")
        .select(
            "key", "pivot", "pivot_n", "pivot_reach", "sets",
            F.array(*[f"count{k}" for k in range(2 * CLASSES // IN_ONE)]).alias("profile"),
        )
    )
    n = F.col("n")
    company = _has_company(
        n, F.col("reach"), F.col("profile"), place("pivot_n", "pivot_reach"), threshold
    )
    others = (F.col("sets") >= 1 << COUNT_BITS) | company
    near = _sizes_near(n, F.col("pivot_n"), threshold)
    both = filed.join(pivots, "key").filter(~F.col("set_id").eqNullSafe(F.col("pivot")))
    kept = both.withColumn("others", others).filter(near | F.col("others"))
    return kept.drop("sets", "profile", "pivot_reach")


def _possible(
    threshold: tuple[int, int], parity: list[str] = PARITY, one: str = "a_", other: str = ""
) -> Column:
    """Exact filters on two sets, whose columns have ``one`` and ``other`` before their names:
    sizes, and shingles of only one set, of which each changes one bit."""
    num, den = threshold
    n, m = F.col(f"{one}n"), F.col(f"{other}n")
    apart = sum(
        (F.bit_count(F.col(f"{one}{p}").bitwiseXOR(F.col(f"{other}{p}"))) for p in parity), F.lit(0)
    )
    # J >= num/den means at most (den - num) / (den + num) of both sizes are not shared.
    most = (den - num) * (n + m)
    # Few bits say nothing about large sets: these are compared on more.
    bits = F.zip_with(f"{one}full", f"{other}full", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    further = F.aggregate(bits, F.lit(0), lambda s, x: s + x)
    return F.when(
        _sizes_near(n, m, threshold) & (apart * (den + num) <= most),
        F.coalesce(further * (den + num) <= most, F.lit(True)),
    ).otherwise(False)


def mixed_pairs(rest: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a key and may be linked.

    ``rest`` is joined with itself as it is, without new names on one side, so that both
    sides read one exchange of it. Without ``reach``, only sizes and parities are compared.
    """
    apart = (F.col("one.set_id") < F.col("other.set_id")) & (
        F.col("one.component") != F.col("other.component")
    )
    may = _possible(threshold, FOLDED, "one.", "other.")
    if "reach" in rest.columns:
        names = [f"{side}.{c}" for side in ("one", "other") for c in ("n", "reach")]
        may = _reach_enough(*[F.col(c) for c in names], threshold) & may
    both = rest.alias("one").join(
        rest.alias("other"), (F.col("one.key") == F.col("other.key")) & apart & may
    )
    return both.select(F.col("one.set_id").alias("a"), F.col("other.set_id").alias("b"))


def _verified(
    pairs: DataFrame,
    docs: DataFrame,
    holders: DataFrame,
    threshold: tuple[int, int],
    width: int,
) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) whose sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    wanted = materialise(holders.join(ids, "set_id", "left_semi"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in sets_of(batches, width):
            yield pa.RecordBatch.from_arrays(
                [_signed(np.array([set_id(s) for s in sets], np.uint64)), batch.column("text")],
                names=["set_id", "text"],
            )

    held = keep_ids(docs, wanted.select("doc_id").distinct())
    texts = materialise(
        held.mapInArrow(name, "set_id long, text string")
        .join(wanted.select("set_id"), "set_id", "left_semi")
        .groupBy("set_id")
        .agg(F.first("text").alias("text"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        num, den = threshold
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                left = list(shingle_sets(*string_buffers(part.column("left")), width))
                right = list(shingle_sets(*string_buffers(part.column("right")), width))
                linked = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(den * both >= num * (len(x) + len(y) - both))
                kept = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(kept), part.column("b").filter(kept)], names=["a", "b"]
                )

    left = texts.select(F.col("set_id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("set_id").alias("b"), F.col("text").alias("right"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def join(
    docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, width: int = WORDS
) -> DataFrame:
    """Per row with an id: ``doc_id, n_shingles, component_id, set_id``.

    Two texts are linked if their sets of shingles of ``width`` words have a Jaccard
    similarity of at least ``threshold``, a fraction.

    ``component_id`` is the smallest ``doc_id`` reachable by links between texts; texts with
    the same shingles are linked. Null, empty and blank texts have no shingles and are linked
    with nothing. Rows with a null id take no part and are left out; rows that repeat an id
    are each judged by their text. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plain = plain.filter("doc_id IS NOT NULL")
    passed = materialise(_first_pass(plain, width))
    members = passed.filter("kind = 0").select("doc_id", "set_id", "n")
    holders = members.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    edge = boundary(passed, threshold)
    sets = materialise(_second_pass(plain, _levels(passed), edge, threshold, width))
    filters = ["n", "full", *PARITY]

    lists = materialise(listed(sets, threshold))

    info = sets.select("set_id", *filters)
    like = _sizes_near(F.col("n"), F.col("pivot_n"), threshold)
    stars = lists.filter(like).select("set_id", "pivot").distinct()
    one = stars.join(info, "set_id").select(
        F.col("set_id").alias("a"), F.col("pivot"), *[F.col(c).alias(f"a_{c}") for c in filters]
    )
    both = one.join(info.withColumnRenamed("set_id", "pivot"), "pivot")
    near = both.filter(_possible(threshold)).select("a", F.col("pivot").alias("b"))
    first = materialise(_narrowed(near, sets, threshold))
    links = materialise(_verified(first, plain, holders, threshold, width))
    labels = components(links)

    # Lists that still hold several components: only sets of different ones are compared. The
    # pivots have been compared with all others, so they take no part.
    labelled = (
        lists.filter("others")
        .select("key", "set_id", "n", "reach")
        .join(labels.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id"))
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("key")
    )
    half = len(FOLDED)
    small = sets.select(
        "set_id",
        "full",
        *[F.col(PARITY[k]).bitwiseXOR(F.col(PARITY[k + half])).alias(q) for k, q in enumerate(FOLDED)],
    )
    rest = materialise(labelled.join(mixed, "key", "left_semi").join(small, "set_id"))
    near = mixed_pairs(rest, threshold).distinct()
    second = materialise(_narrowed(near, sets, threshold))
    links = links.union(_verified(second, plain, holders, threshold, width))
    labels = components(links).select(F.col("node").alias("set_id"), "component")

    full = members.join(labels, "set_id", "left").withColumn(
        "component", F.when(F.col("n") > 0, F.coalesce("component", "set_id"))
    )
    # Stored, so that a component with a third of all documents can be split in the join.
    smallest = materialise(
        full.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    )
    return full.join(smallest, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "set_id",
    )
