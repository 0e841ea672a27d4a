"""Near-duplicate lines by a segment-partition edit join.

Lines are near if their edit distance is at most the ``edits`` of the shorter one's length
class. Such lines agree in one of ``edits + 1`` segments of the shorter one, at a place that
length and segment number narrow down to a few. Each distinct line files its own segments
under (length, segment number, text) and probes the substrings at which a line of its own or
a slightly smaller length could have such a segment. Segments and substrings are hashed by
differences of prefix sums, all lines of a length at once. Lines that meet are verified with
a bit-parallel edit distance restricted to a band of ``2 * edits + 1`` diagonals.

A line is dropped if an equal or near line stands earlier, by ``doc_id`` and place. Lines are
compared without white space at their ends; blank lines stay and are not compared. Lines
shorter than every class have to be equal.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.storage import materialise

from .common import keep_ids, mix64, slices, string_buffers

EDITS = 2
SHORTEST = 24
#: Length classes: (least code points, edits), by rising length and edits.
CLASSES = ((SHORTEST, EDITS),)
#: Letter classes in a line id, and bits for the count of each, modulo 2 ** BAG_BITS.
BAG_CLASSES, BAG_BITS = 12, 2
KEY_BITS = 48
SEEN_LINES = 200_000
TEXT_AT_ONCE = 2 << 20
#: Longer lines are hashed in blocks of so many code points, without prefix sums.
LONG = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.full(2 * LONG + 1, _BASE, np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS)
_INVERSES = np.full(2 * LONG + 1, pow(_BASE, -1, 2**64), np.uint64)
_INVERSES[0] = 1
_INVERSES = np.cumprod(_INVERSES)


def comparable(text: str) -> list[tuple[int, str]]:
    """Numbers and contents of the lines that are not blank."""
    return [(k, s) for k, line in enumerate(text.split("\n")) if (s := line.strip())]


def letters_of(lines: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all lines, and where each begins (one more bound at the end)."""
    letters = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    return letters, np.cumsum([0, *map(len, lines)])


def line_ids(lines: Sequence[str]) -> np.ndarray:
    """Hashes whose upper bits count the letters by class, so that ids bound the distance."""
    letters, bounds = letters_of(lines)
    rows = len(lines)
    owner = np.repeat(np.arange(rows) * BAG_CLASSES, np.diff(bounds))
    counts = np.bincount(owner + letters % BAG_CLASSES, minlength=rows * BAG_CLASSES)
    counts = counts.reshape(rows, BAG_CLASSES).astype(np.uint64) & np.uint64((1 << BAG_BITS) - 1)
    low = 64 - BAG_CLASSES * BAG_BITS
    shifts = low + BAG_BITS * np.arange(BAG_CLASSES)[::-1]
    bags = (counts << shifts.astype(np.uint64)).sum(axis=1, dtype=np.uint64)
    raw, digest = letters.tobytes(), xxhash.xxh3_64_intdigest
    ends = (4 * bounds).tolist()
    hashes = np.array([digest(raw[a:b]) for a, b in zip(ends, ends[1:])], np.uint64)
    return bags | hashes >> np.uint64(64 - low)


def edits_of(length: int, classes: Sequence[tuple[int, int]] = CLASSES) -> int:
    """Edits up to which a line counts as near to one that is not shorter."""
    return max((edits for least, edits in classes if least <= length), default=0)


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """Start and length of the segments of a line; the later ones are the longer ones."""
    parts, at, out = edits + 1, 0, []
    for k in range(parts):
        size = (length + k) // parts
        out.append((at, size))
        at += size
    return out


def probes(length: int, other: int, edits: int = EDITS) -> list[tuple[int, int, int]]:
    """Substrings of a line that can equal a segment of a line of length ``other`` or less:
    (segment number, start, length)."""
    more, out = length - other, []
    for k, (start, size) in enumerate(segments(other, edits)):
        low = max(start - k, start + more - (edits - k), 0)
        high = min(start + k, start + more + (edits - k), length - size)
        out += [(k, at, size) for at in range(low, high + 1)]
    return out


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance is at most ``edits``.

    Bit d of ``reached`` means: diagonal d - edits of the band is reached at this row with
    the current number of edits; each step moves the whole band in a few word operations.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    end = 0
    while end < high - low and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[low : len(a) - end], b[low : len(b) - end]
    n, m = len(a), len(b)
    width = 2 * edits + 1
    full = (1 << width) - 1

    def inside(row: int) -> int:
        """Diagonals whose column lies in 0..m at this row."""
        first, last = max(0, edits - row), min(width - 1, m - row + edits)
        return ((1 << (last + 1)) - 1) & ~((1 << first) - 1) if last >= first else 0

    # states[e]: diagonals reachable with at most e edits; insertions move up within a row.
    states, reached = [], 1 << edits
    for _ in range(edits + 1):
        states.append(reached & inside(0))
        reached |= reached << 1
    for row in range(1, n + 1):
        same = 0
        for d in range(width):
            column = row - 1 + d - edits
            if 0 <= column < m and a[row - 1] == b[column]:
                same |= 1 << d
        allowed, after = inside(row), []
        for e in range(edits + 1):
            now = states[e] & same  # equal letters keep the diagonal
            if e:
                now |= states[e - 1]  # replaced
                now |= states[e - 1] >> 1  # left out of b
                now |= after[e - 1] << 1  # put into b
            after.append(now & allowed & full)
        states = after
        if not states[-1]:
            return False
    return bool(states[edits] >> (m - n + edits) & 1)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = string_buffers(batch.column("text"))
        for first, last in slices(offsets, TEXT_AT_ONCE):
            yield batch.slice(first, last - first)


def _occurrences(docs: DataFrame) -> DataFrame:
    """Every line that is not blank: ``id``, a second hash, and where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            lines, owners, numbers = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = comparable(text or "")
                numbers += [number for number, _ in own]
                lines += [line for _, line in own]
                owners += [row] * len(own)
            digest = xxhash.xxh64_intdigest
            checks = [digest(line.encode("utf-8", "surrogatepass")) for line in lines]
            where = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(line_ids(lines).view(np.int64)), _signed(checks)]
                + [batch.column(k).take(where) for k in ("doc_id", "text_hash")]
                + [pa.array(numbers, pa.int32())],
                names=["id", "check", "doc_id", "text_hash", "line"],
            )

    return docs.mapInArrow(run, "id long, check long, doc_id long, text_hash long, line int")


Plan = tuple[np.ndarray, np.ndarray, np.ndarray]


def plan_of(length: int, ask: bool, classes: Sequence[tuple[int, int]] = CLASSES) -> Plan:
    """Seeds, starts and ends of what a line of this length files, or looks up (``ask``)."""
    found: list[tuple[int, int, int]] = []
    if ask:
        for other in range(max(1, length - edits_of(length, classes)), length + 1):
            edits = edits_of(other, classes)
            if edits and length - other <= edits:
                found += [(other << 8 | k, at, size) for k, at, size in probes(length, other, edits)]
    elif edits := edits_of(length, classes):
        found = [(length << 8 | k, at, size) for k, (at, size) in enumerate(segments(length, edits))]
    seeds, at, size = np.array(found, np.int64).reshape(-1, 3).T
    return seeds.astype(np.uint64), at, at + size


def _values(letters: np.ndarray) -> np.ndarray:
    return mix64(letters.astype(np.uint64) + np.uint64(1))


def _hash(letters: np.ndarray) -> int:
    """What ``keys_of`` takes from prefix sums, for one substring of any length."""
    total, scale = 0, 1
    for at in range(0, len(letters), LONG):
        part = _values(letters[at : at + LONG])
        total += scale * int((part * _POWERS[: len(part)]).sum(dtype=np.uint64))
        scale = scale * pow(_BASE, LONG, 2**64) % 2**64
    return total % 2**64


def keys_of(
    lines: Sequence[str], plans: dict[int, Plan]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of lines by their length's plan: for each key the number of its line, and the key."""

    def keys(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        return mix64(hashes + mix64(seeds)) & np.uint64((1 << KEY_BITS) - 1)

    at = 0
    while at < len(lines):
        if len(lines[at]) > LONG:
            seeds, starts, ends = plans[len(lines[at])]
            own = letters_of(lines[at : at + 1])[0]
            hashes = [_hash(own[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield np.full(len(seeds), at), keys(np.array(hashes, np.uint64), seeds)
            at += 1
            continue
        end, room = at, 2 * LONG
        while end < len(lines) and len(lines[end]) <= min(room, LONG):
            room -= len(lines[end])
            end += 1
        letters, bounds = letters_of(lines[at:end])
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(_values(letters) * _POWERS[: len(letters)], out=sums[1:])
        # Plans of all lengths in one table; each line takes the rows of its own length.
        lengths, own = np.unique(np.diff(bounds), return_inverse=True)
        used = [plans[n] for n in lengths.tolist()]
        seeds, starts, ends = (np.concatenate(x) for x in zip(*used))
        sizes = np.array([len(x[0]) for x in used])
        places, each = np.cumsum(sizes) - sizes, sizes[own]
        rows = np.repeat(np.arange(end - at), each)
        taken = np.arange(len(rows)) + np.repeat(places[own] - (np.cumsum(each) - each), each)
        first = bounds[rows] + starts[taken]
        hashes = (sums[bounds[rows] + ends[taken]] - sums[first]) * _INVERSES[first]
        yield at + rows, keys(hashes, seeds[taken])
        at = end


def _filed(docs: DataFrame, ask: bool, classes: Sequence[tuple[int, int]]) -> DataFrame:
    """Keys under which distinct lines are filed, or looked up (``ask``)."""
    shortest = min((least for least, _ in classes), default=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        plans: dict[int, Plan] = {}
        for batch in _texts(batches):
            lines = [
                line
                for text in batch.column("text").to_pylist()
                for _, line in comparable(text or "")
                if shortest is not None and len(line) >= shortest
            ]
            names = line_ids(lines)
            fresh: list[int] = []
            for k, own in enumerate(names.tolist()):
                if own in seen:  # only spares rows; copies elsewhere do no harm
                    continue
                if len(seen) >= SEEN_LINES:
                    seen.clear()
                seen.add(own)
                fresh.append(k)
            lines, names = [lines[k] for k in fresh], names[fresh]
            if len(plans) > 5000:
                plans.clear()
            for n in {len(line) for line in lines} - plans.keys():
                plans[n] = plan_of(n, ask, classes)
            keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for rows, found in keys_of(lines, plans):
                keys.append(found)
                ids.append(names[rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (keys, ids)], names=["key", "id"]
            )

    return docs.select("text").mapInArrow(run, "key long, id long")


def _bags_near(a: Column, b: Column, edits: int) -> Column:
    """A lower bound of the letter difference is at most 2 * edits: a replaced letter changes
    two counts by one, one put in or left out changes one."""
    low, top = 64 - BAG_CLASSES * BAG_BITS, (1 << BAG_BITS) - 1
    total = F.lit(0)
    for k in range(BAG_CLASSES):
        shift = low + k * BAG_BITS
        apart = (F.shiftrightunsigned(a, shift) - F.shiftrightunsigned(b, shift)).bitwiseAND(top)
        total = total + F.least(apart, F.lit(top + 1) - apart)
    return total <= 2 * edits


def close_lines(
    docs: DataFrame, firsts: DataFrame, classes: Sequence[tuple[int, int]] = CLASSES
) -> DataFrame:
    """Pairs of ids of different lines that are near, each once (``a`` < ``b``)."""
    most = max((edits for _, edits in classes), default=0)
    shortest = min((least for least, _ in classes), default=0)
    index = _filed(docs, False, classes).withColumnRenamed("id", "own")
    asked = _filed(docs, True, classes).withColumnRenamed("id", "other")
    met = (F.col("own") != F.col("other")) & _bags_near(F.col("own"), F.col("other"), most)
    candidates = materialise(
        index.join(asked, (index["key"] == asked["key"]) & met)
        .select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        .distinct()
    )
    ids = candidates.select(F.col("a").alias("id")).union(candidates.select("b")).distinct()
    wanted = materialise(firsts.join(materialise(ids), "id").select("id", "doc_id"))
    holders = materialise(wanted.select("doc_id").filter("doc_id IS NOT NULL").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            lines: list[str] = []
            for text in batch.column("text").to_pylist():
                lines += [line for _, line in comparable(text or "") if len(line) >= shortest]
            ids = pa.array(line_ids(lines).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(lines, pa.string())], names=["id", "content"]
            )

    held = keep_ids(docs.filter("doc_id IS NOT NULL"), holders).select("text")
    held = held.union(docs.filter("doc_id IS NULL").select("text"))
    contents = materialise(
        held.mapInArrow(run, "id long, content string")
        .join(wanted.select("id").distinct(), "id", "left_semi")
        .groupBy("id")
        .agg(F.min("content").alias("content"))
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())
            near = [within(a, b, edits_of(min(len(a), len(b)), classes)) for a, b in both]
            near = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(near), batch.column("b").filter(near)], names=["a", "b"]
            )

    left = contents.select(F.col("id").alias("a"), F.col("content").alias("left"))
    right = contents.select(F.col("id").alias("b"), F.col("content").alias("right"))
    return candidates.join(left, "a").join(right, "b").mapInArrow(verify, "a long, b long")


def dedup(docs: DataFrame, classes: Sequence[tuple[int, int]] = CLASSES) -> DataFrame:
    """``docs`` with the deduplicated ``text``, and ``n_lines``, ``n_dropped`` (not blank ones).

    ``classes`` are the edits allowed by the length of the shorter line: ``(least code points,
    edits)``; without any, only equal lines are dropped. More edits cost more probes, about the
    cube of their number.

    Null ids stand after all others. Rows equal in ``doc_id`` and text are one document, and
    each keeps what that document keeps. A null text stays null; other columns pass through,
    whatever their names; ``n_lines`` and ``n_dropped`` of the input are replaced.
    """
    classes = sorted((int(least), int(edits)) for least, edits in classes)
    if any(edits >= least or edits < 1 for least, edits in classes):
        raise ValueError("edits have to be at least 1 and below the length of their class")
    if [e for _, e in classes] != sorted(e for _, e in classes):
        raise ValueError("edits may not fall with length")
    hashed = F.xxhash64("text")
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), hashed.alias("text_hash"), "text"
    ).filter("text IS NOT NULL")
    place = F.struct(
        F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", F.col("line").alias("line")
    )
    firsts = materialise(
        _occurrences(plain)
        .groupBy("id", "check")
        .agg(F.min(place).alias("first"))
        .select("id", "check", "first", "first.doc_id", "first.text_hash", "first.line")
    )
    pairs = close_lines(plain, firsts, classes)
    at = firsts.groupBy("id").agg(F.min("first").alias("first"))
    later = (
        pairs.join(at.select(F.col("id").alias("a"), F.col("first").alias("_a")), "a")
        .join(at.select(F.col("id").alias("b"), F.col("first").alias("_b")), "b")
        .select(F.when(F.col("_a") > F.col("_b"), F.col("a")).otherwise(F.col("b")).alias("id"))
        .distinct()
    )
    kept = (
        firsts.join(materialise(later), "id", "left_anti")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list("line").alias("kept"))
    )
    # The row travels as one column, so that none of its names can clash.
    rest = [F.col(c) for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    whole = docs.select(
        F.col("doc_id").cast("long").alias("owner"),
        hashed.alias("hash"),
        "text",
        F.struct(*rest).alias("row"),
    )
    same = F.col("owner").eqNullSafe(kept["doc_id"]) & (F.col("hash") == kept["text_hash"])
    rows = whole.join(kept, same, "left").select("row", "text", "kept")
    schema = T.StructType([rows.schema["row"], rows.schema["text"]])
    schema = schema.add("n_lines", T.LongType()).add("n_dropped", T.LongType())

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            texts, lines, dropped = [], [], []
            for text, numbers in zip(
                batch.column("text").to_pylist(), batch.column("kept").to_pylist()
            ):
                compared = {k for k, _ in comparable(text or "")}
                gone = compared - set(numbers or ())
                if gone:
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
                texts.append(text)
                lines.append(len(compared))
                dropped.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())]
                + [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"],
            )

    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return rows.mapInArrow(rebuild, schema).select(
        *["text" if c == "text" else F.col("row").getField(c).alias(c) for c in names],
        "n_lines",
        "n_dropped",
    )
