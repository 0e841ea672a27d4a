"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is a set of shingles (runs of a few words) of one benchmark item. A document that
holds the window holds all of its shingles, so a prefix of one shingle is enough to find it
if shingles are ordered by rarity: the one with the fewest occurrences over all documents.
One pass over the texts stores where shingles of the benchmark stand. They are counted there;
a window with a shingle that no document has is dropped, the others are joined by their
prefix. What meets is bounded by position and length before the words themselves are
compared, and the words around a place travel with it, so texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.storage import materialise

from .licenses import words_of

WINDOW = 10  # words of a window; shorter items are one window
SHINGLE = 3  # words of a shingle; shorter windows are one shingle
# Bloom filter in front of the joins: bits for each key, within these bounds, and tests.
BITS_EACH, LEAST_BITS, MOST_BITS, TESTS = 64, 1 << 12, 1 << 22, 3


def shingle_hash(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(words, at + k) for k in range(width)])


def places(words: Column, width: int) -> Column:
    """First words of all runs of ``width`` words."""
    last = F.size(words) - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def hashed_places(words: Column, chosen: Column, width: int) -> Column:
    """Array of ``(at, shingle)`` of the chosen places."""
    return F.transform(
        chosen, lambda i: F.struct(i.alias("at"), shingle_hash(words, i, width).alias("shingle"))
    )


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct ``(item, words)``; null ids are the empty string."""
    split = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(F.col("text")).alias("_words"),
    ).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - window + 1, F.lit(1)))
    return (
        split.select("item", "_words", F.explode(starts).alias("_from"))
        .select("item", F.slice("_words", F.col("_from"), window).alias("words"))
        .distinct()
    )


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``(window, at, shingle)`` with the shingle's place in its window."""
    words = F.col("words")
    by_width = []
    for width in range(1, shingle + 1):
        fits = F.size(words) >= width if width == shingle else F.size(words) == width
        hashed = hashed_places(words, places(words, width), width)
        by_width.append(windows.filter(fits).select("window", F.inline(hashed)))
    all_widths = by_width[0]
    for more in by_width[1:]:
        all_widths = all_widths.unionAll(more)
    return all_widths


def _tested_bits(shingle: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(shingle, 21 * k).bitwiseAND(bits - 1) for k in range(TESTS)]


def bloom_cells(keys: DataFrame, n_keys: int) -> tuple[Column, int]:
    """A Bloom filter of the ``shingle`` hashes as a literal of 64-bit cells, and its bits.

    Its size is bounded by MOST_BITS (512 KB), so it may travel with the plan; with more keys
    it only lets more through to the join behind it.
    """
    bits = LEAST_BITS
    while bits < min(n_keys * BITS_EACH, MOST_BITS):
        bits *= 2
    bit = F.col("bit")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))
    filled = (
        keys.select(F.explode(F.array(*_tested_bits(F.col("shingle"), bits))).alias("bit"))
        .groupBy(F.shiftright(bit, 6).alias("cell"))
        .agg(F.bit_or(mask).alias("mask"))
    )
    cells = [0] * (bits // 64)
    for cell, value in filled.collect():
        cells[cell] = value
    return F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>"), bits


def passes(shingle: Column, cells: Column, bits: int) -> Column:
    found = F.lit(True)
    for bit in _tested_bits(shingle, bits):
        cell = F.get(cells, F.shiftright(bit, 6).cast("int"))
        found = found & (F.getbit(cell, bit.bitwiseAND(63).cast("int")) == 1)
    return found


def occurrences(docs: DataFrame, keys: DataFrame, n_keys: int, widths: list[int]) -> DataFrame:
    """``row, doc_id, n_words, hits, words``: places whose shingle passes the filter of
    ``keys``; the words only where there are such places."""
    words = F.col("words")
    split = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    cells, bits = bloom_cells(keys, n_keys)

    def found(width: int) -> Column:
        at = F.filter(
            places(words, width), lambda i: passes(shingle_hash(words, i, width), cells, bits)
        )
        return hashed_places(words, at, width)

    kind = "array<struct<at:int,shingle:bigint>>"
    hits = F.concat(*[found(w) for w in widths]) if widths else F.array()
    marked = split.withColumn("hits", hits.cast(kind))
    return marked.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "hits",
        F.when(F.size("hits") > 0, words).alias("words"),
    )


def count_occurrences(found: DataFrame, keys: DataFrame) -> DataFrame:
    """``(shingle, n)`` over all documents, of the shingles in ``keys`` that occur."""
    # The hash aggregate combines before its shuffle, so a frequent shingle is one row a task.
    seen = found.select(F.explode("hits.shingle").alias("shingle"))
    counted = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(keys, "shingle", "left_semi")


def rarest_shingles(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """``(window, at, shingle)``: the prefix of every window whose shingles all occur."""
    order = F.struct("n", "shingle", "at")
    return (
        shingles.join(counts, "shingle", "left")
        .groupBy("window")
        .agg(F.min(order).alias("rarest"), F.count_if(F.col("n").isNull()).alias("missing"))
        .filter("missing = 0")
        .select("window", "rarest.at", "rarest.shingle")
    )


def scan(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row of ``docs`` (doc_id, text).

    ``spans`` are the disjoint, ascending runs ``(begin, end)`` of words that stand in an
    occurrence of any window of ``items`` (item_id, text); ``items`` are the ids, as sorted
    strings, of the items with such a window. Both are empty for clean documents. Null and
    empty texts have no words; an item without words has no window. Repeated rows each give
    a row; a repeated item id counts once, a null one is the empty string. Other columns are
    ignored. Empty tables give clean documents, or no rows.
    """
    docs = docs.select("doc_id", "text")
    members = materialise(item_windows(items, window))
    windows = materialise(
        members.select("words").distinct().withColumn("window", F.monotonically_increasing_id())
    )
    shingles = materialise(window_shingles(windows, shingle))
    keys = shingles.select("shingle").distinct()
    sizes = windows.select(F.collect_set(F.least(F.size("words"), F.lit(shingle)))).first()[0]
    found = materialise(occurrences(docs, keys, keys.count(), sorted(sizes)))
    prefix = rarest_shingles(shingles, count_occurrences(found, keys))
    postings = materialise(
        prefix.join(windows, "window").select(
            "shingle", F.col("at").alias("offset"), "window", "words"
        )
    )
    per_row = materialise(matches(nearby(found, postings, window), postings))
    by_set = item_sets(per_row, members, windows)
    none = F.array().cast("array<struct<begin:int,end:int>>")
    return (
        found.select("row", "doc_id", "n_words")
        .join(per_row.select("row", "spans", "set"), "row", "left")
        .join(by_set, "set", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def nearby(found: DataFrame, postings: DataFrame, window: int) -> DataFrame:
    """``row, n_words, at, shingle, first, near``: the places whose shingle passes the filter
    of the postings, with the words in a window's reach, of which the text's ``first`` is the
    first."""
    keys = postings.select("shingle").distinct()
    cells, bits = bloom_cells(keys, keys.count())

    def with_words(hit: Column) -> Column:
        first = F.greatest(hit["at"] - window + 1, F.lit(0))
        near = F.slice("words", first + 1, hit["at"] + window - first)
        return F.struct(hit["at"], hit["shingle"], first.alias("first"), near.alias("near"))

    wanted = F.filter("hits", lambda h: passes(h["shingle"], cells, bits))
    return found.filter(F.size("hits") > 0).select(
        "row", "n_words", F.inline(F.transform(wanted, with_words))
    )


def matches(near: DataFrame, postings: DataFrame) -> DataFrame:
    """``row, spans, windows, set`` of the rows with an occurrence of a window; ``set`` names
    the set of its windows."""
    begin = F.col("at") - F.col("offset")
    length = F.size("words")
    verified = (
        near.join(postings, "shingle")
        .filter((begin >= 0) & (begin + length <= F.col("n_words")))
        .filter(F.slice("near", begin - F.col("first") + 1, length) == F.col("words"))
        .select("row", "window", begin.alias("begin"), (begin + length).alias("end"))
    )
    order = Window.partitionBy("row").orderBy("begin", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(before)
    opens = F.when(reach.isNull() | (F.col("begin") > reach), 1).otherwise(0)
    # One shuffle by row serves the order, the runs and the document.
    return (
        verified.withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "run")
        .agg(
            F.struct(F.min("begin").alias("begin"), F.max("end").alias("end")).alias("span"),
            F.collect_set("window").alias("own"),
        )
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list("span")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("windows"),
        )
        .withColumn("set", F.sha2(F.array_join(F.col("windows").cast("array<string>"), ","), 256))
    )


def item_sets(per_row: DataFrame, members: DataFrame, windows: DataFrame) -> DataFrame:
    """``set, items``: the items of each distinct set of windows, looked up once for all the
    documents that share it."""
    sets = per_row.groupBy("set").agg(F.first("windows").alias("windows"))
    owners = members.join(windows, "words").select("window", "item")
    return (
        sets.select("set", F.explode("windows").alias("window"))
        .join(owners, "window")
        .groupBy("set")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Counts and digests of what ``scan`` found."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
