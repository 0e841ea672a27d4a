"""Token files and packing against plain encoding by the library."""

import functools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import packing, token_file
from clickloom.llm.tokens import WordTokenizer

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = [
    "can't  stop's\n\n\n x <|endoftext|> y", "  a  b \n c\t d ", "trail \n", " lead", "DON'T! we'll).",
    "ªº µm Straße. İi Σς ΑΣ", "12a. a1! ....", "x's's. (a) [b] {c} |d| e||", "ñ é.    z",
]


@pytest.mark.parametrize("path, keep_space", [(WORD, False), (BYTE, True)])
def test_cached_words_equal_plain_encoding(texts, path, keep_space):
    cached = WordTokenizer(path, keep_space)
    rows = [t for _, t in texts] + ODD
    for _ in range(2):  # the second time from the cache
        got = cached.batch(rows)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == plain(path, rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é'.,! \n\t1ß日́s$"), max_size=40))
def test_cached_words_on_any_text(text):
    for path, keep_space in ((WORD, False), (BYTE, True)):
        got = np.frombuffer(CACHED[path].batch([text])[0], "<u4").tolist()
        assert got == plain_one(path, text)


CACHED = {WORD: WordTokenizer(WORD, False), BYTE: WordTokenizer(BYTE, True)}


def plain_one(path, text):
    return CACHED[path].tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000), max_size=1500))
def test_every_id_is_addressable(ids):
    ids = np.array(ids, np.uint32)
    data = token_file.encode(ids, np.array([0, len(ids)]), np.array([1]), np.array([True]))
    file = token_file.TokenFile(data)
    assert (file.all() == ids).all()
    assert [file.get(i) for i in range(len(ids))] == ids.tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 49_151), min_size=1, max_size=3000), st.data())
def test_any_range_of_ids(ids, data):
    array = np.array(ids, np.uint32)
    file = token_file.TokenFile(
        token_file.encode(array, np.array([0, len(ids)]), np.array([1]), np.array([True]))
    )
    first = data.draw(st.integers(0, len(ids)))
    last = data.draw(st.integers(first, len(ids)))
    assert file.ids(first, last).tolist() == ids[first:last]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**20), min_size=1, max_size=60))
def test_widths_are_the_cheapest(ids):
    def cost(widths):
        rest, total = ids, 0.0
        for width in widths:
            total += len(rest) * (width + 1 + 64 / token_file.RANK_BITS)
            rest = [x >> width for x in rest if x >> width]
        return total if not rest else float("inf")

    def every(bits):
        if bits <= 0:
            yield ()
            return
        for width in range(1, min(token_file.WIDEST, bits) + 1):
            for others in every(bits - width):
                yield (width, *others)

    bits = min(max(x.bit_length() for x in ids), 12)
    ids = [x & ((1 << bits) - 1) for x in ids]
    got = token_file.chunk_widths(np.array(ids, np.uint32))
    assert cost(got) == pytest.approx(min(cost(w) for w in every(max(bits, 1))))


class Counting:
    """Bytes fetched from a source."""

    def __init__(self, data):
        self.data, self.fetched = data, 0

    def read_at(self, size, place):
        self.fetched += size
        return self.data[place : place + size]


def test_one_token_needs_few_bytes():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.2, 400_000) - 1, 49_151).astype(np.uint32)
    data = token_file.encode(ids, np.array([0, len(ids)]), np.array([1]), np.array([True]))
    source = Counting(data)
    file = token_file.TokenFile(source)
    assert len(file.levels) > 1 and file.levels[1].count > 0
    assert len(data) < 2 * len(ids)
    for position in rng.integers(0, len(ids), 300).tolist():
        source.fetched = 0
        assert file.get(position) == ids[position]
        assert source.fetched <= len(file.levels) * (3 + 1 + 8 + token_file.RANK_BITS // 8)
    assert (file.all() == ids).all()


def test_round_trip(texts, clashing):
    rows = texts + [texts[0], (None, "no id")]
    got = token_file.round_trip(clashing(rows), WORD, end_id=2).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for (doc_id, _), ids in zip(order, plain(WORD, [t for _, t in order])):
        ids = ids + [2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected


def test_many_files_per_task(texts, frame, tmp_path):
    rows = [r for r in texts if r[0] < 9007][:60]
    manifest = token_file.write(frame(rows), f"file://{tmp_path}/files", WORD, 2, 3, file_ids=500)
    assert manifest.count() > 3
    got = token_file.read(frame(rows).sparkSession, manifest).collect()
    assert sum(r["n_tokens"] for r in got) == sum(len(x) + 1 for x in plain(WORD, [t for _, t in rows]))
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, _ in rows)


def test_packing(texts, clashing):
    rows = texts + [texts[3]]
    got = packing.pack(clashing(rows), BYTE, end_id=0).collect()
    expected = Counter()
    for (doc_id, _), ids in zip(rows, plain(BYTE, [t for _, t in rows])):
        ids = ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, piece, a, b - a, crc(ids[a:b])] += 1
    assert Counter(tuple(r)[:5] for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    bound = -(-sum(r["length"] for r in got) // 2048)
    assert len(sequences) <= 1.02 * bound + 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_configurations_hold_every_piece(histogram):
    found = packing.configurations(dict(histogram), 64)
    used = Counter()
    for times, taken in found:
        assert sum(k * v for k, v in taken.items()) <= 64
        for k, v in taken.items():
            used[k] += times * v
    assert used == Counter(histogram)
    places = packing.Places.of(found)
    seen = set()
    for length, count in histogram.items():
        sequence, offset = places.of_ranks(length, np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            cells = {(s, k) for k in range(o, o + length)}
            assert not cells & seen
            seen |= cells


def test_large_histogram_is_packed_closely():
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.lognormal(5.5, 1.0, 60_000).astype(int) + 1, 2048)
    histogram = dict(Counter(lengths.tolist()))
    used = sum(times for times, _ in packing.configurations(histogram, 2048))
    assert used <= 1.005 * -(-int(lengths.sum()) // 2048)


def fewest(histogram, capacity):
    """Optimum of a small instance by search over what fits into the next sequence."""
    lengths = sorted(histogram, reverse=True)

    @functools.cache
    def rest(counts):
        if not any(counts):
            return 0
        found = []

        def choose(k, room, left):
            if k == len(lengths):
                if not any(n and lengths[i] <= room for i, n in enumerate(left)):
                    found.append(left)
                return
            for n in range(min(left[k], room // lengths[k]) + 1):
                choose(k + 1, room - n * lengths[k], (*left[:k], left[k] - n, *left[k + 1 :]))

        first = next(i for i, n in enumerate(counts) if n)  # the largest goes into this sequence
        choose(first, capacity - lengths[first],
               (*counts[:first], counts[first] - 1, *counts[first + 1 :]))
        return 1 + min(rest(x) for x in set(found))

    return rest(tuple(histogram[k] for k in lengths))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(3, 20), st.integers(1, 4), min_size=1, max_size=4))
def test_packing_against_the_optimum(histogram):
    best = fewest(histogram, 20)
    used = sum(times for times, _ in packing.configurations(histogram, 20))
    assert best <= used <= best + 1


@pytest.mark.parametrize("n", [1, 7, 1_000, 1_000_000])
def test_lengths_that_fill_no_sequence(n):
    found = packing.configurations({900: n, 620: n, 500: n}, 2048)
    assert found == [(n, {500: 1, 620: 1, 900: 1})]


def test_every_length_has_few_pieces():
    histogram = dict.fromkeys(range(300, 1400, 7), 50)
    bound = -(-sum(k * v for k, v in histogram.items()) // 2048)
    assert sum(times for times, _ in packing.configurations(histogram, 2048)) <= 1.005 * bound


def test_empty_table(frame):
    assert packing.pack(frame([]), BYTE, 0).count() == 0
    assert token_file.round_trip(frame([]), WORD, 2).count() == 0


@pytest.mark.parametrize("path, keep_space", [(WORD, False), (BYTE, True)])
def test_words_beside_a_line_feed_are_cached_like_others(path, keep_space, monkeypatch):
    cached = WordTokenizer(path, keep_space)
    text = "Of the words.\nWere été here,\nand! so:\nOf"
    asked = []
    encode = cached.encode
    monkeypatch.setattr(cached, "encode", lambda texts: asked.extend(texts) or encode(texts))
    got = cached.batch([text])
    assert np.frombuffer(got[0], "<u4").tolist() == plain(path, [text])[0]
    assert not [x for x in asked if "\n" in x]
    again = len(cached.young)
    assert cached.batch([text]) == got and len(cached.young) == again
    odd = ["a\n\nb", "a\n b", "a.\n\tb", "a b\n", "x \n", "a b\n'll c", "a b.\n...c\nd"]
    assert [np.frombuffer(x, "<u4").tolist() for x in cached.batch(odd)] == plain(path, odd)


def test_a_full_cache_starts_a_new_generation(monkeypatch):
    monkeypatch.setattr("clickloom.llm.tokens.CACHE_WORDS", 3)
    monkeypatch.setattr("clickloom.llm.tokens.CACHE_LETTERS", 3)
    rows = ["a b c d e f g a b", "h. i! j a b c", "a b c d e f g a b"]
    for path, keep_space in ((WORD, False), (BYTE, True)):
        cached = WordTokenizer(path, keep_space)
        for _ in range(2):
            got = [np.frombuffer(x, "<u4").tolist() for x in cached.batch(rows)]
            assert got == plain(path, rows)
        assert len(cached.young) <= 5 and len(cached.letters) <= 5
