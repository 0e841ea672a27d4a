"""Length classes, hashes of long lines and clashing names in line dedup."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import line_dedup, mixing, stages
from test_near_copies import changed, edit_distance

CLASSES = ((6, 1), (40, 3), (90, 5))


def brute(rows, classes):
    """Lines left per document, each compared with every earlier one."""
    earlier, out = [], {}
    for d, text in rows:
        kept = []
        for _, line in line_dedup.comparable(text):
            near = any(
                line == e
                or edit_distance(line, e) <= line_dedup.edits_of(min(len(line), len(e)), classes)
                for e in earlier
            )
            earlier.append(line)
            if not near:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


def lines_with_copies(rng, sizes, copies, edits):
    base = ["".join(rng.choice("abcdefgh é日") for _ in range(n)).strip() or "x" for n in sizes]
    lines = base + [changed(rng.choice(base), rng.randrange(edits), rng) for _ in range(copies)]
    rng.shuffle(lines)
    return [(d, line) for d, line in enumerate(lines) if line.strip()]


def test_long_lines_by_class_equal_brute_force(frame):
    rng = random.Random(5)
    rows = lines_with_copies(rng, [5, 8, 12, 38, 41, 60, 88, 93, 130, 160], 60, 8)
    got = {r.doc_id: r.text for r in line_dedup.dedup(frame(rows), CLASSES).collect()}
    assert got == brute(rows, CLASSES)


def test_many_lines_share_one_segment(frame):
    """Lines of one form meet in a hot segment; each is judged by its own distance."""
    rows = [(d, f"the same beginning of every line, then {d * 7919:08b} and its end") for d in range(150)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(frame(rows)).collect()}
    assert got == brute(rows, line_dedup.CLASSES)


def test_without_classes_only_equal_lines_go(frame):
    rows = [(1, "a line of some length that is kept"), (2, "a line of some length that is kept."), (3, "a line of some length that is kept")]
    got = {r.doc_id: r.text for r in line_dedup.dedup(frame(rows), ()).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1], 3: ""}


@pytest.mark.parametrize("classes", [((3, 3),), ((10, 0),), ((10, 4), (30, 2))])
def test_impossible_classes_are_refused(frame, classes):
    with pytest.raises(ValueError):
        line_dedup.dedup(frame([(1, "x")]), classes)


def test_keys_do_not_depend_on_the_way_they_are_made(monkeypatch):
    rng = random.Random(3)
    lines = ["".join(rng.choice("abé日 ") for _ in range(n)) for n in (24, 25, 25, 100, 700, 24, 301)]
    plans = {n: line_dedup.plan_of(n, True) for n in {len(x) for x in lines}}

    def keys():
        found = {}
        for rows, values in line_dedup.keys_of(lines, plans):
            for row, value in zip(rows.tolist(), values.tolist()):
                found.setdefault(row, []).append(value)
        return found

    whole = keys()
    assert sorted(whole) == list(range(len(lines)))
    monkeypatch.setattr(line_dedup, "LONG", 64)
    assert keys() == whole


def test_ids_count_letters():
    a, b = line_dedup.line_ids(["abc", "abd"]).tolist()
    assert a != b and line_dedup.line_ids([]).tolist() == []
    low = 64 - line_dedup.BAG_CLASSES * line_dedup.BAG_BITS
    assert bin((a ^ b) >> low).count("1") == 2


def test_one_very_long_line(frame):
    rng = np.random.default_rng(0)
    line = "".join(map(chr, rng.integers(97, 123, 300_000)))
    near = line[:150_000] + "#" + line[150_001:]
    got = {r.doc_id: r.text for r in line_dedup.dedup(frame([(1, line), (2, near), (3, near[::-1])])).collect()}
    assert got == {1: line, 2: "", 3: near[::-1]}


def test_clashing_names_pass_through(shipped, frame):
    rows = [(1, "one line of the table that repeats"), (2, "one line of the table that repeats"), (3, None)]
    names = "_hash _doc_id _text_hash _kept kept row owner hash doc text_hash".split()
    docs = frame(rows).withColumns({c: F.lit(c) for c in names})
    got = line_dedup.dedup(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert {r.doc_id: r.text for r in got.collect()} == {1: rows[0][1], 2: "", 3: None}
    assert all(r[c] == c for r in got.collect() for c in names)
    kept = stages.near_copies(shipped, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert all(r[c] == c for r in kept.collect() for c in names)


def test_mixing_keeps_columns_with_its_own_names(frame):
    names = "_epoch _epochs _doc_id _text_hash owner hash row epochs text_hash col lang source".split()
    docs = frame([(1, "some text of one document"), (2, None)]).withColumns({c: F.lit(c) for c in names})
    planned = mixing.plan(docs, F.col("source"), {}, budget_share=2.0, max_epochs=2)
    got = mixing.take(docs, planned)
    assert got.columns == docs.columns
    found = got.collect()
    assert [r.doc_id for r in found] == [1, 1]
    assert all(r[c] == c for r in found for c in names)
