"""Benchmark windows in documents, against brute force."""

import random
import re

import pytest
from edge_texts import EDGES
from pyspark.sql import functions as F

from clickloom.llm import decontamination


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for at in range(max(len(words) - window, 0) + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, covered, owners = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                if found := windows.get(tuple(words[at : at + size])):
                    covered.update(range(at, at + size))
                    owners |= found
        out.append((doc, len(words), sorted(covered), sorted(owners)))
    return sorted(out, key=str)


def scanned(frame, docs, items, **options):
    d, i = frame(docs), frame(items, "item_id long, text string", 2)
    rows = decontamination.scan(d, i, **options).collect()
    spread = [
        (r.doc_id, r.n_words, [k for s in r.spans for k in range(s.begin, s.end)], list(r["items"]))
        for r in rows
    ]
    return sorted(spread, key=str)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(30)] + ["é", "Straße"]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 25, 40]))) for k in range(25)]
    items += [(100, items[-1][1]), (101, items[-1][1] + " " + text(5)), (5, text(12)), (None, text(14))]
    items += [(102, None), (103, ""), (104, "!!!"), (5, "again Again")]
    docs = list(EDGES)
    for k in range(80):
        parts = [text(rng.choice([0, 1, 4, 30, 200]))]
        for _ in range(rng.randrange(4)):
            source = words_of(rng.choice(items)[1])
            cut = source[rng.randrange(3) :][: rng.choice([4, 9, 10, 30])]
            parts += [" ".join(cut).upper(), text(rng.randrange(3))]
        docs.append((k, ", ".join(parts)))
    docs += [docs[-1]] * 30 + [(None, docs[-2][1])]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(frame, seed):
    docs, items = random_case(seed)
    assert scanned(frame, docs, items) == brute(docs, items)


def test_other_widths(frame):
    docs, items = random_case(9)
    assert scanned(frame, docs, items, window=4, shingle=2) == brute(docs, items, 4)
    assert scanned(frame, docs, items, window=2, shingle=5) == brute(docs, items, 2)


def test_hot_passage_in_every_document_and_item(frame):
    hot = " ".join(f"h{k}" for k in range(15))
    items = [(k, f"{hot} own{k} x y z") for k in range(60)]
    docs = [(k, f"a b c {hot} own{k % 7} x y z tail") for k in range(300)]
    assert scanned(frame, docs, items) == brute(docs, items)


def test_empty_tables(frame):
    docs, items = random_case(1)
    assert scanned(frame, docs, []) == brute(docs, [])
    assert scanned(frame, [], items) == []


def test_extra_columns_and_summary(frame, clashing):
    docs, items = random_case(2)
    plain = decontamination.summary(decontamination.scan(frame(docs), frame(items, "item_id long, text string")))
    more = frame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("words", "window", "item")})
    mixed = decontamination.summary(decontamination.scan(clashing(docs), more))
    assert mixed.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(str, plain.collect())) == sorted(map(str, mixed.collect()))


def test_no_python_in_the_plan(frame):
    docs, items = random_case(3)
    plan = decontamination.scan(frame(docs), frame(items, "item_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
