"""Orders of filters against walking through every order."""

import random
from collections import defaultdict
from itertools import permutations

from clickloom.llm import filter_audit


def test_ranks_are_lexicographic():
    orders = sorted("".join(p) for p in permutations("ABCDE"))
    assert [filter_audit.lehmer_rank(o) for o in orders] == list(range(120))


def test_intervals_cover_each_order_once():
    orders = sorted("".join(p) for p in permutations("ABCDE"))
    seen = defaultdict(list)
    for mask, step, start, end in filter_audit.intervals():
        for rank in range(start, end):
            seen[mask, rank].append(step)
    for mask in range(1, 32):
        fails = {f for i, f in enumerate("ABCDE") if mask >> i & 1}
        for rank, order in enumerate(orders):
            assert seen[mask, rank] == [min(order.index(f) for f in fails) + 1]
    assert not [m for m, _ in seen if m == 0]


def fails_of(docs):
    by_text = defaultdict(list)
    for d, text, _ in docs:
        by_text[text or ""].append(d)
    for d, text, source in docs:
        text = text or ""
        words = [w for w in text.replace("\x0b", " ").replace("\x0c", " ").replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") if w]
        others = [x for x in by_text[text] if x is not None]
        yield d, source or "", {
            f for f, bad in (
                ("A", len(words) < 200),
                ("B", 100 * len(set(words)) < 50 * len(words)),
                ("C", 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)),
                ("D", any(c in "#$%&*|" for c in text)),
                ("E", any(x < d for x in others) if d is not None else bool(others)),
            ) if bad
        }


def brute(docs, labels):
    good, toxic = ({d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1))
    out, removed_by = {}, defaultdict(int)
    rows = list(fails_of(docs))
    for part in {p for _, p, _ in rows}:
        own = [(d, f) for d, p, f in rows if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                failing = sum(f in x for _, x in own)
                removed_by[part, f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(x == {f} for _, x in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), (part, f),
                ]
    return {k: (*v[:-1], removed_by[v[-1]]) for k, v in out.items()}


def found(frame, docs, labels):
    kind = "doc_id long, text string, source string"
    rows = filter_audit.audit_documents(
        frame(docs, kind), frame(labels, "doc_id long, quality int, toxic int", 2)
    )
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    got = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows.collect()}
    assert all(dict(rows.dtypes)[n] == "bigint" for n in names)
    return got


def random_docs(seed, n=200):
    rng = random.Random(seed)
    texts = [None, "", " \t\n\x0b\x0c\r ", "a b", "😀 ÉÀ", "word " * 20_000]
    for _ in range(60):
        words = [rng.choice(["Alpha", "b", "c", "DDD", "e%", "é"])] * rng.choice([0, 5, 150])
        words += [f"w{rng.randrange(300)}" for _ in range(rng.choice([0, 60, 190, 260]))]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    docs = [(k, rng.choice(texts), rng.choice(["s0", "s1", None, ""])) for k in range(n)]
    docs += [docs[3]] * 5 + [(None, docs[5][1], "s1"), (None, "only here", "s0"), (None, "only here", "s0")]
    docs += [(1000 + k, "hot copy of one text", "s0") for k in range(100)]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in range(0, n, 2)]
    return docs, labels + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (99_999, 1, 1)]


def test_equals_every_order(frame):
    for seed in range(2):
        docs, labels = random_docs(seed)
        assert found(frame, docs, labels) == brute(docs, labels)


def test_empty_tables(frame):
    docs, labels = random_docs(5, 20)
    assert found(frame, [], labels) == {}
    assert found(frame, docs, []) == brute(docs, [])


def test_clashing_columns(frame, clashing):
    from pyspark.sql import functions as F

    docs, labels = random_docs(6, 30)
    more = frame(docs, "doc_id long, text string, source string").withColumns(
        {c: F.lit("x") for c in ("part", "mask", "digest", "good", "toxic", "words", "repeat")}
    )
    label = frame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    rows = filter_audit.audit_documents(more, label).collect()
    assert {(r.part, r.filter_order, r.step): r.kept for r in rows} == {
        k: v[0] for k, v in brute(docs, labels).items()
    }
