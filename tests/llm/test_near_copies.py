"""Jaccard join, line dedup and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import fingerprints, jaccard_join, line_dedup, stages
from clickloom.llm.fingerprints import Fingerprint


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def linked_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, own in sets.items():
        for x in own:
            holders[x].append(d)
    for d, own in sets.items():
        for e, both in Counter(e for x in own for e in holders[x] if e > d).items():
            if 100 * both >= 90 * (len(own) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 11, 12, 14, 20, 40, 80, 150, 300]))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(words)) if words else 0
                kind = rng.randrange(3)
                if kind == 0:
                    words.insert(at, rng.choice(vocabulary))
                elif words and kind == 1:
                    words.pop(at)
                elif words:
                    words[at] = rng.choice(vocabulary).upper()
            rows.append((len(rows), " ".join(words)))
    large = [f"{rng.choice(vocabulary)}{rng.choice(vocabulary)}" for _ in range(3000)]
    for _ in range(12):
        words = list(large)
        for _ in range(rng.choice([0, 5, 20, 60, 120])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((len(rows), " ".join(words[: rng.choice([3000, 2900, 2500, 1100, 1000])])))
    return rows


@pytest.mark.parametrize("edge", [None, 1, 30, 10**6])
def test_components_equal_brute_force(frame, monkeypatch, edge):
    """The chosen boundary, heavy sets only, both kinds, light sets only."""
    if edge is not None:
        monkeypatch.setattr(jaccard_join, "boundary", lambda *_: edge)
    rows = near_copies(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(frame(rows)).collect()}
    assert got == linked_components(rows)


def test_join_edges(texts, clashing):
    rows = texts + [texts[0], (None, "no id at all")]
    got = jaccard_join.join(clashing(rows)).collect()
    assert len(got) == len(rows) - 1
    expected = linked_components(texts)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {
        (d, n, c) for d, (n, c) in expected.items()
    }
    assert expected[9009][1] == 9008 and expected[9002] == (0, 9002)


def test_join_of_empty_table(frame):
    assert jaccard_join.join(frame([])).count() == 0


def test_stage_keeps_one_of_each_group(shipped, frame):
    rows = near_copies(4)
    expected = {c for _, c in linked_components(rows).values()}
    docs = frame(rows + [rows[0], (None, "without id")])
    kept = stages.near_copies(shipped, docs, "")
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(ids) == Counter([*expected, None])


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


SHORT = st.text(alphabet="abé", max_size=12)


@settings(max_examples=600, deadline=None)
@given(SHORT, SHORT, st.integers(0, 3))
def test_banded_distance(a, b, edits):
    assert line_dedup.within(a, b, edits) == (edit_distance(a, b) <= edits)


def changed(text, edits, rng):
    letters = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(letters) + 1), rng.randrange(3)
        if kind == 0:
            letters.insert(at, rng.choice("ab日"))
        elif letters and kind == 1:
            letters.pop(min(at, len(letters) - 1))
        elif letters:
            letters[min(at, len(letters) - 1)] = rng.choice("ab日")
    return "".join(letters)


def test_near_lines_share_a_segment():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(24, 40)))
        b = changed(a, rng.randrange(0, 3), rng)
        if len(b) < 24 or edit_distance(a, b) > 2:
            continue
        long_, short = (a, b) if len(a) >= len(b) else (b, a)
        filed = {(k, short[x : x + n]) for k, (x, n) in enumerate(line_dedup.segments(len(short)))}
        asked = {(k, long_[x : x + n]) for k, x, n in line_dedup.probes(len(long_), len(short))}
        assert filed & asked


def deduplicated(rows):
    places = sorted(
        ((d is None, d or 0), k, line, d) for d, t in rows for k, line in line_dedup.comparable(t or "")
    )
    earlier, keep = [], set()
    for _, k, line, d in places:
        if not any(
            line == e
            or (
                min(len(line), len(e)) >= line_dedup.SHORTEST
                and abs(len(line) - len(e)) <= 2
                and edit_distance(line, e) <= 2
            )
            for e in earlier
        ):
            keep.add((d, k))
        earlier.append(line)
    return {
        d: t and "\n".join(x for k, x in enumerate(t.split("\n")) if not x.strip() or (d, k) in keep)
        for d, t in rows
    }


def test_line_dedup_equals_brute_force(clashing):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdefgh é日") for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    rows = []
    for d in range(110):
        some = [
            changed(rng.choice(base), rng.randrange(0, 4), rng) if rng.random() < 0.8 else rng.choice(["", "  ", "x"])
            for _ in range(rng.randrange(0, 5))
        ]
        rows.append((d, "\n".join(some)))
    rows += [(500, None), (501, ""), (None, base[0] + "\na line of a row without id"), (502, f"  {base[3]}  ")]
    docs = clashing(rows)
    got = line_dedup.dedup(docs)
    assert set(docs.columns) <= set(got.columns)
    found = {r.doc_id: r for r in got.collect()}
    assert {d: r.text for d, r in found.items()} == deduplicated(rows)
    for d, t in rows:
        lines = len(line_dedup.comparable(t or ""))
        assert found[d].n_lines == lines
        assert found[d].n_dropped == lines - len(line_dedup.comparable(found[d].text or ""))


def test_equal_rows_keep_the_same_lines(frame):
    got = line_dedup.dedup(frame([(1, "first line\nsecond"), (1, "first line\nsecond"), (2, "second")]))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [
        (1, "first line\nsecond"), (1, "first line\nsecond"), (2, ""),
    ]
    assert line_dedup.dedup(frame([])).count() == 0


def test_line_stage(shipped, frame):
    docs = frame(
        [(1, "same line here", 14), (2, "same line here", 14), (3, "", 0), (4, "same line here\nown", 18)],
        "doc_id long, text string, n_chars long",
    )
    kept = stages.lines(shipped, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "same line here", 14), (3, "", 0), (4, "own", 3)]


def compared_with_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for k, (d, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        changed_text = fingerprints.edited(text, following)
        own, other, next_ = map(Fingerprint.of, (text, changed_text, following))
        digest = hashlib.sha256(changed_text.encode()).hexdigest()
        out.append((d, len(text), digest, str(own), str(other), own.likeness(other), own.likeness(next_)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 6, 40])
def test_fingerprints_equal_brute_force(texts, clashing, parts):
    rows = texts[-60:] + [(5, "tied"), (5, "with another"), (None, "x y z"), (None, None)]
    got = fingerprints.compare_with_next(clashing(rows), parts).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == compared_with_next(rows)


def test_few_documents(frame):
    assert fingerprints.compare_with_next(frame([]), 3).count() == 0
    (only,) = fingerprints.compare_with_next(frame([(1, "abcdef")]), 3).collect()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()


def test_fingerprints_estimate_and_merge():
    rng = random.Random(7)
    a = "".join(rng.choice("abcdefghij ") for _ in range(20_000))
    b = "".join(rng.choice("abcdefghij ") for _ in range(60_000))
    fa, fab = Fingerprint.of(a), Fingerprint.of(a + b)
    assert abs(fa.contained_in(fab) - 1) < 0.01
    assert abs(fa.likeness(fab) - 0.25) < 0.02
    merged = fa.merge(Fingerprint.of(b))
    assert merged.likeness(fab) > 0.99
    assert str(Fingerprint.parse(str(fa))) == str(fa)
    half = fingerprints.edited(a, b)
    assert abs(fa.likeness(Fingerprint.of(half)) - 0.5) < 0.05


def test_merging_a_text_with_itself_says_nothing_of_others():
    texts = ["short", "other text", "Lorem ipsum dolor sit amet. " * 30, "Quite another text. " * 30]
    own = [Fingerprint.of(t) for t in texts]
    for f in own:
        assert f.merge(f).likeness(f) == 1.0
    for i, f in enumerate(own):
        for g in own[:i]:
            assert f.merge(f).likeness(g.merge(g)) < 0.1
            assert f.merge(g).likeness(g.merge(f)) == 1.0
    assert own[0].merge(own[1]).likeness(own[2].merge(own[3])) == 0.0


def test_mixed_lists_are_dealt_once(shipped, tmp_path):
    """Both sides of the comparison within lists read one exchange; pairs as by hand."""
    from pyspark.sql import functions as F

    from clickloom.llm import jaccard_join as jj

    rows = [
        (key, 10 * key + k, 20 + k % 4, k % 3, None, *[(k % 2) << q for q in range(len(jj.FOLDED))])
        for key in range(40)
        for k in range(9)
    ]
    schema = "key long, set_id long, n long, component long, full array<long>, "
    rest = shipped.createDataFrame(rows, schema + ", ".join(f"{q} long" for q in jj.FOLDED))
    rest.repartition(4).write.parquet(str(tmp_path / "rest"))
    pairs = jj.mixed_pairs(shipped.read.parquet(str(tmp_path / "rest")), (80, 100))
    shipped.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pairs.groupBy().agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
        got = sorted((r.a, r.b) for r in found.collect()[0].pairs)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        shipped.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hand = [
        (x[1], y[1])
        for x in rows
        for y in rows
        if x[0] == y[0] and x[1] < y[1] and x[3] != y[3] and 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2])
        and 180 * sum(bin(p ^ q).count("1") for p, q in zip(x[5:], y[5:])) <= 20 * (x[2] + y[2])
    ]
    assert got == sorted(hand) and got
    assert "ReusedExchange" in plan


def test_batches_of_long_texts_stay_small(spark, shipped):
    import pyarrow as pa

    from pyspark.sql import functions as F

    from clickloom.llm.common import BATCH_BYTES

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    texts = shipped.range(0, 4000, numPartitions=1).select(F.repeat(F.lit("x"), 8000).alias("text"))
    most = texts.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0]
    assert most <= BATCH_BYTES + 100_000


def test_lists_leave_out_pivots_and_sets_of_other_sizes(shipped, tmp_path):
    """Every pair near in size meets at a pivot or in the second comparison, few others do."""
    from pyspark.sql import functions as F

    from clickloom.llm import jaccard_join as jj

    rows, by_key = [], {}

    def add(key, n, ordinary):
        rows.append((1000 * len(rows) + key, n, ordinary, [key]))
        by_key.setdefault(key, []).append(rows[-1][:3])

    for k in range(1, 201):  # just near enough, beside a pivot that is near to neither
        for n, ordinary in ((9 * k, 1), (10 * k, 2), (100_000, 9)):
            add(k, n, ordinary)
    for k, n in enumerate((95, 100, 40, 900, 901, 7, 7000, 20, 20, 260), 300):
        add(k, 100, 9)  # lists of two
        add(k, n, 1)
    for k in range(700):  # long lists, one of a single class, one beyond what a field counts
        add(500, 3, k)
        if k < 70:
            add(501, 1 + k * k, k)
    add(600, 50, 1)
    schema = "set_id long, n long, ordinary int, keys array<long>"
    shipped.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "sets"))
    lists = jj.listed(shipped.read.parquet(str(tmp_path / "sets")), (90, 100))
    shipped.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every = lists.groupBy().agg(F.collect_list(F.struct("*")).alias("rows"))
        got = every.collect()[0].rows
        plan = every._jdf.queryExecution().executedPlan().toString()
    finally:
        shipped.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan
    found = {(r.key, r.set_id): r for r in got}
    assert len(found) == len(got)

    def near(n, m):
        return 100 * min(n, m) >= 90 * max(n, m)

    for key, members in by_key.items():
        pivot = max(members, key=lambda m: m[2])
        assert (key, pivot[0]) not in found
        for name, n, _ in members:
            row = found.get((key, name))
            if name == pivot[0] or len(members) == 1:
                continue
            if near(n, pivot[1]):
                assert row.pivot == pivot[0] and row.pivot_n == pivot[1]
            if any(near(n, m) for other, m, _ in members if other not in (name, pivot[0])):
                assert row.others
            if len(members) == 2:  # the pivot is all there is
                assert row is None if not near(n, pivot[1]) else not row.others
            if len(members) >= 64:
                assert row.others


def test_lists_leave_out_sets_whose_keys_stand_too_late(shipped, tmp_path):
    """Every pair that its key's places allow is on a list and compared; most others are not."""
    from pyspark.sql import functions as F

    from clickloom.llm import jaccard_join as jj

    rng, rows, by_key = random.Random(5), [], {}
    for key in range(1500):
        base = rng.choice([1, 9, 10, 30, 200, 5000])
        for k in range(rng.choice([2, 3, 3, 4, 5, 30])):
            n = base + rng.randrange(base // 6 + 1)
            reach = n - rng.randrange(n // 10 + 1)
            rows.append((10_000 * len(rows) + key, n, int(k == 0), [key], [reach]))
            by_key.setdefault(key, []).append((rows[-1][0], n, reach))
    schema = "set_id long, n long, ordinary int, keys array<long>, reach array<long>"
    shipped.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "sets"))
    lists = jj.listed(shipped.read.parquet(str(tmp_path / "sets")), (90, 100))
    lists.write.parquet(str(tmp_path / "lists"))
    found = {r.set_id: r for r in shipped.read.parquet(str(tmp_path / "lists")).collect()}

    def meet(a, b):
        return 190 * min(a[2], b[2]) >= 90 * (a[1] + b[1])

    pairs, spared, dropped = set(), 0, 0
    for members in by_key.values():
        pivot, *rest = members
        assert pivot[0] not in found
        for a in rest:
            if 100 * min(a[1], pivot[1]) >= 90 * max(a[1], pivot[1]):
                assert found[a[0]].pivot == pivot[0]
            near = [b for b in rest if b != a and 100 * min(a[1], b[1]) >= 90 * max(a[1], b[1])]
            pairs |= {(min(a, b)[0], max(a, b)[0]) for b in near if meet(a, b)}
            if any(meet(a, b) for b in near):
                assert found[a[0]].others
            elif near:
                spared += 1
                dropped += a[0] not in found or not found[a[0]].others
    assert dropped > 0.7 * spared > 100

    rest = shipped.read.parquet(str(tmp_path / "lists")).filter("others").withColumn("component", F.col("set_id"))
    rest = rest.withColumn("full", F.lit(None).cast("array<long>"))
    rest = rest.withColumns({q: F.lit(0).cast("long") for q in jj.FOLDED})
    got = [(r.a, r.b) for r in jj.mixed_pairs(rest, (90, 100)).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs


def test_reach_is_what_two_sets_can_share(frame):
    """Filed places, for both kinds of keys: the first key in common bounds what is shared."""
    import numpy as np

    from clickloom.llm import jaccard_join as jj

    rows = [(d, t) for d, t in near_copies(6) if len(shingles(t)) > 9][:120]
    docs, sets = frame(rows), {}
    for edge in (1, 10**6):
        filed = jj._second_pass(docs, np.zeros(jj.COUNTERS, np.uint8), edge, (90, 100), 3).collect()
        for r in filed:
            assert len(r["keys"]) == len(r["reach"]) and max(r["reach"]) == r["n"]
        sets[edge] = {r["set_id"]: dict(zip(r["keys"], r["reach"])) | {None: r["n"]} for r in filed}
    own = {}
    for (_, text), name in zip(rows, [jj.set_id(x) for _, t in rows for x in jj.shingle_sets(
        np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))]):
        own[int(np.uint64(name).view(np.int64))] = shingles(text)
    linked = 0
    for filed in sets.values():
        names = sorted(filed)
        for a in names:
            for b in names:
                both = len(own[a] & own[b])
                if a < b and 190 * both >= 90 * (len(own[a]) + len(own[b])):
                    linked += 1
                    keys = (filed[a].keys() & filed[b].keys()) - {None}
                    assert any(min(filed[a][k], filed[b][k]) >= both for k in keys)
    assert linked > 50
