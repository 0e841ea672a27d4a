"""The pipeline's near-copy stage against brute force over its own shingles."""

import random

import corpus_pipeline


def word_sets(rows, width):
    """Sets of shingles of texts whose words are in lower case and set apart by one space."""
    out = {}
    for d, text in rows:
        words = text.split()
        last = max(1, len(words) - width + 1)
        out[d] = {tuple(words[k : k + width]) for k in range(last)}
    return out


def smallest_linked(rows, width, num):
    """Smallest id of the component of each row."""
    sets = word_sets(rows, width)
    root = {d: d for d in sets}
    changed = True
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def looser_copies(seed):
    """Groups with up to a quarter more text, or a few words changed."""
    rng = random.Random(seed)
    words, rows = [f"w{k}" for k in range(500)], []
    for size in [1, 3, 4, 5, 6, 8, 9, 12, 25, 60, 120, 250, 1500]:
        for _ in range(3):
            base = [rng.choice(words) for _ in range(size)]
            for _ in range(6):
                own = base + [rng.choice(words) for _ in range(rng.randrange(0, size // 4 + 1))]
                for _ in range(rng.choice([0, 0, 1, 1 + size // 60])):
                    own[rng.randrange(len(own))] = rng.choice(words)
                rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


def test_pipeline_links_five_words_at_four_fifths(shipped, frame):
    rows = looser_copies(1)
    expected = set(smallest_linked(rows, 5, 80).values())
    assert expected != set(smallest_linked(rows, 3, 90).values())
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    kept = stage(shipped, frame(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
