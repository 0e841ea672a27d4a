"""Files with several licences."""

from clickloom.llm import licenses


def test_every_licence_of_a_file_is_found(frame):
    texts = [text for _, text, _ in licenses.TEMPLATES]
    some = [texts[k] for k in (1, 7, 5)]  # MIT, BSD and CC BY-NC
    rows = [(1, "\n\n".join(texts)), (2, "\n\n".join(some)), (3, " filler ".join(reversed(texts * 2)))]
    # Other files, so that words differ in frequency; the long ones are the common ones.
    rows += [(10 + k, texts[1]) for k in range(12)] + [(30 + k, texts[7]) for k in range(8)]
    rows += [(50 + k, f"nothing of the kind {k}") for k in range(60)]
    found = {r.doc_id: r for r in licenses.scan(frame(rows)).collect()}
    every = ",".join(sorted({label for label, _, _ in licenses.TEMPLATES}))
    assert every.count(",") == 8
    assert found[1].labels == found[3].labels == every and found[1].score > 0.99
    assert found[2].labels == "bsd,cc-by-nc,mit"
    assert found[10].labels == "mit" and found[30].labels == "bsd" and found[50].labels == ""


def test_a_licence_that_every_file_has(frame):
    label, text, _ = licenses.TEMPLATES[1]
    for n in (1, 20):
        rows = licenses.scan(frame([(k, text.upper()) for k in range(n)], parts=2)).collect()
        assert [r.labels for r in rows] == [label] * n and all(r.score == 1.0 for r in rows)
