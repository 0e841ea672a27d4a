"""Texts that every operator has to take."""

# Null, empty, blank, signs only, one word, other scripts, a text of one long word, and a
# long text; the same text under another id.
EDGES = [
    (9001, None),
    (9002, ""),
    (9003, " \n "),
    (9004, "!!! 123 ###"),
    (9005, "One"),
    (9006, "日本語 テスト 😀 x😀 ý é"),
    (9007, "a" * 20_000),
    (9008, "Lorem ipsum dolor sit amet. " * 6_000),
    (9009, "Lorem ipsum dolor sit amet. " * 6_000),
]
