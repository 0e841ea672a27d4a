"""Token ids of whole texts with a public tokenizer file, cached by word.

Splitting at a single space between two other characters changes no id of the two
tokenizers used here: neither joins characters across it, and a byte-level piece takes
the space at its start. So each distinct word is encoded once per worker.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Words in one generation of the cache (two generations are held), and runs of letters.
CACHE_WORDS = 200_000
CACHE_LETTERS = 500_000
LONG_WORD = 64
# A space next to other white space, or at an end of the text.
_LOOSE_SPACE = re.compile(r"(?:^|\s) | (?:\s|$)")
# White space other than space and line feed: such a text is looked through by pattern.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# ASCII marks that stand behind a word; an apostrophe may begin a piece of its own.
_MARKS = ".,;:!?*%&#$)]}|"
_FIRM_SPACE = re.compile(r"(?<=\S) (?=\S)")


def has_loose_space(text: str) -> bool:
    """The same as a search for _LOOSE_SPACE, but fast where there is none."""
    if any(c in text for c in _OTHER_SPACE):
        return bool(_LOOSE_SPACE.search(text))
    ends = text[:1] == " " or text[-1:] == " "
    return ends or "  " in text or "\n " in text or " \n" in text


class _Words(dict):
    """Ids by word; a word that is not there is asked for once."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        return self.find(word)


class WordTokenizer:
    """Ids as little-endian unsigned 32-bit bytes; special strings are ordinary text.

    ``keep_space``: the pieces of this tokenizer begin with the space before a word. Without
    it white space only separates, so a line feed is as good as a space.
    """

    def __init__(self, path: str, keep_space: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        spelling = ByteLevel(add_prefix_space=False, use_regex=False)
        self.space = " " if keep_space else ""
        self.space_sign = spelling.pre_tokenize_str(" ")[0][0] if keep_space else ""
        # Each byte has a sign of its own, so a word is spelt letter by letter.
        self.signs = {c: spelling.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.line_feed = self.encode(["\n"])[0]
        self.young = _Words(self._find)
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _plain(self, piece: str) -> bytes:
        """Ids of one run of letters up to U+00FF, which is a single piece of both tokenizers.

        Lower case and composition leave nothing to normalise, so the piece goes to the
        library's model right after its byte-level spelling.
        """
        found = [x.id for x in self.model.tokenize(piece)]
        return struct.pack(f"<{len(found)}I", *found)

    def _simple(self, word: str, sign: str) -> bytes | None:
        """Ids of a run of letters and the marks behind it, else None. These are separate
        pieces, so most words share their letters with others."""
        core = word.rstrip(_MARKS)
        if not core.isalpha():
            return None
        piece = core if self.space else core.lower()
        if not core.isascii():  # others are spelt as they are
            if max(core) > "\u00ff":
                return None
            piece = piece.translate(self.signs)
        piece = sign + piece
        ids = self.letters.get(piece)
        if ids is None:
            if len(self.letters) > CACHE_LETTERS:
                self.letters.clear()
            ids = self._plain(piece)
            if len(piece) <= LONG_WORD:
                self.letters[piece] = ids
        if len(core) == len(word):
            return ids
        tail = word[len(core) :]
        end = self.marks.get(tail)
        if end is None:
            end = self.encode([tail])[0]
            if len(tail) < 8:
                if len(self.marks) > CACHE_WORDS:
                    self.marks.clear()
                self.marks[tail] = end
        return ids + end

    def _new(self, word: str) -> bytes:
        """Ids of a word that is not cached. A line feed between two simple words is a piece
        of its own, and the second word has no space before it."""
        line, feed, rest = word.partition("\n")
        ids = self._simple(line, self.space_sign)
        while feed and ids is not None:
            line, feed, rest = rest.partition("\n")
            more = self._simple(line, "")
            ids = None if more is None else ids + self.line_feed + more
        return self.encode([self.space + word])[0] if ids is None else ids

    def _find(self, word: str) -> bytes:
        """Ids of a word that the young generation lacks; only short words enter it."""
        ids = self.old.get(word)
        if ids is None:
            ids = self._new(word)
        if len(word) <= LONG_WORD:
            if len(self.young) > CACHE_WORDS:
                self.old = dict(self.young)
                self.young.clear()
            self.young[word] = ids
        return ids

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Null texts have no ids."""
        ids_of = self.young.__getitem__
        if not self.space:
            return [
                b"".join(map(ids_of, (text or "").replace("\n", " ").split(" "))) for text in texts
            ]
        first, rest = [], []
        for text in texts:
            text = text or ""
            loose = has_loose_space(text)
            words = _FIRM_SPACE.split(text) if loose else text.split(" ")
            first.append(words[0])
            rest.append(b"".join(map(ids_of, words[1:])))
        return [start + ids for start, ids in zip(self.encode(first), rest)]


@lru_cache(maxsize=4)
def tokenizer(path: str, keep_space: bool) -> WordTokenizer:
    """One per Python worker."""
    return WordTokenizer(path, keep_space)
