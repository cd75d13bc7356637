"""Token ids of whole texts with a public tokenizer file, every distinct piece encoded once per worker.

A text goes through the library's normalizer, pre-tokenizer and model. All three act on each piece between
blanks alone, so a piece met before needs a look-up only; ``tests/llm/test_tokens.py`` holds the ids against the
library's own ``encode`` of whole texts. A text that holds the string of an added token goes to the library as a whole,
which makes that token of it.
"""

from __future__ import annotations

import gc
import re
from struct import pack

import numpy as np

from .text import worker_cache

#: Distinct pieces a worker keeps (some 150 bytes each); the store is emptied when full.
PIECES = 1_200_000
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: What the blanks beyond ASCII begin with in UTF-8, or are.
WIDE_BLANKS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
DOUBLE = (b"  ", b"\t ", b"\n ", b"\r ", b"\x0b ", b"\x0c ")
#: Letters that normalisation leaves composed, and the punctuation behind a word: two parts in either file.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = b".,;:!?"


class Pieces(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers; a piece not met before is encoded."""

    def __init__(self, tokenizer, lead: str):
        self.lead, self.normal, self.split, self.model = lead, tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        self.letters: dict[str, str] = {}
        self.marks: dict[bytes, bytes] = {}
        # a space as the byte-level pre-tokenizer writes it
        self.shown = "Ġ" if lead else ""
        self.plain = True
        self.plain = all(self.word(x) == self.any(x) and self.any(x + b".,") == self.any(x) + self.mark(b".,") for x in ("Çédé".encode(), b"Word", "straße".encode()))

    def ids(self, parts: list[str]) -> bytes:
        found = [t.id for part in parts for t in self.model.tokenize(part)]
        return pack(f"<{len(found)}I", *found)

    def parts(self, text: str) -> list[str]:
        if self.normal is not None:
            text = self.normal.normalize_str(text)
        return [part for part, _ in self.split.pre_tokenize_str(text)] if text else []

    def any(self, piece: bytes) -> bytes:
        return self.ids(self.parts(self.lead + piece.decode("utf-8", "replace")))

    def mark(self, marks: bytes) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self.ids(self.parts(marks.decode()))
        return self.marks[marks]

    def word(self, piece: bytes) -> bytes | None:
        """What ``any`` gives for a word of letters, without its cost per call; None for any other piece."""
        if piece.isalpha():  # of bytes: ASCII letters
            word = piece.decode()
            word = word if self.normal is None else word.lower()
        else:
            word = piece.decode("utf-8", "replace")
            if not LETTERS.fullmatch(word):
                return None
            word = word if self.normal is None else word.lower()
            word = "".join([self.letters.get(c) or self.letters.setdefault(c, "".join(self.parts(c))) for c in word])
        found = [t.id for t in self.model.tokenize(self.shown + word)]
        return pack(f"<{len(found)}I", *found)

    def __missing__(self, piece: bytes) -> bytes:
        got = None
        if self.plain:
            word = piece.rstrip(MARKS)
            if len(word) == len(piece):
                got = self.word(piece)
            elif word:
                head = self.get(word) if LETTERS.fullmatch(word.decode("utf-8", "replace")) else None
                got = head or self.word(word)
                got = got and got + self.mark(piece[len(word) :])
        if got is None:
            got = self.any(piece)
        if len(self) >= PIECES:
            self.clear()
        self[piece] = got
        return got


class _Library:
    """The tokenizer as its file has it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def has_added(self, text: bytes) -> bool:
        return any(x in text for x in self.added)

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()


class WordEncoder(_Library):
    """For tokenizers that drop blanks: ids of a text are those of its words."""

    def __init__(self, path: str):
        super().__init__(path)
        self.pieces = Pieces(self.tokenizer, "")

    def __call__(self, text: bytes) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.has_added(text):
            return self.whole(text)
        return b"".join(map(self.pieces.__getitem__, text.split()))


class SpaceEncoder(_Library):
    """For byte-level tokenizers that keep a space with the word after it. A piece begins at a space; a run of
    blanks must stay whole, so texts with a space behind another blank are cut at lone spaces only."""

    def __init__(self, path: str):
        super().__init__(path)
        tokenizer = self.tokenizer
        self.first, self.pieces = Pieces(tokenizer, ""), Pieces(tokenizer, " ")
        names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.ends = np.array([bool(x) and x[-1] in ".!?Ċ" for x in names])
        self.begins = np.array([x[:1] in ("Ġ", "Ċ") for x in names])
        self.feeds = np.array([x[-1:] == "Ċ" for x in names])

    def __call__(self, text: bytes) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.has_added(text):
            return self.whole(text)
        if any(x in text for x in DOUBLE) or not text.isascii() and any(x in text for x in WIDE_BLANKS):
            words = [x.encode() for x in LONE_SPACE.split(text.decode("utf-8", "replace"))]
        else:
            words = text.split(b" ")
        return self.first[words[0]] + b"".join(map(self.pieces.__getitem__, words[1:]))

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Places behind a full stop (or ! or ?) before a blank, and behind a line feed."""
        closed = self.ends[ids[:-1]] & (self.begins[ids[1:]] | self.feeds[ids[:-1]])
        return np.flatnonzero(closed) + 1


def encoder(kind, path: str):
    # a worker makes millions of small objects that hold no cycles, which the collector would go through again and again
    gc.set_threshold(500_000, 50, 100)
    return worker_cache(f"encoder_{kind.__name__}_{path}", lambda: kind(path))
