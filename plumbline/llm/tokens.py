"""Token ids of whole texts by the tokenizers library, a word at a time and remembered.

A pre-token never spans a space that follows something other than white space, so a text without
white space before a space is encoded piece by piece; other texts go to the library whole. Where no
white space adjoins other, a line break stands alone too. The word-level vocabulary drops white space
and case, so there a line break is a space and plain texts are lower-cased before they are cut.

A text that holds an added token (`<|endoftext|>`) goes to the library whole, which gives that token its one
id, as the plain call with add_special_tokens=False does. With `literal` such a token is text like any other.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import regex

#: Pieces and pre-tokens that a worker remembers at most.
REMEMBERED = 600_000
#: Below this code point, classes and case are the same in every Unicode version and nothing is
#: changed by normalisation form C.
PLAIN = regex.compile("[\\x00-\\u024f]*")
GAP = regex.compile(r"\s\x20")
RUN = regex.compile(r"\s\s")
# The pre-token patterns of the two vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


def _visible_bytes() -> dict[int, int]:
    """Byte-level vocabularies write a byte as itself if it shows, else as the next free character."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class _Pieces(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece):
        self[piece] = ids = self.encode(piece)
        return ids


class Encoder:
    """encode(text): the ids as little-endian unsigned integers of `width` bytes."""

    def __init__(self, path: str, byte_level: bool | None = None, width: int = 4, literal: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = literal
        self.added = [] if literal else [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.byte_level = self.whole.normalizer is None if byte_level is None else byte_level
        self.pattern = regex.compile(BYTE_LEVEL if self.byte_level else WORD_LEVEL)
        self.visible = _visible_bytes()
        self.kind, self.space = {2: "H", 4: "I"}[width], chr(self.visible[32])
        self.parts = _Pieces(self._part)
        self.first = _Pieces(self._piece)
        self.rest = _Pieces(lambda piece: self._piece(piece, " "))

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():
            shown = part.replace(" ", self.space)
        else:
            shown = part.encode().decode("latin-1").translate(self.visible)
        return array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _piece(self, piece: str, lead: str = "") -> bytes:
        if not (piece.isascii() or PLAIN.fullmatch(piece)):
            return self._library(lead + piece)
        piece = piece if self.byte_level else piece.lower()
        if piece.isalpha():
            return self.parts[lead + piece]
        if piece[:-1].isalpha() and piece[-1] in ",.;:!?":
            return self.parts[lead + piece[:-1]] + self.parts[piece[-1]]
        return b"".join(map(self.parts.__getitem__, self.pattern.findall(lead + piece)))

    def _library(self, text: str) -> bytes:
        return array(self.kind, self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not isinstance(text, str) or not text:
            return b""
        for known in (self.first, self.rest, self.parts):
            if len(known) > REMEMBERED:
                known.clear()
        if any(token in text for token in self.added):
            return self._library(text)
        if not self.byte_level:
            if PLAIN.fullmatch(text):
                text = text.lower().replace("\n", " ")
            return b"".join(map(self.first.__getitem__, text.split(" ")))
        if GAP.search(text):
            return self._library(text)
        if RUN.search(text):
            return self._line(text)
        return self.first["\n"].join(map(self._line, text.split("\n")))

    def _line(self, line: str) -> bytes:
        pieces = line.split(" ")
        return self.first[pieces[0]] + b"".join(map(self.rest.__getitem__, pieces[1:]))


@lru_cache(maxsize=4)
def encoder(path: str, width: int = 4) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path, width=width, literal=False)
