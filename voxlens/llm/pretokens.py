"""Splitting of texts into pre-tokens, and the cache of encoded pre-tokens."""

from __future__ import annotations

import re
import sys

#: Most entries of one worker's cache (about 350 MB); a full cache starts anew.
CACHE_ENTRIES = 1 << 20

# The pattern's classes, written out for texts within Latin-1.
_SPACE, _DIGIT, _LETTER = r"\t-\r \x85\xa0", "0-9\xb2\xb3\xb9\xbc-\xbe", "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
GENERAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_DIGIT}{_LETTER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


class Splitter:
    """Matches of the tokenizers' pattern. Texts within Latin-1 go by the same pattern with
    its classes written out, for which the standard library is faster; the others by Unicode
    properties."""

    def __init__(self):
        import regex

        self.general = regex.compile(GENERAL).findall
        self.latin = re.compile(LATIN).findall

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.general(text)
        return self.latin(text)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker and is shared by its tasks. It
    hangs on ``sys`` because functions travel by value and bring new globals each time."""
    return sys.__dict__.setdefault("_pretoken_caches", {}).setdefault(name, {})


class PieceCache(dict):
    """What ``make`` gives for a pre-token, made once while the cache has room."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, piece: str):
        if len(self) >= self.entries:
            self.clear()
        made = self[piece] = self.make(piece)
        return made
