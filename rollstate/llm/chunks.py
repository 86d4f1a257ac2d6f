"""Splitting text into chunks that byte-level BPE vocabularies encode independently.

The tokenizer pattern never lets a match cross the position before a space that is followed by a
non-space character, so a text can be cut there.  A chunk is then encoded on its own and, as the
same words come again and again, looked up instead of encoded anew.
"""

from __future__ import annotations

import re

import regex

#: A space that starts a chunk.
_CUT = re.compile(r" (?=\S)")
#: Spaces at which a text may not be cut: before other white space or at the end.
_KEEP = re.compile(r" (?:\s|\Z)")


def cut(text: str) -> list[str]:
    """Chunks of a text; each but the first stands for itself with one space before it."""
    return _CUT.split(text) if _KEEP.search(text) else text.split(" ")


class Pieces:
    """Matches of a tokenizer's pattern."""

    def __init__(self, pattern: str):
        self._find = regex.compile(pattern).findall

    def __call__(self, text: str) -> list[str]:
        return self._find(text)
