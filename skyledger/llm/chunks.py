"""Whole texts to token ids through a cache of short pieces.

The pre-tokenizing pattern never lets a match run over a single space that is followed
by a non-space: that space always starts a match. A text can therefore be cut there, and
the tokens of a piece do not depend on the text around it. Pieces repeat, so most of them
are looked up instead of being encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# Where a space may not start a piece: a run of white space, or a character that only some
# of the libraries count as white space.
_ODD = re.compile(
    r"[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
    r"|  | \n| \Z"
)

CACHE_ENTRIES = 300_000
CACHED_CHARS = 48


def pieces(text: str) -> list[str]:
    """``text`` cut before single spaces; joined they give ``text`` again."""
    if not text:
        return []
    if _ODD.search(text) is None:
        first, *rest = text.split(" ")
        return [first, *[" " + piece for piece in rest]] if first else [" " + piece for piece in rest]
    return _careful(text)


def _careful(text: str) -> list[str]:
    """Cut before a single space between two printable ASCII characters only."""
    return _SAFE.split(text)


_SAFE = re.compile("(?<=[!-~])(?= [!-~])")


class PieceCache:
    """Encodes texts piece by piece. ``encode_new`` gets pieces that are not known yet and
    returns their values; ``CACHE_ENTRIES`` bounds the memory, not the result. When the cache is
    full it becomes the old one: pieces still in use move on, the others go with it."""

    def __init__(self, encode_new: Callable[[list[str]], Iterable]):
        self._encode_new = encode_new
        self._known: dict[str, object] = {}
        self._old: dict[str, object] = {}

    def lookup(self, texts: list[str | None]) -> list[list]:
        """The values of the pieces of each text; a null text has none."""
        if len(self._known) > CACHE_ENTRIES:
            self._known, self._old = {}, self._known
        cut = [pieces(text) if text else [] for text in texts]
        known, old = self._known, self._old
        unknown = set().union(*cut).difference(known)
        moved = {piece: old[piece] for piece in unknown if piece in old} if old else {}
        known.update(moved)
        new = list(unknown.difference(moved))
        if new:
            known.update(zip(new, self._encode_new(new)))
        found = [list(map(known.__getitem__, one)) for one in cut]
        for piece in new:
            if len(piece) > CACHED_CHARS:
                del known[piece]
        return found
