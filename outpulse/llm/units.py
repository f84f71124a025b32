"""Texts cut into short repeating units, and a bounded cache from a unit to its token ids."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# White space here leaves out 0x1C-0x1F, which the tokenizers' patterns do not count as such.
# U+0130 is left out: in lower case it ends in a mark, which is no letter.
LETTERS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u02af]+(?![^\x00-\x40\x5b-\x60\x7b-\x7f])"
SPACED = re.compile(rf" ?{LETTERS}|[ \n]?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?=[ \n][\S\x1c-\x1f])|[^\S\x1c-\x1f]+[\S\x1c-\x1f]*")
BARE = re.compile(rf"{LETTERS}|[^ \n]+")


def spaced_units(text: str) -> list[str]:
    """Units that no match of a byte-level pattern crosses; joined they are the text.

    A pattern's match holds white space only before a word or by itself, so it
    never spans the place between a word's last character and the white space
    behind it, nor the end of a run of letters before an ASCII character that
    is none.  A run of white space that does not end in a blank or a line end
    stays with its word, since the pattern splits it by what follows.
    """
    return SPACED.findall(text)


def bare_units(text: str) -> list[str]:
    """The same for tokenizers that drop white space: blanks and line ends are left out."""
    return BARE.findall(text)


class Places(dict):
    """Unit to its place in ``ids``; a unit met for the first time gets the next place."""

    def __init__(self, old: dict, old_ids: list):
        super().__init__()
        self.old, self.old_ids, self.ids, self.new = old, old_ids, [], []

    def __missing__(self, unit: str) -> int:
        self[unit] = place = len(self.ids)
        before = self.old.get(unit)
        if before is None:
            self.new.append((unit, place))
            self.ids.append(b"")
        else:
            self.ids.append(self.old_ids[before])
        return place


class IdCache:
    """Unit to ids (little-endian unsigned 32-bit), filled in batches.

    Two generations of at most ``entries`` each, and one batch's units, are
    kept: when the young one is full it becomes the old one, and what is used
    again is taken over, so that frequent units stay.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], entries: int = 250_000):
        self.encode, self.entries, self.young = encode, entries, Places({}, [])

    def ids(self, split: list[list[str]]) -> list[bytes]:
        """The joined ids of each text's units; the batch's unknown units are encoded together."""
        young = self.young
        if len(young) > self.entries:
            young.old, young.old_ids = {}, []
            self.young = young = Places(dict(young), young.ids)
        places = [[young[u] for u in units] for units in split]
        known, new, young.new = young.ids, young.new, []
        try:
            for (_, place), ids in zip(new, self.encode([u for u, _ in new])):
                known[place] = ids
        except BaseException:
            self.young = Places({}, [])  # no unit may keep a place without its ids
            raise
        return [b"".join([known[i] for i in row]) for row in places]
