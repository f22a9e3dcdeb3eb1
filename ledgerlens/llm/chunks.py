"""Texts in pieces that byte-level BPE treats apart.

The pre-tokeniser never joins a character that is not white space to a space after it, so a
text may be cut before every space that follows one; the pieces repeat a lot and can be
encoded once each.
"""

from __future__ import annotations

import re

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def pieces(text: str) -> list[str]:
    """The text cut before spaces; joined again they are the text."""
    if _SPACE_AFTER_SPACE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + r for r in rest]]


class Known:
    """A table in two generations: at `most` entries the younger one becomes the older one, so
    what is in use stays and the size is bounded."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that have to be made; the others are in `young` afterwards."""
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        out = []
        for k in keys:
            if k not in young:
                if k in old:
                    young[k] = old[k]
                else:
                    out.append(k)
        return out
