"""Cutting a text into pieces that a tokenizer treats one by one, and a worker's cache over them.

The pieces of a *plain* text (words separated by single spaces or single line
feeds, no other white space) are its words, each with the space or line feed
before it.  Every tokenizer used here starts a new pre-token at these places,
so a text's ids are its pieces' ids in order.  Any other text goes whole to
the tokenizer.  Both ways give the same ids; the first one is faster, because
most pieces come back.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: A key's first character tells what stands before the word: "\r" nothing, "\n" a line feed, else a space.
HEAD = "\r"

#: White space other than the space: none may stand inside a piece.
_OTHER_SPACE = re.compile("[\t\n\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_RARE_SPACE = re.compile("[\t\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

#: Entries a worker's cache holds before it starts anew (about 200 bytes each).
CACHE_ENTRIES = 1_000_000


def keys_of(text: str) -> list[str]:
    """Keys of a text's pieces, if the text is plain."""
    keys = text.replace("\n", " \n").split(" ")
    keys[0] = HEAD + keys[0]
    return keys


def piece_of(key: str) -> str:
    """The text of a key's piece."""
    return key[1:] if key[0] == HEAD else key if key[0] == "\n" else " " + key


class PieceCache:
    """Values of pieces, computed by ``encode(keys) -> values`` for the missing ones.

    ``alone``: strings that a piece must not hold; texts with them go whole
    to the tokenizer as well.  ``fixed`` entries stay when the cache starts anew.
    """

    def __init__(self, encode: Callable[[list[str]], list], alone: list[str] | None = None,
                 fixed: dict | None = None, limit: int = CACHE_ENTRIES):
        self.encode, self.fixed, self.limit = encode, fixed or {}, limit
        self.alone = re.compile("|".join(map(re.escape, alone))) if alone else None
        self.known = dict(self.fixed)

    def is_piece(self, key: str) -> bool:
        body = key[1:] if key[:1] in (HEAD, "\n") else key
        return bool(body) and not _OTHER_SPACE.search(body) and not (self.alone and self.alone.search(body))

    def _all_pieces(self, keys: set[str]) -> bool:
        """Whether every key surely is a piece, by one look at all of them together (keys hold no spaces)."""
        joined = " " + " ".join(keys)
        return (not _RARE_SPACE.search(joined) and not (self.alone and self.alone.search(joined))
                and all(joined.count(lead) == joined.count(" " + lead) for lead in (HEAD, "\n"))
                and len(joined.split()) == len(keys))

    def learn(self, texts: list[str]) -> list[list[str] | None]:
        """Keys of each text, ``None`` where it is not plain; afterwards ``known`` has all of them.

        A key that is no piece never enters the cache, so that only missing
        keys need a look.
        """
        full = len(self.known) > self.limit
        keys: list[list[str] | None] = [keys_of(t) for t in texts]
        missing = set().union(*keys).difference(self.known)
        odd = set() if self._all_pieces(missing) else {k for k in missing if not self.is_piece(k)}
        # a carriage return of the text's own would pass for the mark of a first word
        marked = [i for i, t in enumerate(texts) if HEAD in t]
        for i in marked:
            keys[i] = None
        if odd or marked:
            keys = [None if k is None or not odd.isdisjoint(k) else k for k in keys]
            missing = set().union(*filter(None, keys)).difference(self.known)
        if full:  # what this batch has in common with the past is what comes often
            own = set().union(*filter(None, keys)) - missing
            self.known = self.fixed | {k: self.known[k] for k in own}
        if missing:
            todo = list(missing)
            self.known.update(zip(todo, self.encode(todo), strict=True))
        return keys
