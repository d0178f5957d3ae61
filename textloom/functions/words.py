"""Word sequences for comparing texts: case, spacing, punctuation, invisible characters and Unicode form disregarded.

Runs inside Python stages on Arrow batches; words come out as 64-bit numbers so that numpy does the rest.
"""

from __future__ import annotations

import re
import unicodedata

import xxhash

# letters, numbers and the marks that belong to them; \w in re lacks combining marks
_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿￹-￻\U000e0000-\U000e01ef]+")
_ASCII_WORD = re.compile(r"[a-z0-9]+")


def _mark_ranges() -> str:
    """Character class of all combining marks, from the Unicode tables of the interpreter."""
    out, start, prev = [], None, None
    for c in range(0x300, 0x20000):
        if unicodedata.category(chr(c))[0] == "M":
            start = c if start is None else start
            prev = c
        elif start is not None:
            out.append(f"\\U{start:08x}-\\U{prev:08x}")
            start = None
    return "".join(out)


_WORD = re.compile(f"(?:[^\\W_]|[{_mark_ranges()}])+")


def fold(text: str) -> str:
    """Compatibility form, lower case, without invisible characters."""
    if text.isascii():
        return text.lower()
    return _INVISIBLE.sub("", unicodedata.normalize("NFKC", text).casefold())


def words(text: str) -> list[str]:
    t = fold(text)
    return (_ASCII_WORD if t.isascii() else _WORD).findall(t)


class WordIds:
    """64-bit numbers for words, remembered for frequent words up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def ids(self, ws: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[w] for w in ws]
        except KeyError:
            pass
        if len(known) > self.most:
            known.clear()
        out = []
        for w in ws:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        return out


def lcs_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over big integers."""
    if len(a) < len(b):
        a, b = b, a
    where: dict[int, int] = {}
    for i, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    s = full
    get = where.get
    for x in a:
        u = s & get(x, 0)
        if u:
            s = (s + u) | (s - u)
            s &= full
    return len(b) - s.bit_count()
