"""Public byte-level vocabularies: ranks read on the driver from a folder that is a parameter, used inside Python stages."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

FOLDER = os.environ.get("TEXTLOOM_TOKENIZERS", "/opt/tokenizers")

# the published pattern that splits text before merges (fixed value)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(name: str = "byte_bpe_50k", folder: str = FOLDER) -> bytes:
    """The rank file, under 1 MB for 50,000 entries; travels inside the function that uses it."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return f.read()


@lru_cache(maxsize=4)
def encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=1)
def splitter():
    """A function from text to its pre-tokens, equal to PATTERN; white space is the Unicode property, whatever the engine means by it."""
    import regex

    space = r"\t-\r \x85\xa0  -     　"
    shape = "'(?:[sdmt]|ll|ve|re)| ?{L}+| ?{N}+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+"
    wide = regex.compile(shape.format(L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}", s=space)).findall
    narrow = re.compile(shape.format(L="[A-Za-z]", N="[0-9]", l="A-Za-z", n="0-9", s=r"\t-\r ")).findall
    return lambda text: narrow(text) if text.isascii() else wide(text)
