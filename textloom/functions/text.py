"""Column builders for text: whitespace, case, sentences, tokens, hashes. All stay in the JVM.

Nulls stay null unless a docstring says otherwise; empty texts give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus U+001C..U+001F, which Java's class lacks
WS = r"(?U)[\s\x1c-\x1f]+"
WS0 = r"(?U)[\s\x00\x1c-\x1f]+"
# the same as characters: tab to return, the separators, space, next line, no-break, ogham, the typographic spaces (fixed values)
WS_CHARS = "".join(map(chr, (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def visible(c: Column) -> Column:
    """Trimmed, runs of white space as one space."""
    return F.trim(F.regexp_replace(c, WS, " "))


def norm(c: Column) -> Column:
    """``visible`` in lower case (full Unicode mapping, final sigma included)."""
    return F.lower(visible(c))


def label(c: Column) -> Column:
    """As ``visible``, NUL counting as white space: for ids, roles and labels."""
    return F.trim(F.regexp_replace(c, WS0, " "))


def strip(c: Column) -> Column:
    """Outer white space removed, inner kept."""
    return F.btrim(c, F.lit(WS_CHARS))


def sentences(c: Column) -> Column:
    """Sentences of a text: split at white space after ``.``, ``!`` or ``?``; empty ones dropped."""
    return F.filter(F.split(visible(c), r"(?<=[.!?])\s+", -1), lambda x: x != "")


def tokens(c: Column) -> Column:
    """Distinct lower-case word tokens; combining marks end a token."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), 0))


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the token sets; 0.0 where either side has none or is null."""
    x, y = tokens(a), tokens(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(F.lit(0.0))


def sha1_seeded(c: Column, seed: int = 0) -> Column:
    """Hex sha1 of ``seed``, NUL, text."""
    return F.sha1(F.concat(F.lit(f"{seed}\0"), c).cast("binary"))


def sha256_seeded(c: Column, seed: int = 0) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}\0"), c).cast("binary"), 256)


def row_uid(query_norm: Column, positive_norm: Column) -> Column:
    return F.sha1(F.concat(F.lit("0\0"), query_norm, F.lit("\0"), positive_norm).cast("binary"))


def run_token(c: Column, longest: int = 80) -> Column:
    """File-name safe token: other characters become ``-``, outer ``-._`` go, cut to ``longest``."""
    safe = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "-"), r"\A[-._]+|[-._]+\z", "")
    return F.substring(safe, 1, longest)


def run_label(c: Column, longest: int = 48) -> Column:
    """A label for a run's name: like ``run_token``, shorter, and null where nothing is left."""
    token = run_token(c, longest)
    return F.when(token != "", token)


def common_prefix_length(a: Column, b: Column) -> Column:
    """Number of leading array elements that are equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False)
    return F.when(at == 0, n).otherwise(at - 1).cast("int")


def whole_number(c: Column) -> Column:
    """The bigint that a turn number states as written after trimming (sign and leading zeros allowed); else null."""
    t = strip(c)
    return F.when(t.rlike(r"\A[+-]?[0-9]+\z"), t.try_cast("bigint"))


def account(c: Column) -> Column:
    """Canonical account key: case, spaces and separators disregarded; null for a value that stands for no account."""
    key = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    return F.when(~key.isin(*NO_ACCOUNT), key)


# values that stand for no account, after the normalisation above (fixed values)
NO_ACCOUNT = ("", "0", "anon", "anonymous", "guest", "na", "nan", "nil", "nobody", "none", "null", "undefined", "unknown")
