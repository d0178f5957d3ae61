"""Evaluation passages inside training text: Wu-Manber search over words.

A passage leaks where RUN successive words of it stand in a text in order with at most REPLACED of them replaced. Such a
stretch, cut into REPLACED + 1 pieces, has a piece without a replacement, so every run of that many words of every
passage is a pattern. A shift table over blocks of two words says how far the search may jump; where it may not, the
suffix-hash bucket lists the patterns that end so, and the words are compared. Every hit fixes a diagonal (text position
against passage position), on which the stretch itself is checked.
"""

from __future__ import annotations

import html
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import words
from textloom.session import ship

RUN, REPLACED = 24, 2
PART = 200_000  # passages of a suite that are searched for in one pass over the documents
_INLINE = re.compile(r"</?(?:a|abbr|b|bdi|bdo|cite|code|em|font|i|ins|kbd|mark|q|s|small|span|strong|sub|sup|tt|u|var|wbr)(?:\s[^<>]*)?/?>", re.I)
_TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9-]*(?:\s[^<>]*)?/?>")
_EMPHASIS = re.compile(r"[*_~`]+")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐]\s*\n(?:[ \t]*>)*\s*(?=[^\W\d_])")
_LINK = re.compile(r"\[([^\[\]]+)\]\([^()\s]+\)")


def _uncommented(text: str) -> str:
    """The text without <!-- comments -->, however long; one that is never closed is text."""
    parts, at = [], 0
    while (a := text.find("<!--", at)) >= 0 and (b := text.find("-->", a + 4)) >= 0:
        parts += [text[at:a], " "]
        at = b + 3
    return "".join(parts) + text[at:] if parts else text


def plain(text: str) -> str:
    """The text without markup: comments, tags, entities, link targets, emphasis, words broken at a line's end."""
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", _uncommented(text)))
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if "-\n" in text or "-\r" in text or "‐" in text:
        text = _BROKEN.sub("", text)
    return _EMPHASIS.sub("", text)


class Searcher:
    """Wu-Manber tables of a list of (item_id, passage); passages under RUN words can't leak."""

    def __init__(self, items: list[tuple[int, str]]):
        self.m = RUN // (REPLACED + 1)
        self.number: dict[str, int] = {}
        self.items, self.seqs = [], []
        for item, passage in items:
            ws = words(plain(passage or ""))
            if len(ws) >= RUN:
                self.items.append(item)
                self.seqs.append([self.number.setdefault(w, len(self.number) + 1) for w in ws])
        self.base = len(self.number) + 1
        self.far = self.m - 1  # pattern length - block length + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[tuple[int, int]]] = {}
        for k, seq in enumerate(self.seqs):
            for p in range(len(seq) - self.m + 1):
                for j in range(1, self.m):
                    block = seq[p + j - 1] * self.base + seq[p + j]
                    d = self.m - 1 - j
                    if d < self.shift.get(block, self.far):
                        self.shift[block] = d
                self.bucket.setdefault(seq[p + self.m - 2] * self.base + seq[p + self.m - 1], []).append((k, p))
        self.arrays = [np.array(s, np.int64) for s in self.seqs]

    def hits(self, t: list[int]) -> set[tuple[int, int]]:
        """(passage, text position - passage position) of all exact pattern occurrences in a list of word numbers."""
        out: set[tuple[int, int]] = set()
        shift, far, base, m, seqs = self.shift.get, self.far, self.base, self.m, self.seqs
        i, n = m - 1, len(t)
        while i < n:
            block = t[i - 1] * base + t[i]
            d = shift(block, far)
            if d:
                i += d
                continue
            start = i - m + 1
            for k, p in self.bucket[block]:
                if (k, start - p) not in out and seqs[k][p] == t[start] and seqs[k][p : p + m] == t[start : i + 1]:
                    out.add((k, start - p))
            i += 1
        return out

    def leaks(self, k: int, diagonal: int, t: np.ndarray) -> bool:
        """Whether RUN successive words of passage ``k`` on the diagonal have at most REPLACED differences."""
        s = self.arrays[k]
        lo, hi = max(0, -diagonal), min(len(s), len(t) - diagonal)
        if hi - lo < RUN:
            return False
        wrong = np.cumsum(np.concatenate([[0], s[lo:hi] != t[lo + diagonal : hi + diagonal]]))
        return bool((wrong[RUN:] - wrong[:-RUN]).min() <= REPLACED)

    def search(self, text: str) -> list[int]:
        number = self.number.get
        t = [number(w, 0) for w in words(plain(text))]
        found: set[int] = set()
        array = None
        for k, diagonal in self.hits(t):
            if k not in found:
                array = np.array(t, np.int64) if array is None else array
                if self.leaks(k, diagonal, array):
                    found.add(k)
        return sorted({self.items[k] for k in found})


_searchers: dict[str, Searcher] = {}  # of this worker, by the mark of their suite


def _scan(mark: str, suite: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = _searchers.get(mark)
        if s is None:
            _searchers.clear()
            s = _searchers[mark] = Searcher(suite.value)
        for b in batches:
            docs, got = [], []
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text:
                    found = s.search(text)
                    docs += [d] * len(found)
                    got += found
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(got, pa.int64())], ["doc_id", "item_id"])

    return run


def find(documents: DataFrame, items: DataFrame, part: int = PART) -> DataFrame:
    """(doc_id, item_id): each document of (doc_id, text) with each item of (item_id, passage) that leaks into it, once a row of the document.

    One pass over the documents, no shuffle, with the tables of the held-out suite broadcast. A suite of more than ``part``
    passages is searched for in parts of about that many, a pass each, so what is broadcast has a bound. Null and empty
    texts and passages never match; of repeated items each id is reported.
    """
    spark = documents.sparkSession
    ship(spark)
    suite = items.select(F.col("item_id").cast("bigint"), F.col("passage").cast("string")).dropna().distinct()
    parts = max(1, -(-suite.count() // part))
    docs = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    out = None
    for k in range(parts):
        rows = sorted((r.item_id, r.passage) for r in suite.filter(F.pmod(F.xxhash64("item_id", "passage"), F.lit(parts)) == k).collect())
        one = docs.mapInArrow(_scan(uuid.uuid4().hex, spark.sparkContext.broadcast(rows)), "doc_id long, item_id long")
        out = one if out is None else out.unionByName(one)
    return out
