"""Places for external encoders, tokenizers and chat templates. Each runs on Arrow batches, loaded once per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import ship


class Embedder(Protocol):
    def __call__(self, texts: list[str]) -> Sequence[Sequence[float]]: ...


class Tokenizer(Protocol):
    """Tokens of a text as (id, start, end), in code points."""

    def __call__(self, text: str) -> list[tuple[int, int, int]]: ...


class Template(Protocol):
    """The rendered conversation, and the [start, end) spans of the assistant contents in it, in code points."""

    def __call__(self, messages: list[dict[str, str]]) -> tuple[str, list[tuple[int, int]]]: ...


_TOKENS = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def embed(rows: DataFrame, key: str, text: str, load: Callable[[], Embedder], batch: int = 64) -> DataFrame:
    """(key, vector): each distinct text encoded once, then joined back to its rows. Null texts give null vectors."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load()
        for b in batches:
            texts = b.column(0).to_pylist()
            out = [list(map(float, v)) for k in range(0, len(texts), batch) for v in encoder(texts[k : k + batch])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float32()))], ["_text", "vector"])

    once = rows.select(F.col(text).alias("_text")).filter("_text IS NOT NULL").distinct().mapInArrow(run, "_text string, vector array<float>")
    return rows.select(key, F.col(text).alias("_text")).join(once, "_text", "left").select(key, "vector")


def tokenize(rows: DataFrame, key: str, text: str, load: Callable[[], Tokenizer]) -> DataFrame:
    """(key, tokens) in the form that ``chat.mask`` takes; a null text has no tokens."""
    ship(rows.sparkSession)
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load()
        for b in batches:
            out = [[dict(zip(("id", "start", "end"), t, strict=True)) for t in tok(x)] if x else [] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, _TOKENS)], [key, "tokens"])

    return rows.select(key, F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, tokens array<struct<id:int,start:int,end:int>>")


def render(conversations: DataFrame, load: Callable[[], Template]) -> DataFrame:
    """(conversation_id, text, spans) by an external template, in the form that ``chat.mask`` takes."""
    ship(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = load()
        for b in batches:
            done = [template(m) for m in b.column(1).to_pylist()]
            spans = [[dict(zip(("start", "end"), s, strict=True)) for s in ss] for _, ss in done]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in done], pa.string()), pa.array(spans, _SPANS)], ["conversation_id", "text", "spans"])

    return conversations.select("conversation_id", "messages").mapInArrow(run, "conversation_id string, text string, spans array<struct<start:int,end:int>>")


def around_assistant(template: Callable[[list[dict[str, str]]], str]) -> Template:
    """A Template from a function that only renders: marks are put around assistant contents, and their places read off.

    The marks are characters of the private use planes; a conversation that holds one itself is an error.
    """
    a, b = "\U000f0001", "\U000f0002"

    def render_one(messages: list[dict[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        if any(a in m["content"] or b in m["content"] for m in messages):
            raise ValueError("a content holds a span mark")
        marked = template([{**m, "content": a + m["content"] + b} if m["role"] == "assistant" else m for m in messages])
        text, spans, start = [], [], 0
        for c in marked:
            if c == a:
                start = len(text)
            elif c == b:
                spans.append((start, len(text)))
            else:
                text.append(c)
        return "".join(text), spans

    return render_one
