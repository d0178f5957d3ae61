"""Encoding a corpus with a public byte-level vocabulary by a global shuffle of distinct words, and decoding by its token bytes.

Documents are read in blocks. A block's texts become arrays of word numbers (position kept), its distinct words one row
each. Of those rows the distinct words of the corpus are shuffled and encoded, each once; the ids are joined back to the
blocks by word and the documents are reassembled by position. What is joined is one row per block and distinct word
instead of one per word occurrence; words are combined before the first shuffle, and in the join a frequent word, which
has a row in every block, has a single row on the other side, so that its rows can be split over tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import vocab
from textloom.session import materialize, ship

BLOCK_CHARS = 2_000_000
_SPLIT = "block string, doc_id long, codes binary, word string, code int"
_SPLIT_ARROW = pa.schema([("block", pa.string()), ("doc_id", pa.int64()), ("codes", pa.binary()), ("word", pa.string()), ("code", pa.int32())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to the documents as word numbers (word null) and the dictionary of each block (doc_id null)."""
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId(), 0
    split = vocab.splitter()

    def block(docs: list, texts: list) -> Iterator[pa.RecordBatch]:
        name = f"{part}-{k}"
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        codes = [np.array(list(map(number.__getitem__, split(t))), np.uint32).tobytes() if t else b"" for t in texts]
        n, m = len(docs), len(number)
        yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(docs, pa.int64()), pa.array(codes, pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32())], schema=_SPLIT_ARROW)
        yield pa.RecordBatch.from_arrays([pa.array([name] * m, pa.string()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(list(number), pa.string()), pa.array(range(m), pa.int32())], schema=_SPLIT_ARROW)

    for b in batches:
        docs, texts, chars = [], [], 0
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            docs.append(i)
            texts.append(t)
            chars += len(t or "")
            if chars >= BLOCK_CHARS:
                yield from block(docs, texts)
                docs, texts, chars, k = [], [], 0, k + 1
        if docs:
            yield from block(docs, texts)
            k += 1


def _word_encoder(ranks: bytes) -> Callable:
    """(word) to (word, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocab.encoding(ranks).encode_ordinary
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.array(enc(w), np.int32).tobytes() for w in b.column(0).to_pylist()], pa.binary())], ["word", "ids"])

    return run


def _reassemble(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Documents of one block with the ids of their words in order."""
    code = words.column("code").to_numpy()
    flat = words.column("ids").combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0) if flat.num_chunks else pa.array([], pa.binary())
    parts = [np.frombuffer(x, np.int32) for x in flat.to_pylist()]
    order = np.argsort(code)
    size = np.array([len(parts[k]) for k in order], np.int64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    pool = np.concatenate([parts[k] for k in order]) if len(order) else np.zeros(0, np.int32)
    values, lengths = [], []
    for c in docs.column("codes").to_pylist():
        w = np.frombuffer(c, np.uint32)
        n = size[w]
        total = int(n.sum())
        at = np.repeat(start[w] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total) if total else np.zeros(0, np.int64)
        values.append(pool[at])
        lengths.append(total)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values) if values else np.zeros(0, np.int32), pa.int32()))
    return pa.table({"doc_id": docs.column("doc_id"), "ids": ids})


def encode(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = vocab.FOLDER) -> DataFrame:
    """(doc_id bigint, ids array<int>) for ``documents`` (doc_id, text): no special tokens, the text exactly as stored.

    An empty and a null text give an empty list. Repeated rows give repeated rows; a null doc_id is a row like any other.
    """
    ship(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    empty = docs.filter("coalesce(text, '') = ''").select("doc_id", F.expr("CAST(array() AS array<int>)").alias("ids"))
    split = materialize(docs.filter("text <> ''").mapInArrow(_blocks, _SPLIT), "words")
    ranks = vocab.read_ranks(name, folder)
    words = split.filter("code IS NOT NULL").select("block", "code", "word")
    # each word of the corpus once; a frequent one meets its row by a join whose other side Spark can split
    encoded = words.select("word").distinct().mapInArrow(_word_encoder(ranks), "word string, ids binary")
    words = words.join(encoded, "word").select(F.col("block").alias("b"), "code", "ids")
    texts = split.filter("codes IS NOT NULL").select("block", "doc_id", "codes")
    done = texts.groupBy("block").cogroup(words.groupBy("b")).applyInArrow(_reassemble, "doc_id long, ids array<int>")
    return done.unionByName(empty)


def token_bytes(documents_sparksession, name: str = "byte_bpe_50k", folder: str = vocab.FOLDER) -> DataFrame:
    """The token-byte table of a vocabulary: (id, bytes)."""
    import base64

    rows = [(int(b), bytearray(base64.b64decode(a))) for a, b in (line.split() for line in vocab.read_ranks(name, folder).splitlines() if line)]
    return documents_sparksession.createDataFrame(rows, "id int, bytes binary")


def decode(encoded: DataFrame, name: str = "byte_bpe_50k", folder: str = vocab.FOLDER) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): joins the token-byte table by id and puts the bytes together by position.

    An empty or null list gives an empty text. The table has the fixed size of its vocabulary, so it is broadcast.
    doc_id must be unique. An id outside the vocabulary is an error.
    """
    table = F.broadcast(token_bytes(encoded.sparkSession, name, folder))
    at = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    known = at.join(table, "id", "left").withColumn("bytes", F.when(F.col("id").isNotNull() & F.col("bytes").isNull(), F.raise_error("id outside the vocabulary")).otherwise(F.col("bytes")))
    parts = known.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", F.hex("bytes").alias("hex")))).alias("x"))
    return parts.select("doc_id", F.decode(F.unhex(F.array_join(F.transform("x", lambda p: p["hex"]), "")), "utf-8").alias("text"))
