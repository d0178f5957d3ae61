"""Token budget: every distinct text tokenised once, exact counts joined back, totals by source, language and domain."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.llm import vocab
from textloom.operators import turns
from textloom.session import ship


def token_counter(ranks: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocab.encoding(ranks).encode_ordinary
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(enc(t)) for t in b.column(1).to_pylist()], pa.int64())], ["h", "tokens"])

    return run


def text_hash(c: Column) -> Column:
    """Identity of a whole text: sha-256, as bytes."""
    return F.unhex(F.sha2(c, 256))


def distinct_texts(hashed: DataFrame, name: str = "byte_bpe_50k", folder: str = vocab.FOLDER) -> DataFrame:
    """(h, tokens): each distinct text of ``hashed`` (h, text) tokenised once."""
    ship(hashed.sparkSession)
    once = hashed.groupBy("h").agg(F.first("text").alias("text"))
    return once.mapInArrow(token_counter(vocab.read_ranks(name, folder)), "h binary, tokens long")


def message_budget(messages: DataFrame, threads: DataFrame, language: Column, name: str = "byte_bpe_50k", folder: str = vocab.FOLDER) -> DataFrame:
    """Totals per (source_name, language, domain_code): messages, distinct texts, tokens (every message counted), tokens of distinct texts.

    A message is a distinct (conversation, number as written, role, content); of its deliveries the one with the least
    source and language speaks for it. Rows that name no conversation count each on their own msg_id. Null contents
    count as empty, with no tokens; null source, language and domain are groups of their own. Of a thread's repeated
    rows the least domain counts.
    """
    cid = F.coalesce(T.label(F.col("conversation_id")), F.lit(""))
    number = F.coalesce(T.whole_number(F.col("turn_index")).cast("string"), T.strip(F.col("turn_index")), F.lit(""))
    content = T.strip(F.coalesce(F.col("content"), F.lit("")))
    rows = messages.select(
        F.when(cid == "", F.concat(F.lit("\x01"), F.col("msg_id").cast("string"))).otherwise(cid).alias("cid"),
        number.alias("number"),
        F.lower(T.label(F.coalesce(F.col("role"), F.lit("")))).alias("role"),
        text_hash(content).alias("h"),
        content.alias("text"),
        "source_name",
        language.alias("language"),
    )
    each = rows.groupBy("cid", "number", "role", "h").agg(F.min(F.struct("source_name", "language")).alias("m"))
    domain = threads.select(T.label(F.col("conversation_id")).alias("cid"), "domain_code").groupBy("cid").agg(F.min("domain_code").alias("domain_code"))
    counts = distinct_texts(rows.select("h", "text"), name, folder)
    # multiplicities first: the texts' counts are joined to one row per text and slice, not to every message
    slices = each.select("cid", "h", "m.*").join(domain, "cid", "left").groupBy("h", "source_name", "language", "domain_code").agg(F.count("*").alias("times"))
    return (
        slices.join(counts, "h")
        .groupBy("source_name", "language", "domain_code")
        .agg(F.sum("times").alias("messages"), F.count("*").alias("texts"), F.sum(F.col("times") * F.col("tokens")).alias("tokens"), F.sum("tokens").alias("distinct_tokens"))
    )
