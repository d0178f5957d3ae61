"""Conversations for fine-tuning: strict or audited assembly, rendering, assistant-only labels, truncation, padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

ROLES = ("system", "user", "assistant")
MASKED = -100


def clean(messages: DataFrame, row: str = "msg_id", language: str = "language", strict: bool = False) -> DataFrame:
    """_row, conversation_id, turn_index (int; null: not whole), role, content, language; rows without id or content are left out.

    Nulls read as empty texts. Extra columns are dropped; a missing one is an error that names it. ``strict`` reads every
    number first, so that one that isn't whole is an error even where its row would be left out, and so is a table of
    which nothing remains.
    """
    need = {"conversation_id", "turn_index", "role", "content", language, row}
    if missing := sorted(need - set(messages.columns)):
        raise ValueError(f"missing columns: {missing}")
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = T.strip(s("turn_index"))
    x = messages.select(
        F.col(row).cast("bigint").alias("_row"),
        T.label(s("conversation_id")).alias("conversation_id"),
        F.when(turn.rlike(r"\A[+-]?[0-9]+\z"), turn.try_cast("int")).alias("turn_index"),
        F.lower(T.label(s("role"))).alias("role"),
        T.strip(s("content")).alias("content"),
        T.label(s(language)).alias("language"),
    )
    if not strict:
        return x.filter("conversation_id <> '' AND content <> ''")
    bad = F.raise_error(F.concat(F.lit("turn_index is no whole number in row "), F.coalesce(F.col("_row").cast("string"), F.lit("null")))).cast("boolean")
    kept = x.filter(F.when(F.col("turn_index").isNull(), bad).otherwise((F.col("conversation_id") != "") & (F.col("content") != "")))
    if kept.isEmpty():
        raise ValueError("no message remains")
    return kept


REASONS = ("bad_turn", "bad_role", "duplicate_turn", "missing_role", "late_system")


def rejects(cleaned: DataFrame) -> DataFrame:
    """(conversation_id, reason) for every rule a conversation breaks. Aggregates only, so no conversation is gathered."""
    t, r = F.col("turn_index"), F.col("role")
    per = cleaned.groupBy("conversation_id", "turn_index").agg(F.count("*").alias("n"), F.count_if(~r.isin(*ROLES)).alias("odd"), F.count_if(r == "system").alias("sys"), F.count_if(r == "user").alias("usr"), F.count_if(r == "assistant").alias("ast"))
    g = per.groupBy("conversation_id").agg(
        F.bool_or(t.isNull()).alias("bad_turn"),
        (F.sum("odd") > 0).alias("bad_role"),
        F.bool_or(t.isNotNull() & (F.col("n") > 1)).alias("duplicate_turn"),
        ((F.sum("usr") == 0) | (F.sum("ast") == 0)).alias("missing_role"),
        F.coalesce(F.max(F.when(F.col("sys") > 0, t)) > F.min(t), F.lit(False)).alias("late_system"),
    )
    return g.select("conversation_id", F.explode(F.array_compact(F.array(*(F.when(F.col(c), F.lit(c)) for c in REASONS)))).alias("reason"))


def assemble(cleaned: DataFrame, strict: bool = False) -> DataFrame:
    """(conversation_id, first_row, messages, language, digest) of sound conversations, in turn order.

    ``strict`` raises on the first broken conversation, otherwise broken ones are left out (see ``rejects``). Messages
    are gathered only for sound conversations, where each number stands once.
    """
    bad = rejects(cleaned)
    if strict:
        ok = cleaned.join(bad.groupBy("conversation_id").agg(F.min("reason").alias("reason")), "conversation_id", "left")
        ok = ok.filter(F.when(F.col("reason").isNotNull(), F.raise_error(F.concat(F.col("conversation_id"), F.lit(": "), F.col("reason"))).cast("boolean")).otherwise(True))
    else:
        ok = cleaned.join(bad.select("conversation_id").distinct(), "conversation_id", "left_anti")
    g = ok.groupBy("conversation_id").agg(
        F.min("_row").alias("first_row"),
        F.sort_array(F.collect_list(F.struct("turn_index", "role", "content"))).alias("m"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("language") != "", F.col("language")))), ",").alias("language"),
    )
    out = g.select("conversation_id", "first_row", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"), "language")
    return out.withColumn("digest", digest(F.col("messages")))


def _json_string(c: Column) -> Column:
    """A JSON string literal: short escapes, other control characters in lower-case hex, everything else raw."""
    out = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
    for k in range(0x20):
        out = F.replace(out, F.lit(chr(k)), F.lit(short.get(chr(k), f"\\u{k:04x}")))
    # most texts hold nothing to escape
    return F.concat(F.lit('"'), F.when(c.rlike('[\\x00-\\x1f"\\\\]'), out).otherwise(c), F.lit('"'))


def digest(messages: Column) -> Column:
    """sha256 of ``0``, NUL and the messages as JSON with sorted keys and ", " / ": " between."""
    one = F.transform(messages, lambda m: F.concat(F.lit('{"content": '), _json_string(m["content"]), F.lit(', "role": '), _json_string(m["role"]), F.lit("}")))
    return T.sha256_seeded(F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]")))


def dedup(conversations: DataFrame) -> DataFrame:
    """The first conversation of every digest, by first row."""
    g = conversations.groupBy("digest").agg(F.min_by(F.struct("conversation_id", "first_row", "messages", "language"), F.struct("first_row", "conversation_id")).alias("c"))
    return g.select("c.*", "digest")


# the template of the label tests: turn marks, and an empty reasoning block before an assistant's content (fixed values)
OPEN, CLOSE, THINK = "<|im_start|>", "<|im_end|>\n", "<think>\n\n</think>\n\n"


def render(messages: Column, generation: bool = False) -> Column:
    """struct(text, spans): the rendered conversation and the code-point spans [start, end) of the assistant contents in it.

    ``generation`` adds the head of an assistant turn at the end, for a model to go on from.
    """
    span = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit("").alias("text"), F.array().cast(span).alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        assistant = m["role"] == "assistant"
        head = F.concat(acc["text"], F.lit(OPEN), m["role"], F.lit("\n"), F.when(assistant, F.lit(THINK)).otherwise(F.lit("")))
        at = F.length(head)
        spans = F.when(assistant, F.concat(acc["spans"], F.array(F.struct(at.alias("start"), (at + F.length(m["content"])).alias("end"))))).otherwise(acc["spans"])
        return F.struct(F.concat(head, m["content"], F.lit(CLOSE)).alias("text"), spans.cast(span).alias("spans"))

    done = F.aggregate(messages, zero, step)
    if not generation:
        return done
    return F.struct(F.concat(done["text"], F.lit(f"{OPEN}assistant\n{THINK}")).alias("text"), done["spans"].alias("spans"))


def code_point_tokens(text: Column) -> Column:
    """One token per code point: struct(id, start, end)."""
    n = F.length(text)
    # split on the empty pattern visits the text once, where substring(i) would start over for every i
    chars = F.when(n > 0, F.slice(F.split(text, ""), 1, n)).otherwise(F.array().cast("array<string>"))
    return F.transform(chars, lambda c, i: F.struct(F.ascii(c).alias("id"), i.cast("int").alias("start"), (i + 1).cast("int").alias("end")))


def mask(tokens: Column, spans: Column) -> Column:
    """Labels: the id of a token that overlaps a span (half-open, zero-width tokens never), else MASKED."""
    return F.transform(tokens, lambda t: F.when((t["end"] > t["start"]) & F.exists(spans, lambda s: (t["start"] < s["end"]) & (t["end"] > s["start"])), t["id"]).otherwise(F.lit(MASKED)))


def labelled(conversations: DataFrame, longest: int | None = None, strict: bool = True) -> DataFrame:
    """conversation_id, input_ids, labels by the code-point tokenizer, the newest ``longest`` tokens.

    A conversation that the cut leaves without a label is an error, or with ``strict`` off left out.
    """
    x = conversations.select("conversation_id", render(F.col("messages")).alias("r")).select("conversation_id", code_point_tokens(F.col("r.text")).alias("t"), F.col("r.spans").alias("s"))
    x = x.select("conversation_id", F.transform("t", lambda t: t["id"]).alias("input_ids"), mask(F.col("t"), F.col("s")).alias("labels"))
    if longest is None:
        return x
    cut = lambda c: F.slice(c, F.greatest(F.lit(1), F.size(c) - longest + 1), longest)
    x = x.select("conversation_id", cut("input_ids").alias("input_ids"), cut("labels").alias("labels"))
    kept = F.exists("labels", lambda v: v != MASKED)
    if not strict:
        # a filter on the labels themselves would be pushed down and compute them anew for every token
        rows = F.when(kept, F.array(F.struct("input_ids", "labels")))
        return x.select("conversation_id", F.inline_outer(rows)).filter("labels IS NOT NULL")
    fail = F.raise_error(F.concat(F.lit("no assistant token left in "), F.col("conversation_id"))).cast("array<int>")
    return x.withColumn("labels", F.when(kept, F.col("labels")).otherwise(fail))


def collate(rows: DataFrame, batch: str, pad_id: int = 0) -> DataFrame:
    """Adds attention_mask and pads input_ids and labels on the right to the longest row of their ``batch``."""
    longest = rows.groupBy(batch).agg(F.max(F.size("input_ids")).alias("_n"))
    gap = F.col("_n") - F.size("input_ids")
    pad = lambda c, v: F.concat(F.col(c), F.array_repeat(F.lit(v), gap))
    ones = F.array_repeat(F.lit(1), F.size("input_ids"))
    return rows.join(longest, batch).select(*(c for c in rows.columns if c not in ("input_ids", "labels")), pad("input_ids", pad_id).alias("input_ids"), pad("labels", MASKED).alias("labels"), F.concat(ones, F.array_repeat(F.lit(0), gap)).alias("attention_mask"))


def prompts(conversations: DataFrame) -> DataFrame:
    """conversation_id, prompt (messages before the last assistant turn), last_prompt, expected. Conversations without an assistant turn give none."""
    m = F.col("messages")
    k = F.size(m) - F.array_position(F.reverse(F.transform(m, lambda x: x["role"])), "assistant").cast("int")
    x = conversations.select("conversation_id", "messages", k.alias("k")).filter(F.exists("messages", lambda x: x["role"] == "assistant"))
    before = F.when(F.col("k") > 0, F.slice("messages", 1, F.greatest(F.col("k"), F.lit(1)))).otherwise(F.slice("messages", 1, 0))
    return x.select("conversation_id", before.alias("prompt"), F.when(F.col("k") > 0, F.col("messages")[F.greatest(F.col("k") - 1, F.lit(0))]["content"]).alias("last_prompt"), F.col("messages")[F.col("k")]["content"].alias("expected"))


def generation_sample(conversations: DataFrame, order: str, n: int) -> DataFrame:
    """conversation_id, rendered (the prompt with the head of the answer), expected: the first ``n`` conversations with an assistant turn, in the order of a column."""
    few = conversations.filter(F.exists("messages", lambda x: x["role"] == "assistant")).orderBy(order, "conversation_id").limit(n)
    return prompts(few).select("conversation_id", render(F.col("prompt"), generation=True)["text"].alias("rendered"), "expected")
